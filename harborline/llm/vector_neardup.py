"""Embedding near-duplicates by sorted projection passes.

Each pass hashes a vector to a 64-bit word of signs of random projections and orders the vectors of a label by it, so
that alike vectors tend to stand close. Every vector is compared with its `window` neighbours before it; verified pairs of
all passes are united. A partition hands its first rows, and its last ones, to the seams between partitions, as far as a
window reaches, so windows do not end with partitions. A pass is one range partitioning by (pass, label, dim, word, row).
Equal vectors go through the passes as one row, so copies do not fill windows. Projections of large labels are taken from
their mean, as a direction that all vectors share would part nothing; each label takes the passes that its size and spread
need (`passes_for`), one if a window holds it.

Passes carry a byte for each component, with the exact bound of what that rounding can change a cosine by. Pairs that
the bound puts on one side of the threshold are decided; the others' vectors are fetched and compared in double precision.

The passes give components. Links inside a component are then counted exactly: members within half the threshold angle
of the component's mean direction are all linked to each other (triangle inequality of angles), so they are counted, not
compared; the others are compared with the component in tiles of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .components import components, roots

TILE = 512
STEP = 1024  # rows compared with a window at once
MEANS = 16 << 20  # bytes of labels' mean directions that every task gets
BROADCAST_ROWS = 1_000_000  # row numbers, 8 bytes each
BROADCAST_PARTS = 100_000  # partitions' sizes and seams


def _unit(arrow) -> tuple[np.ndarray, np.ndarray]:
    """Directions in double precision, and which rows have one; rows with null, non-finite or no components have none."""
    import pyarrow as pa

    offsets = arrow.offsets.to_numpy().astype(np.int64)
    size = np.where(arrow.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    flat = arrow.values.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    dim = int(size.max(initial=0))
    x = np.zeros((len(size), dim))
    ok = size > 0
    for n in np.unique(size[ok]):
        rows = np.flatnonzero(size == n)
        x[rows, :n] = flat[offsets[rows][:, None] + np.arange(n)]
    ok &= np.isfinite(x).all(axis=1)
    x[~ok] = 0
    big = np.abs(x).max(axis=1, initial=0)
    ok &= big > 0
    x = x / np.where(big > 0, big, 1)[:, None]
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm > 0, norm, 1)[:, None], ok


def _keys(batches):
    """(row, label, dim, key): a hash of each vector's direction."""
    import hashlib

    import pyarrow as pa

    for b in batches:
        u, ok = _unit(b.column("embedding"))
        at = np.flatnonzero(ok)
        dims = np.diff(b.column("embedding").offsets.to_numpy())[at]
        keys = [hashlib.blake2b((u[i] + 0.0).tobytes(), digest_size=16).digest() for i in at]  # + 0.0: -0 as 0
        part = b.take(pa.array(at))
        yield pa.RecordBatch.from_arrays([part.column("row"), part.column("label"), pa.array(dims, pa.int32()), pa.array(keys, pa.binary())], ["row", "label", "dim", "key"])


def _label_sums(batches, most: int = 10_000):
    import pyarrow as pa

    held: dict = {}

    def rows():
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in held], pa.int64()), pa.array([k[1] for k in held], pa.int32()), pa.array([n for n, _ in held.values()], pa.int64()), pa.array([x.tolist() for _, x in held.values()], pa.list_(pa.float64()))], ["label", "dim", "n", "sum"])

    for b in batches:
        u, ok = _unit(b.column("embedding"))
        dims, labels = np.diff(b.column("embedding").offsets.to_numpy()), b.column("label").to_numpy(zero_copy_only=False)
        for label, dim in {(int(x), int(y)) for x, y in zip(labels[ok], dims[ok], strict=True)}:
            mine = ok & (labels == label) & (dims == dim)
            n, x = held.get((label, dim), (0, np.zeros(dim)))
            held[label, dim] = (n + int(mine.sum()), x + u[mine, :dim].sum(axis=0))
        if len(held) >= most:
            yield rows()
            held.clear()
    yield rows()


def label_means(vectors: DataFrame, largest: DataFrame) -> dict:
    """{(label, dim): (n, mean direction)} of the labels in `largest` (label, dim), whose means take MEANS bytes at most."""
    hot = vectors.join(F.broadcast(largest.select("label").distinct()), "label", "left_semi")
    sums = hot.mapInArrow(_label_sums, "label long, dim int, n long, sum array<double>")
    by = sums.join(F.broadcast(largest), ["label", "dim"]).select("label", "dim", "n", F.posexplode("sum").alias("at", "x")).groupBy("label", "dim", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    out: dict = {}
    for r in by.groupBy("label", "dim").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "x"))).alias("m")).collect():
        out[r.label, r.dim] = (r.n, np.array([x.x for x in r.m]) / r.n)
    return out


def planned(valid: DataFrame, sizes: DataFrame, threshold: float, passes: int, window: int) -> tuple[dict, int]:
    """({(label, dim): (mean direction, passes)}, passes of all other labels) from labels' sizes (label, dim, count).

    A label that a window holds takes one pass, each other one as many as its size and spread need. Means are taken of the
    largest labels only, as many as MEANS bytes hold; labels beyond those are projected from the origin and take as many
    passes as the largest of them needs.
    """
    several = sizes.where(F.col("count") > window)
    widest = several.agg(F.max("dim")).first()[0] or 1
    largest = written(several.orderBy(F.desc("count"), "label", "dim").limit(max(1, MEANS // (8 * widest))), "largest")
    means = label_means(valid, largest.select("label", "dim"))
    plan = {}
    for r in largest.collect():
        mean = means[r.label, r.dim][1]
        plan[r.label, r.dim] = (mean, max(passes, passes_for(r["count"], threshold, window, math.sqrt(max(0.0, 1 - float(mean @ mean))))))
    rest = several.join(F.broadcast(largest.select("label", "dim")), ["label", "dim"], "left_anti").agg(F.max("count")).first()[0]
    return plan, passes if rest is None else max(passes, passes_for(rest, threshold, window))


def _projected(plan, others: int, seed: int):
    def run(batches):
        import pyarrow as pa

        planes: dict[int, np.ndarray] = {}
        passes = max([others, *[n for _, n in plan.value.values()]])
        for whole in batches:
            for i in range(0, len(whole), 4096):
                b = whole.slice(i, 4096)
                u, ok = _unit(b.column("embedding"))
                dims, labels = np.diff(b.column("embedding").offsets.to_numpy()), b.column("label").to_numpy(zero_copy_only=False)
                for dim in sorted({int(x) for x in dims[ok]}):
                    at = np.flatnonzero(ok & (dims == dim))
                    if dim not in planes:
                        planes[dim] = np.random.RandomState(seed).standard_normal((dim, passes * 64))
                    mine, of = np.unique(labels[at], return_inverse=True)
                    known = [plan.value.get((int(x), dim), (None, others)) for x in mine]
                    mean = np.stack([np.zeros(dim) if m is None else m for m, _ in known])
                    many = np.array([n for _, n in known])[of]
                    x = u[at, :dim]
                    small, part = pa.array(_rounded(x), pa.binary()), b.take(pa.array(at))
                    for p in range(int(many.max())):
                        take = np.flatnonzero(many > p)
                        bits = (x[take] - mean[of[take]]) @ planes[dim][:, p * 64 : (p + 1) * 64] >= 0
                        words = np.packbits(bits, axis=1).view(">u8")[:, 0].astype(np.uint64) ^ np.uint64(1 << 63)  # so that signed order is lexicographic
                        some, n = pa.array(take), len(take)
                        yield pa.RecordBatch.from_arrays([pa.array([p] * n, pa.int32()), part.column("label").take(some), pa.array([dim] * n, pa.int32()), pa.array(words.view(np.int64)), part.column("row").take(some), small.take(some)], ["pass", "label", "dim", "word", "row", "small"])

    return run


def _rounded(x: np.ndarray) -> list[bytes]:
    """A byte for each component, behind the scale and the length of what rounding took away (a little more, for safety)."""
    scale = (np.abs(x).max(axis=1) / 127).astype(np.float32)
    q = np.rint(x / scale[:, None].astype(float)).clip(-127, 127).astype(np.int8)
    lost = np.sqrt(((x - q * scale[:, None].astype(float)) ** 2).sum(axis=1)) * 1.001 + 2e-6
    return [a.tobytes() + b.tobytes() + c.tobytes() for a, b, c in zip(scale, lost.astype(np.float32), q, strict=True)]


class Rows:
    """Rows of a pass in order, as arrays."""

    def __init__(self, b):
        self.row = b.column("row").to_numpy(zero_copy_only=False)
        self.group = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pass", "label", "dim")], axis=1)
        small = b.column("small").to_pylist()
        width = max((len(x) for x in small), default=8)
        raw = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in small), np.uint8).reshape(len(small), width)
        self.lost = raw[:, 4:8].copy().view(np.float32)[:, 0]
        self.x = raw[:, 8:].view(np.int8).astype(np.float32) * raw[:, :4].copy().view(np.float32)

    def links(self, window: int, threshold: float, before: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Edges that span what is surely linked, and pairs that rounding leaves open; the later row of each is `before` or after."""
        sure, open_ = [np.zeros((0, 2), np.int64)], [np.zeros((0, 2), np.int64)]
        for c in range(before, len(self.row), STEP):
            to, start = min(c + STEP, len(self.row)), max(0, c - window)
            dots = self.x[start:to] @ self.x[c:to].T
            margin = self.lost[start:to, None] * (1 + self.lost[None, c:to]) + self.lost[None, c:to]
            ok = dots + margin >= threshold
            ok &= np.arange(start, to)[:, None] < np.arange(c, to)[None, :]
            i, j = np.nonzero(ok)
            same = (self.group[start + i] == self.group[c + j]).all(axis=1)
            i, j = i[same], j[same]
            certain = dots[i, j] - margin[i, j] >= threshold
            root = roots(to - start, i[certain], j[certain] + c - start)
            moved = np.flatnonzero(root != np.arange(len(root)))
            sure.append(np.stack([self.row[start + moved], self.row[start + root[moved]]], axis=1))
            i, j = i[~certain], j[~certain] + c - start
            apart = root[i] != root[j]
            open_.append(np.stack([self.row[start + i[apart]], self.row[start + j[apart]]], axis=1))
        return np.concatenate(sure), np.concatenate(open_)


_FOUND = "a long, b long, sure boolean, part int, at long, rows long, pass int, label long, dim int, row long, small binary"


def _pairs_batch(sure: np.ndarray, open_: np.ndarray):
    import pyarrow as pa

    x, n = np.concatenate((sure, open_)), len(sure) + len(open_)
    none = [pa.nulls(n, t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(np.arange(n) < len(sure)), *none], [c.split()[0] for c in _FOUND.split(", ")])


def _windows(window: int, threshold: float):
    """Pairs inside a partition, its first and last rows (at: place in it), and how many rows it has."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, tail, n = TaskContext.get().partitionId(), None, 0
        names = [c.split()[0] for c in _FOUND.split(", ")]

        def edge(t, at):
            k = len(t)
            shown = [c.combine_chunks() if isinstance(c := t.column(x), pa.ChunkedArray) else c for x in names[6:]]
            return pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.bool_()), pa.array([part] * k, pa.int32()), pa.array(np.arange(at, at + k)), pa.nulls(k, pa.int64()), *shown], names)

        for batch in batches:
            for i in range(0, len(batch), 4096):
                b = pa.Table.from_batches([batch.slice(i, 4096)])
                if n < window:
                    yield edge(b.slice(0, window - n), n)
                n += len(b)
                b = b if tail is None else pa.concat_tables([tail, b])
                yield _pairs_batch(*Rows(b.combine_chunks().to_batches()[0]).links(window, threshold, 0 if tail is None else len(tail)))
                tail = b.slice(max(0, len(b) - window))
        if tail is not None:
            yield edge(tail, n - len(tail))
            one = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([*one, pa.array([part], pa.int32()), pa.nulls(1, pa.int64()), pa.array([n], pa.int64()), *[pa.nulls(1, t) for t in (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())]], names)

    return run


def _seam(window: int, threshold: float):
    def run(table):
        """Of one seam: the first rows of its partition against the last ones of those before it."""
        import pyarrow as pa

        t = table.sort_by([("part", "ascending"), ("at", "ascending")]).combine_chunks()
        before = int(np.count_nonzero(t.column("part").to_numpy() < t.column("seam").to_numpy()))
        return pa.Table.from_batches([_pairs_batch(*Rows(t.to_batches()[0]).links(window, threshold, before)).select(["a", "b", "sure"])])

    return run


def linked(vectors: DataFrame, threshold: float, plan: dict, others: int, window: int, seed: int) -> DataFrame:
    """(a, b) rows whose verified pairs, over all passes, span the components found."""
    spark = vectors.sparkSession
    p = vectors.mapInArrow(_projected(spark.sparkContext.broadcast(plan), others, seed), "pass int, label long, dim int, word long, row long, small binary")
    ordered = p.repartitionByRange("pass", "label", "dim", "word", "row").sortWithinPartitions("pass", "label", "dim", "word", "row").select("pass", "label", "dim", "row", "small")
    found = written(ordered.mapInArrow(_windows(window, threshold), _FOUND), "windows")
    # a partition's last rows reach the partitions after it, as far as fewer than a window of rows stand between
    sizes = sorted((r.part, r.rows) for r in found.where("rows is not null").select("part", "rows").collect())  # a row a partition
    parts, upto = np.array([x for x, _ in sizes], np.int64), np.cumsum([n for _, n in sizes])
    last = np.searchsorted(np.concatenate(([0], upto[:-1])), upto + window) if sizes else []
    ends = [(x, n, parts[k + 1 : to].tolist()) for k, ((x, n), to) in enumerate(zip(sizes, last, strict=True))]
    ends = spark.createDataFrame(ends, "part int, n long, seams array<int>")
    edges = found.where("at is not null")
    tails = edges.join(F.broadcast(ends) if len(sizes) <= BROADCAST_PARTS else ends, "part").where(f"at >= n - {window}")
    columns = ["part", "at", "pass", "label", "dim", "row", "small"]
    tails = tails.select(F.explode("seams").alias("seam"), *columns)
    heads = edges.where(f"at < {window}").select(F.col("part").alias("seam"), *columns)
    over = tails.union(heads).dropDuplicates(["seam", "part", "at"]).groupBy("seam").applyInArrow(_seam(window, threshold), "a long, b long, sure boolean")
    pairs = written(found.where("a is not null").select("a", "b", "sure").union(over).distinct(), "pairs")
    x = vectors.select(F.col("row").alias("a"), F.col("embedding").alias("x"))
    y = vectors.select(F.col("row").alias("b"), F.col("embedding").alias("y"))
    exact = pairs.where("not sure").join(x, "a").join(y, "b").mapInArrow(_cosine(threshold), "a long, b long")
    return pairs.where("sure").select("a", "b").union(exact)


def _cosine(threshold: float):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            x, y = _unit(b.column("x"))[0], _unit(b.column("y"))[0]
            ok = pa.array((x * y).sum(axis=1) >= threshold)
            yield pa.RecordBatch.from_arrays([b.column(c).filter(ok) for c in ("a", "b")], ["a", "b"])

    return run


def _sums(batches, most: int = 10_000):
    """A row for each component of a task: the sum of its directions there; sent on when there are many."""
    import pyarrow as pa

    held: dict[int, np.ndarray] = {}

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())], ["component", "sum"])

    for b in batches:
        for c, u in zip(b.column("component").to_pylist(), b.column("unit").to_pylist(), strict=True):
            held[c] = held[c] + np.frombuffer(u) if c in held else np.frombuffer(u)
        if len(held) >= most:
            yield rows()
            held.clear()
    yield rows()


def _total(pdf):
    import pandas as pd

    return pd.DataFrame({"component": [pdf["component"].iloc[0]], "sum": [np.sum([np.frombuffer(s) for s in pdf["sum"]], axis=0).tobytes()]})


def _mean(pdf):
    import pandas as pd

    x = np.sum([np.frombuffer(s) for s in pdf["sum"]], axis=0)
    norm = math.sqrt(float(x @ x))
    return pd.DataFrame({"component": [pdf["component"].iloc[0]], "middle": [(x / norm if norm > 1e-9 else x * 0).tobytes()]})


def _near_middle(limit: float):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            dots = [float(np.frombuffer(u) @ np.frombuffer(m)) for u, m in zip(b.column("unit").to_pylist(), b.column("middle").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("component"), b.column("unit"), pa.array([d >= limit for d in dots])], ["row", "component", "unit", "core"])

    return run


def _tile(threshold: float):
    def run(pdf):
        import pandas as pd

        rest, every = pdf[pdf["as_rest"]], pdf[~pdf["as_rest"]]
        if rest.empty or every.empty:
            return pd.DataFrame({"row": [], "n": []}).astype("int64")
        a, b = (np.frombuffer(b"".join(x["unit"])).reshape(len(x), -1) for x in (rest, every))
        hit = (a @ b.T >= threshold) & (rest["row"].to_numpy()[:, None] != every["row"].to_numpy()[None, :])
        core = every["core"].to_numpy(bool)
        return pd.DataFrame({"row": np.concatenate((rest["row"], every["row"][core])), "n": np.concatenate((hit.sum(axis=1), hit.sum(axis=0)[core]))}).astype("int64")

    return run


def _whole(threshold: float):
    def run(batches):
        """Rows in order of components, each wholly in one task: links of every member, a component at a time."""
        import pyarrow as pa

        names = ["row", "component", "unit"]

        def counted(t):
            t = t.combine_chunks()
            component = t.column("component").to_numpy()
            units = t.column("unit").to_pylist()
            edges = [0, *(np.flatnonzero(np.diff(component)) + 1).tolist(), len(t)]
            n = np.zeros(len(t), np.int64)
            for i, j in zip(edges, edges[1:], strict=False):
                x = np.frombuffer(b"".join(units[i:j])).reshape(j - i, -1)
                hit = x @ x.T >= threshold
                np.fill_diagonal(hit, False)
                n[i:j] = hit.sum(axis=1)
            return pa.RecordBatch.from_arrays([t.column("row").combine_chunks(), pa.array(n, pa.int64())], ["row", "n_links"])

        tail = None
        for batch in batches:
            for k in range(0, len(batch), 4096):
                t = pa.Table.from_batches([batch.slice(k, 4096)]).select(names)
                t = t if tail is None else pa.concat_tables([tail, t])
                component = t.column("component").to_numpy()
                last = int(np.searchsorted(component, component[-1]))  # the last component may go on
                if last:
                    yield counted(t.slice(0, last))
                tail = t.slice(last)
        if tail is not None and len(tail):
            yield counted(tail)

    return run


def count_links(members: DataFrame, threshold: float) -> DataFrame:
    """(row, n_links): links of each member (row, component, unit) inside its component, exactly.

    Two members of a component of two are linked. Components of at most `TILE` members are sorted together and counted one
    after the other, many in a task; greater ones are split into tiles.
    """
    sized = members.groupBy("component").agg(F.count("*").alias("size"))
    m = written(members.join(sized, "component"), "sized")
    few = m.where("size <= 2").select("row", (F.col("size") - 1).alias("n_links"))
    small = m.where(f"size > 2 and size <= {TILE}").select("row", "component", "unit")
    small = small.repartition("component").sortWithinPartitions("component").mapInArrow(_whole(threshold), "row long, n_links long")
    return few.union(small).union(_tiled_links(m.where(f"size > {TILE}").select("row", "component", "unit"), threshold))


def _tiled_links(members: DataFrame, threshold: float) -> DataFrame:
    """(row, n_links) of members of components of any size: those near the middle link with each other, the rest is compared in tiles."""
    sums = members.select("component", "unit").mapInArrow(_sums, "component long, sum binary")
    sums = sums.groupBy("component", (F.spark_partition_id() % 16).alias("salt")).applyInPandas(_total, "component long, sum binary")
    middles = sums.groupBy("component").applyInPandas(_mean, "component long, middle binary")  # 16 rows at most for each component
    limit = math.cos(math.acos(threshold) / 2) + 1e-9
    m = written(members.join(middles, "component").select("row", "component", "unit", "middle").mapInArrow(_near_middle(limit), "row long, component long, unit binary, core boolean"), "cores")
    sizes = m.groupBy("component").agg(F.count("*").alias("n"), F.sum(F.col("core").cast("long")).alias("n_core")).withColumn("n_rest", F.col("n") - F.col("n_core"))
    m = m.join(sizes, "component")
    inner = m.select("row", F.when(F.col("core"), F.col("n_core") - 1).otherwise(0).cast("long").alias("n"))
    open_ = m.where("n_rest > 0").withColumn("rest_tiles", F.ceil(F.col("n_rest") / TILE).cast("int")).withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int"))
    rest = open_.where("not core").withColumn("r", F.expr("cast(pmod(xxhash64(row, 1), rest_tiles) as int)")).withColumn("t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumn("as_rest", F.lit(True))
    every = open_.withColumn("t", F.expr("cast(pmod(xxhash64(row, 2), tiles) as int)")).withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rest_tiles") - 1))).withColumn("as_rest", F.lit(False))
    columns = ["component", "r", "t", "row", "core", "as_rest", "unit"]
    tiled = rest.select(*columns).union(every.select(*columns)).groupBy("component", "r", "t").applyInPandas(_tile(threshold), "row long, n long")
    return inner.union(tiled).groupBy("row").agg(F.sum("n").alias("n_links"))


def passes_for(n: int, threshold: float, window: int, spread: float = 1.0, missed: float = 0.001) -> int:
    """Passes after which a pair at the threshold is missed with that chance, among n vectors of a label.

    spread: root mean square distance of the vectors from the point projections are taken from. A pair meets in a pass if it
    shares the first log2(n / window) signs, each with the chance 1 - angle / pi, its angle as seen from that point.
    """
    apart = math.sqrt(max(0.0, 2 - 2 * threshold))
    alike = max(0.5, 1 - 2 * math.asin(min(1.0, apart / (2 * max(spread, 1e-9)))) / math.pi)
    meets = alike ** math.log2(max(1.0, n / window))
    return 1 if meets >= 1 - missed else math.ceil(math.log(missed) / math.log1p(-meets))


def _units(batches):
    import pyarrow as pa

    for b in batches:
        u, _ = _unit(b.column("embedding"))
        dims = np.diff(b.column("embedding").offsets.to_numpy())
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("component"), pa.array([x[:n].tobytes() for x, n in zip(u, dims, strict=True)], pa.binary())], ["row", "component", "unit"])


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93, passes: int = 1, window: int = 2048, seed: int = 7) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept (it is its component's smallest vec_id).

    Vectors link when their labels and lengths are equal, the labels are not null and cosine >= threshold (double
    precision). Vectors that are null, empty, zero or hold null or non-finite components link with nothing. Equal vectors
    link like others. A repeated vec_id gives a row each time; its rows link with each other as any two vectors would; a
    null vec_id takes its component's smallest id. Pairs of two components the passes did not bring together are missed;
    passes is the least number, and each label takes as many as keep 99.9 % of its pairs at the threshold by `passes_for` (7
    for 17,000 vectors, 18 for a million), however many labels there are. Vectors of any length are compared whole. Empty tables give no rows; further columns are ignored.
    """
    exact = embeddings.schema["embedding"].dataType.simpleString() == "array<float>"
    e = embeddings.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<float>" if exact else "array<double>").alias("embedding"))
    e = written(e, "vectors")
    valid = e.where("label is not null and embedding is not null").select("row", "label", "embedding")
    keyed = written(valid.mapInArrow(_keys, "row long, label long, dim int, key binary"), "keys")
    first = written(keyed.groupBy("label", "dim", "key").agg(F.min("row").alias("first"), F.count("*").alias("n")), "different")
    sizes = written(first.groupBy("label", "dim").count(), "labels")
    plan, others = planned(valid, sizes, threshold, passes, window)
    copies = written(keyed.join(first.where("n > 1"), ["label", "dim", "key"]).where("row <> first").select(F.col("row").alias("a"), F.col("first").alias("b")), "copies")
    again = copies.select(F.col("a").alias("row"))
    again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    found = components(linked(valid.join(again, "row", "left_anti"), threshold, plan, others, window, seed).union(copies)).toDF("row", "component")
    found = written(found, "components")
    members = written(found.join(valid.select("row", "embedding"), "row").mapInArrow(_units, "row long, component long, unit binary"), "members")
    n = count_links(members, threshold)
    ids = found.join(e.select("row", "vec_id"), "row")
    lowest = ids.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = ids.select("row", "component").join(lowest, "component").select("row", "component_id")
    out = e.select("row", "vec_id").join(named, "row", "left").join(n, "row", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
