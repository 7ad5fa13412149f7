"""N-gram Jaccard join: an exact join in the metric space of shingle sets (distance 1 - Jaccard, radius 1 - percent / 100).

Pruning. Nearly all texts lie at distance 1 from nearly any other. All shingles stand in one order, rare ones first; a set
of n shingles keeps its first n - ceil(percent x n / 100) + 1. Linked sets share at least ceil(percent x n / 100) of either
one's shingles, so the first shingle in order that both hold is among those that each keeps. Region (shingle): the sets that
keep it; linked sets always share a region, and a text that nothing resembles shares none and is done. Any order gives the
same links. Rarity is a level, the binary logarithm of the documents that a slot of shingle hashes counts, so its table has
SLOTS bytes whatever the input; each task tells the slots that stand out in its documents. A passage that many texts share
comes last in them and makes no region unless it is nearly all that they hold.

Slices. The more texts there are, the more single shingles meet by chance, so from SLICED percent on, regions are of several
shingles each. Linked sets differ in at most D shingles, so of D + 1 + 2e hash slices of the shingle universe they agree in
2e + 1 at least, and still in one if each drops its e lightest. Region (size window, slice, content of the slice): sets that
agree there. A set stands in the window of its size and in the one below, so linked sets always share a region. A slice holds
about percent / (100 - percent) shingles, which unrelated texts do not share; for lower thresholds it would hold too few.
Near copies of one text share most slices, linked or not, so the members of all large regions meet again, once, by the first
shingles that they keep, rare ones first as counted among these members alone: what a copy does not share with the others
comes first, and copies with more of it than links allow meet nobody.

Regions. The smallest member of a region is its first pivot; members within the radius are linked to it, hence joined
to each other without comparing them (a thousand near copies take a thousand distances). A region whose members are all
joined is done. A region of more than LEAF members takes PIVOTS pivots of different groups. Each member's distance to
each is found; it goes to the Voronoi cell of every pivot at most 2 x radius farther than its nearest one and
within FAR + radius, and to the far region if its nearest pivot is beyond FAR - radius. By the triangle inequality two
linked members always meet: if the nearest pivot p of x is within FAR, its partner is at most the radius farther from p,
and at most 2 x radius farther from p than from its own; if not, both are in the far region. Cells and far regions are
regions again. LEAF members or fewer compare all pairs not joined yet. Where cells would hardly be smaller than their
region (their members are about equally far from each other), its members meet in tiles: those outside its largest
joined group with all others, without pairs whose distances to a pivot differ by more than the radius.

Sketches. Each shingle flips one of 512 bits, and one of at least four times as many bits as a set has shingles: bits
that differ are at most the shingles that differ, so sketches give a least distance. A pair beyond the radius by that has
no link; the sets of the others, and only theirs, are fetched and compared exactly. A pivot's distance that is not measured
stands as the interval from its least distance to 1, and the rules above hold with the ends of intervals.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U, blocks, chain, column_bytes, discard, joined, mapped, mix, scan_words, written
from .components import joined_forests

LEAF = 64  # members whose pairs are all compared, by sketches first
PIVOTS = 4
FAR = 0.5
CLOSE = 1e-9
BLOCK = 128
SLICE = 1024  # documents whose texts a task copies at once
SLOTS = 1 << 22  # of the table of levels, a byte each
SLICED = 89  # percent from which regions are slices, of eight shingles or more
WORDS = 8
SKETCH = [f"s{w}" for w in range(WORDS)]  # 64 bits of a set's sketch each


def kept_of(n: int, percent: int) -> int:
    """How many of its first shingles a set of n keeps; none if only equal sets can link with it."""
    return 0 if n * (100 - percent) < percent else n - (percent * n + 99) // 100 + 1


def difference(n: float, percent: int) -> int:
    """Shingles that may differ between two linked sets, the smaller of at most n."""
    t = percent / 100
    return math.floor((1 - t) / t * n + 1e-9)


def window_of(n: int, percent: int) -> int:
    """Size window of a set; linked sets lie in the same window or in neighbouring ones."""
    return math.floor(math.log(max(n, 1)) / math.log(100 / percent) + 1e-9)


def slices_of(window: int, percent: int) -> tuple[int, int]:
    """Number of slices of a size window and how many a set drops: the empty ones it must expect, and some more."""
    most = difference((100 / percent) ** (window + 1), percent)
    if not most:
        return 0, 0
    empty = (most + 1) * math.exp(-((100 / percent) ** (window + 0.5)) / (most + 1))
    drop = max(1, math.ceil(empty + 2 * math.sqrt(empty)))
    return most + 1 + 2 * drop, drop


def doc_shingles(texts: list, k: int):
    """Distinct shingle hashes of each text (bytes or None): sorted uint64 arrays."""
    for i, j in blocks(texts):
        buf, begins = joined(texts[i:j])
        starts, _, _, h = scan_words(buf, lower=True)
        doc = np.searchsorted(begins, starts, "right") - 1
        n = np.bincount(doc, minlength=j - i)
        at = np.cumsum(n) - n
        s = chain([h[x : len(h) - k + 1 + x] for x in range(k)]) if len(h) >= k else np.zeros(0, U)
        for d in range(j - i):
            if n[d] >= k:
                yield np.unique(s[at[d] : at[d] + n[d] - k + 1])
            elif n[d]:
                yield chain([mix(np.array([n[d]], U))] + [h[x : x + 1] for x in range(at[d], at[d] + n[d])])
            else:
                yield np.zeros(0, U)


def _class(s: np.ndarray) -> int:
    """Hash of a whole set."""
    x = np.concatenate((mix(s ^ U(0xA5A5A5A5A5A5A5A5)), mix(np.array([len(s)], U))))
    return int(mix(np.add.reduce(x, keepdims=True)).view(np.int64)[0])


def _sketch(s: np.ndarray) -> list[int]:
    """WORDS words, and for larger sets more words behind them: bits flipped an odd number of times when each shingle flips one.

    The words behind are a power of two, at least four bits a shingle; half as many are the two halves' exclusive or.
    """
    more = 1 << (4 * len(s) - 1).bit_length()
    h = mix(s ^ U(0x3C)).astype(np.int64)
    out = []
    for bits in (64 * WORDS, more) if more > 64 * WORDS else (64 * WORDS,):
        flips = np.bincount(h & (bits - 1), minlength=bits).astype(np.uint8) & 1
        out += np.packbits(flips, bitorder="little").view(np.int64).tolist()
    return out


def alike(percent: int, x: str = "x", y: str = "y") -> str:
    """SQL: whether sketches and sizes of two sets allow a link; true of every linked pair."""
    differ = " + ".join(f"bit_count({x}.{s} ^ {y}.{s})" for s in SKETCH)
    return f"100 * least({x}.size, {y}.size) >= {percent} * greatest({x}.size, {y}.size) and {100 + percent} * ({differ}) <= {100 - percent} * ({x}.size + {y}.size)"


def least_distance(x: str = "x", y: str = "y") -> str:
    """SQL: a bound the distance of two sets is not below, by their sizes and wide sketches."""
    fold = "zip_with(slice({0}.wide, 1, size({1}.wide)), slice({0}.wide, size({1}.wide) + 1, size({1}.wide)), (p, q) -> p ^ q)"
    left = f"if(size({x}.wide) > size({y}.wide), {fold.format(x, y)}, {x}.wide)"
    right = f"if(size({y}.wide) > size({x}.wide), {fold.format(y, x)}, {y}.wide)"
    differ = f"aggregate(zip_with({left}, {right}, (p, q) -> bit_count(p ^ q)), 0, (n, v) -> n + v)"
    # sketches of sizes apart by more than two say nothing
    differ = f"if(greatest(size({x}.wide), size({y}.wide)) > 2 * least(size({x}.wide), size({y}.wide)), 0, {differ})"
    sizes = f"1 - least({x}.size, {y}.size) / greatest({x}.size, {y}.size)"
    return f"greatest({sizes}, transform(array({differ}), v -> 2 * v / ({x}.size + {y}.size + v))[0])"


def _slots(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles' second hashes, one each, and their slots in the table of levels."""
    h = mix(s ^ U(0x7B))
    return h, (h % U(SLOTS)).astype(np.int64)


def _batch_sets(batch, k: int):
    """The sets of a batch's texts, or those in its column of shingles."""
    if "shingles" in batch.schema.names:
        column = batch.column("shingles")
        for i in range(len(column)):
            yield column[i].values.to_numpy().view(U)
    else:
        texts = column_bytes(batch.column("text"))
        for i in range(0, len(texts), 256):
            yield from doc_shingles(texts[i : i + 256], k)


def _counted(k: int):
    """(slot, n): documents of a task that hold a shingle of the slot, where these stand out: two at least, and twice the mean."""

    def run(batches):
        import pyarrow as pa

        n = np.zeros(SLOTS, np.int32)
        for batch in batches:
            for s in _batch_sets(batch, k):
                n[_slots(s)[1]] += 1
        at = np.flatnonzero(n >= max(2, 2 * n.mean()))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))], ["slot", "n"])

    return run


def _levels(docs: DataFrame, k: int, column: str = "text"):
    """A broadcast of SLOTS bytes: how common the shingles of each slot are, as a binary logarithm."""
    rows = mapped(docs.select(column), _counted(k), "slot int, n long", SLICE).groupBy("slot").agg(F.ceil(F.log2(F.sum("n"))).cast("tinyint").alias("level")).toArrow()
    levels = np.zeros(SLOTS, np.uint8)
    levels[rows["slot"].to_numpy()] = rows["level"].to_numpy()
    return docs.sparkSession.sparkContext.broadcast(levels)


def _regions(s: np.ndarray, percent: int, levels: np.ndarray) -> np.ndarray:
    """Regions of a set: its slices, or the first of its shingles by level, then by hash."""
    if percent >= SLICED:
        return _slices(s, percent)
    return _rarest(s, percent, levels)


def _rarest(s: np.ndarray, percent: int, levels: np.ndarray) -> np.ndarray:
    """The shingles that a set keeps: the first by level, then by hash."""
    h, slots = _slots(s)
    return h[np.lexsort((h, levels[slots]))[: kept_of(len(s), percent)]]


def _slices(s: np.ndarray, percent: int) -> np.ndarray:
    """A set's slices' contents in its own size window and the one below, without the lightest slices."""
    out = [np.zeros(0, U)]
    if percent == 100:  # only equal sets link
        return out[0]
    own = window_of(len(s), percent)
    for window in (own, own - 1):
        m, drop = slices_of(window, percent)
        if not m:
            continue
        slices = (mix(s + U(0x51)) % U(m)).astype(np.int64)
        order = np.argsort(slices, kind="stable")
        total = np.concatenate((np.zeros(1, U), np.cumsum(mix(s[order] ^ U(0xC3)))))
        n = np.bincount(slices, minlength=m)
        ends = np.cumsum(n)
        tag = U(((window + 9) << 32) & 0xFFFFFFFFFFFFFFFF) + np.arange(m).astype(U)
        keys = mix(mix(tag) + (total[ends] - total[ends - n]) + n.astype(U))
        out.append(keys[np.argsort(n, kind="stable")[drop:]])
    return np.concatenate(out)


def _signed(k: int, percent: int, levels, most_seen: int = 1 << 17):
    """Rows of two kinds: a document (doc: id, size, sketch; region: any), and a set's regions, once a task for equal sets."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        seen, row = set(), (TaskContext.get().partitionId() + 1) << 40  # a task repeated gives the same rows
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), column_bytes(batch.column("text"))
            for i in range(0, len(texts), 256):
                regions, classes, docs = [], [], []
                for at, s in enumerate(doc_shingles(texts[i : i + 256], k), i):
                    c = _class(s) if len(s) else None
                    docs.append((c, [ids[at], len(s), *(_sketch(s) if c is not None else [])]))
                    if c is not None and c not in seen:
                        if len(seen) >= most_seen:
                            seen.clear()
                        seen.add(c)
                        regions.append(_regions(s, percent, levels and levels.value))
                        classes.append(np.full(len(regions[-1]), c, np.int64))
                row += len(docs)
                spread = mix(np.arange(row - len(docs), row).astype(U)).view(np.int64)
                names = ["region", "class", "doc"]
                yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array([c for c, _ in docs], pa.int64()), pa.array([d for _, d in docs], pa.list_(pa.int64()))], names)
                if classes:
                    r = np.concatenate(regions).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(np.concatenate(classes)), pa.nulls(len(r), pa.list_(pa.int64()))], names)

    return run


def _sets(k: int, docs_bits, class_bits, most_seen: int = 1 << 17):
    """(class, shingles) of the sets in the bitmaps, once a task; texts are cut only where the first has their id."""

    def run(batches):
        import pyarrow as pa

        seen: set = set()
        for batch in batches:
            column = batch.column("doc_id")
            known = ~column.is_null().to_numpy(zero_copy_only=False)
            keep = np.flatnonzero(_in_bits(docs_bits.value, column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) | ~known)
            texts = column_bytes(batch.column("text").take(pa.array(keep)))
            for i in range(0, len(texts), 128):
                s = [x for x in doc_shingles(texts[i : i + 128], k) if len(x)]
                c = np.array([_class(x) for x in s], np.int64)
                wanted = np.flatnonzero(_in_bits(class_bits.value, c))
                new = [at for at in wanted.tolist() if (x := int(c[at])) not in seen and not seen.add(x)]
                if len(seen) > most_seen:
                    seen.clear()
                if new:
                    yield pa.RecordBatch.from_arrays([pa.array(c[new]), pa.array([s[at].view(np.int64) for at in new], pa.list_(pa.int64()))], ["class", "shingles"])

    return run


def _in_bits(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    h = mix(x.astype(U)) % U(len(bits) * 64)
    return ((bits[(h >> U(6)).astype(np.int64)] >> (h & U(63))) & U(1)).astype(bool)


def _bitmap(ids: DataFrame, n: int, most_bits: int = 1 << 26):
    """A bitmap of n hashed ids: at most `most_bits`, so its size has a bound; extra hits cost time only."""
    spark = ids.sparkSession
    size = min(most_bits, max(1 << 12, 1 << (16 * max(n, 1)).bit_length()))

    def run(batches):
        import pyarrow as pa

        bits = np.zeros(size // 64, U)
        for batch in batches:
            h = mix(batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64).astype(U)) % U(size)
            np.bitwise_or.at(bits, (h >> U(6)).astype(np.int64), U(1) << (h & U(63)))
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits[at].view(np.int64))], ["word", "bits"])

    rows = mapped(ids, run, "word long, bits long").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toPandas()
    bits = np.zeros(size // 64, U)
    bits[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(U)
    return spark.sparkContext.broadcast(bits)


def _fetched(wanted: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(class, shingles) of the wanted (class, first_doc), cut from the texts again and written without a shuffle; a few others, and some twice."""
    n = wanted.count()
    return written(mapped(docs, _sets(k, _bitmap(wanted.select("first_doc"), n), _bitmap(wanted.select("class"), n)), "class long, shingles array<long>", SLICE), "sets")


def _finer(large: DataFrame, docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(region, class): the members of all large regions by the shingles that they keep, rare ones first among them alone.

    Any two that link share one of these regions, whichever they shared before.
    """
    wanted = written(large.select("class").distinct().join(classes, "class").select("class", "first_doc"), "wanted")
    sets = _fetched(wanted, docs, k)
    levels = _levels(sets, k, "shingles")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            kept = [_rarest(s, percent, levels.value) for s in _batch_sets(batch, k)]
            if kept:
                c = np.repeat(batch.column("class").to_numpy(zero_copy_only=False), [len(x) for x in kept])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(kept).view(np.int64)), pa.array(c)], ["region", "class"])

    out = mapped(sets, run, "region long, class long", SLICE).join(wanted.select("class"), "class", "left_semi")
    region = Window.partitionBy("region")
    out = out.select("region", "class").distinct().withColumn("lo", F.min("class").over(region)).withColumn("hi", F.max("class").over(region))
    out = written(out.where("lo < hi").select("region", "class"), "finer")
    discard(wanted, sets)
    return out


def similarity(pairs: DataFrame, docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """Exact (a, b, both, either): sizes of intersection and union for each pair of classes.

    The pairs' sets, and only theirs, are cut from the texts again and written without a shuffle; each goes to its pairs.
    """
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(classes, "class").select("class", "first_doc"), "wanted")
    sets = _fetched(wanted, docs, k)
    x, y = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(y, "b").join(x, "a").select("a", "b", F.size(F.array_intersect("x", "y")).cast("long").alias("both"), (F.size("x") + F.size("y")).cast("long").alias("sum"))
    # a set stands in `sets` more than once where tasks share a doc_id
    out = written(both.distinct().select("a", "b", "both", (F.col("sum") - F.col("both")).alias("either")), "measured")
    discard(wanted, sets)
    return out


def join(docs: DataFrame, k: int = 3, percent: int = 90, counts: list | None = None) -> DataFrame:
    """One row for each document: doc_id, n_shingles, component_id.

    Words are cut at ASCII white space, A-Z lower-cased; a set holds the distinct k-word shingles of the whole text, or
    the whole word sequence where it is shorter. Sets link when 100 x intersection >= percent x union; pairs at the
    threshold link. component_id is the smallest doc_id reachable by links. Null or empty texts and texts without words
    have no set and link with nothing. Equal texts are one class, however many. A repeated doc_id gives a row each time it
    occurs; rows that share an id share a component only through their texts; null ids take their group's smallest id, if
    any has one. Very long texts are read whole, one at a time. Empty tables give no rows; further columns are ignored.
    Shingles and sets are known by 64-bit hashes. counts: a list that takes the numbers of each round, for tests.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    levels = None if percent >= SLICED else _levels(d, k)
    rows = mapped(d, _signed(k, percent, levels), "region long, class long, doc array<long>", SLICE).repartition("region")
    region = Window.partitionBy("region")
    ends = [F.min("class").over(region).alias("pivot"), F.max("class").over(region).alias("last"), F.min(F.xxhash64("class")).over(region).alias("lo"), F.max(F.xxhash64("class")).over(region).alias("hi")]
    found = written(rows.select("*", *ends).where("doc is not null or pivot < last"), "signatures")
    signed = found.where("doc is not null").select(F.expr("doc[0]").alias("doc_id"), F.expr("doc[1]").alias("n_shingles"), "class", *[F.expr(f"doc[{2 + i}]").alias(w) for i, w in enumerate(SKETCH)], F.expr(f"if(size(doc) > {2 + WORDS}, slice(doc, {3 + WORDS}, size(doc)), slice(doc, 3, {WORDS}))").alias("wide"))
    # regions whose least and greatest members are the same, by two orders, have the same members nearly always: they are one
    members = written(found.where("doc is null").select(F.xxhash64("pivot", "last", "lo", "hi").alias("region"), "class", "pivot").distinct(), "regions")
    first = signed.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first_doc"), F.min("n_shingles").alias("size"), *[F.min(w).alias(w) for w in SKETCH])
    wide = signed.select("class", "wide")
    label = _resolve(d, first, wide, members, k, percent, counts)
    named = signed.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first_doc")).join(label, "class")
    lowest = named.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    alone = signed.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    named = written(named.join(lowest, "label").select("class", "component_id"), "components")
    one = alone.join(named, "class", "left_anti").union(named).where("class is not null").select(F.col("class").alias("c"), "component_id")
    out = signed.select("doc_id", "n_shingles", "class").join(one, F.col("class") == F.col("c"), "left")
    out = written(out.select("doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")), "joined")
    discard(found, members, named)
    return out


def _resolve(d: DataFrame, first: DataFrame, wide: DataFrame, members: DataFrame, k: int, percent: int, counts: list | None) -> DataFrame:
    """(class, label) once no region holds two classes that are unjoined and unmeasured."""
    spark = d.sparkSession
    label = None
    needed = members.select("class").distinct()
    classes = written(first.join(needed, "class", "left_semi"), "classes")
    ids, sketches = classes.select("class", "first_doc"), classes.drop("first_doc")
    wides = written(wide.join(needed, "class", "left_semi").dropDuplicates(["class"]).join(sketches.select("class", "size"), "class"), "wides")
    x, y = sketches.alias("x"), sketches.alias("y")
    pairs = members.where("class <> pivot").select(F.col("pivot").alias("a"), F.col("class").alias("b")).distinct()
    pairs = pairs.join(x, F.expr("a = x.class")).join(y, F.expr("b = y.class")).where(alike(percent)).select("a", "b")
    pairs = last = written(_bounded(pairs, wides).where(f"low <= {1 - percent / 100 + CLOSE}").select("a", "b"), "pairs")
    cells, opened, ends, measured, kept = members.select("region", "class"), [], None, None, []
    coarse = percent >= SLICED
    while not pairs.isEmpty() or ends is not None:
        new = similarity(pairs, d, ids, k)
        kept.append(new)
        measured = new if measured is None else measured.unionByName(new)
        past = [] if label is None else [label]
        label = written(joined_forests(measured.where(f"100 * both >= {percent} * either").select("a", "b")).toDF("class", "label"), "labels")
        tiles = None
        if ends is not None:
            past += [ends, to_pivots]
            tiles, cells, more = _split(ends, measured, label, sketches, percent)
            past += more
        past += opened
        cells = written(_open(cells, label), "cells")
        opened = [cells]
        small, large = cells.where(f"n <= {LEAF}"), cells.where(f"n > {LEAF}")
        if coarse and not large.isEmpty():
            finer = _finer(large, d, ids, k, percent)
            cells = written(_open(finer, label), "cells")
            opened, past = [*opened, cells], [*past, finer]
            small, large = small.union(cells.where(f"n <= {LEAF}")), cells.where(f"n > {LEAF}")
        coarse = False
        pairs = _pairs_inside(small.join(sketches, "class"), f"x.label <> y.label and {alike(percent)}")
        pairs = _bounded((pairs if tiles is None else pairs.union(tiles)).distinct(), wides)
        ends = None if large.isEmpty() else _ends(large)
        if ends is not None:
            to_pivots = written(_bounded(ends.where("a <> b").select("a", "b").distinct(), wides), "bounds")
            ends = written(ends.join(to_pivots, ["a", "b"], "left"), "ends")
            pairs = pairs.union(to_pivots).distinct()
        past.append(last)
        pairs = pairs.where(f"low <= {1 - percent / 100 + CLOSE}").select("a", "b")
        pairs = last = written(pairs.join(measured.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
        if counts is not None:
            counts.append({"leaves": small.select("region").distinct().count(), "voronoi": large.select("region").distinct().count(), "pairs": pairs.count()})
        cells = large.select("region", "class")
        discard(*past)  # what this round has replaced
    discard(classes, wides, last, *kept, *opened)
    return spark.createDataFrame([], "class long, label long") if label is None else label


def _bounded(pairs: DataFrame, wides: DataFrame) -> DataFrame:
    """(a, b, low): the least distance of each pair by its wide sketches."""
    x, y = wides.alias("x"), wides.alias("y")
    return pairs.join(x, F.expr("a = x.class")).join(y, F.expr("b = y.class")).select("a", "b", F.expr(least_distance()).alias("low"))


def _open(cells: DataFrame, label: DataFrame) -> DataFrame:
    """(region, class, label, n) of the regions that hold more than one label; of regions with the same members, one."""
    labelled = cells.join(label, "class", "left").withColumn("label", F.coalesce("label", "class"))
    by = labelled.groupBy("region").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"), *[F.expr(f"bit_xor(xxhash64(class, {k}))").alias(f"h{k}") for k in (1, 2)]).where("lo < hi")
    return labelled.join(by.groupBy("n", "h1", "h2").agg(F.min("region").alias("region")).select("region", "n"), "region")


def _ends(large: DataFrame) -> DataFrame:
    """(region, class, label, n, p, a, b): every member of a region with each of its pivots; a, b: the pair in order."""
    drawn = [F.min(F.struct(F.xxhash64("label", F.lit(i)), F.xxhash64("class"), "class")).getField("class") for i in range(PIVOTS)]
    pivots = large.groupBy("region").agg(F.array_distinct(F.array(*drawn)).alias("p")).select("region", F.explode("p").alias("p"))
    return large.join(pivots, "region").select("region", "class", "label", "n", "p", F.least("class", "p").alias("a"), F.greatest("class", "p").alias("b"))


def _pairs_inside(cells: DataFrame, more: str) -> DataFrame:
    """Pairs in regions of bounded size that meet the condition."""
    x, y = cells.alias("x"), cells.alias("y")
    both = x.join(y, F.expr("x.region = y.region and x.class < y.class")).where(more)
    return both.select(F.col("x.class").alias("a"), F.col("y.class").alias("b"))


def _split(ends: DataFrame, measured: DataFrame, label: DataFrame, sketches: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Of regions whose distances to pivots are known: pairs to measure where cells would not part, the cells of the others, and what both read."""
    radius = 1 - percent / 100
    distance = measured.select("a", "b", (1 - F.col("both") / F.col("either")).alias("d"))
    known = F.coalesce("d", F.when(F.col("a") == F.col("b"), 0.0))
    d = F.struct("p", F.coalesce(known, "low").alias("low"), F.coalesce(known, F.lit(1.0)).alias("up"))
    at = ends.drop("label").join(distance, ["a", "b"], "left").groupBy("region", "class", "n").agg(F.collect_list(d).alias("ds"))
    own = F.array_min(F.transform("ds", lambda v: v["up"]))
    at = at.join(label, "class", "left").withColumn("label", F.coalesce("label", "class")).withColumn("own", own)
    reach = F.least(F.lit(FAR + radius), F.col("own") + 2 * radius) + CLOSE
    to = F.concat(F.transform(F.filter("ds", lambda v: v["low"] <= reach), lambda v: v["p"]), F.when(F.col("own") > FAR - radius - CLOSE, F.array(F.lit(None).cast("long"))).otherwise(F.array().cast("array<long>")))
    at = written(at.withColumn("to", to), "distances")
    inside = at.select("region", "class", "n", F.explode("to").alias("p"))
    counts = inside.groupBy("region", "p").agg(F.count("*").alias("size"), F.max("n").alias("n"))
    parted = written(counts.groupBy("region").agg((F.max(F.col("size") / F.col("n")) <= 0.7).alias("parts")), "parted")
    cells = inside.join(parted.where("parts"), "region").select(F.xxhash64("region", F.coalesce("p", F.lit(0)), F.col("p").isNull()).alias("region"), "class")
    # members about equally far from each other: those outside the largest joined group meet all others in tiles
    stuck = at.join(parted.where("not parts"), "region").select("region", "class", "label", "ds")
    size = stuck.groupBy("region", "label").agg(F.count("*").alias("size"))
    size = size.groupBy("region").agg(F.max_by("label", F.struct("size", "label")).alias("most"), F.sum("size").alias("n"), F.max("size").alias("joined"))
    stuck = stuck.join(size.where("joined < n"), "region").withColumn("rest", F.col("label") != F.col("most"))
    stuck = stuck.withColumn("rows", F.greatest(F.lit(1), F.ceil((F.col("n") - F.col("joined")) / BLOCK)).cast("int")).withColumn("columns", F.ceil(F.col("n") / BLOCK).cast("int"))
    row, column = F.expr("cast(pmod(xxhash64(class, 7), rows) as int)"), F.expr("cast(pmod(xxhash64(class, 8), columns) as int)")
    stuck = stuck.select("region", "class", "label", "rest", "ds", "rows", "columns", row.alias("row"), column.alias("column")).join(sketches, "class")
    x = stuck.where("rest").withColumn("column", F.explode(F.sequence(F.lit(0), F.col("columns") - 1))).alias("x")
    y = stuck.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).alias("y")
    near = f"not exists(x.ds, v -> exists(y.ds, w -> w.p = v.p and (v.low - w.up > {radius + CLOSE} or w.low - v.up > {radius + CLOSE})))"
    both = x.join(y, F.expr("x.region = y.region and x.row = y.row and x.column = y.column and x.label <> y.label and (x.class < y.class or not y.rest)"))
    both = both.where(f"{alike(percent)} and {near}")
    return both.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")), cells, [at, parted]
