"""Connected components: by alternating star contraction, DataFrames only, or by forests of partitions, with fewer shuffles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Of undirected edges, (node, component): every node in an edge with the smallest node it reaches.

    Large-star and small-star steps (each a grouped minimum, combined before the shuffle, and a join) until
    nothing changes; each step's edges are written to the shared folder. Loops, repeated edges and nulls in an
    edge are ignored; no edges give no rows. Any ordered node type will do.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    before = _state(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = e.union(e.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # every edge of `large` points from the greater node to the smaller one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b").where("a <> b").distinct()
        e = written(small, "edges")
        after = _state(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    pairs = e.groupBy("a").agg(F.min("b").alias("b"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(pairs.select("b", "b").distinct())


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index each of n points reaches by edges (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for at in (a, b, root[a], root[b]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _forest(batches, name_a: str, name_b: str, step: int = 1 << 20):
    """Of the edges of a partition: its nodes and the smallest node each reaches in it; merged as they come, so nodes bound memory."""
    none = np.zeros(0, np.int64)
    node, root, more, waiting = none, none, [], 0

    def merged():
        a = np.concatenate([node, *[x for x, _ in more]])
        b = np.concatenate([root, *[y for _, y in more]])
        ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
        return ids, ids[roots(len(ids), at[: len(a)], at[len(a) :])]

    for batch in batches:
        more.append(tuple(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (name_a, name_b)))
        waiting += len(more[-1][0])
        if waiting >= step:
            node, root = merged()
            more, waiting = [], 0
    return merged()


def _local(batches):
    import pyarrow as pa

    node, root = _forest(batches, "a", "b")
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["node", "root"])


def _home(batches):
    """Every node's trees meet in its own partition: what each stands for there, and the edges that other partitions need."""
    import pyarrow as pa

    homes, tops = [], []

    def seen():
        for batch in batches:
            node, root = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("node", "root"))
            homes.append(np.unique(node))
            tops.append(np.unique(node[node == root]))
            yield batch

    ids, rep = _forest(seen(), "node", "root")
    none = np.zeros(0, np.int64)
    own = np.isin(ids, np.concatenate([none, *homes]))
    top = np.isin(ids, np.concatenate([none, *tops]))
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(rep), pa.array(own), pa.array((ids != rep) & (~own | top))], ["id", "rep", "own", "edge"])


def joined_forests(edges: DataFrame, a: str = "a", b: str = "b", before: int | None = None) -> DataFrame:
    """The same result as `components` for long nodes, in fewer shuffles; the nodes' work is done in tasks with numpy.

    Each task finds the trees of its edges; a shuffle brings a node's trees together, at most one row from each task,
    however many edges the node has. Trees' roots that meet are the edges of a smaller graph, solved alike; a graph that
    hardly shrinks goes to `components`. Each level is written to the shared folder.
    """
    e = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a is not null and b is not null and a <> b")
    home = written(e.mapInArrow(_local, "node long, root long").repartition("node").mapInArrow(_home, "id long, rep long, own boolean, edge boolean"), "forests")
    own = home.where("own").select(F.col("id").alias("node"), "rep")
    more = home.where("edge").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    left = more.count()
    if not left:
        return own.withColumnRenamed("rep", "component")
    inner = components(more) if before is not None and 2 * left > before else joined_forests(more, before=left)
    inner = inner.select(F.col("node").alias("rep"), "component")
    return own.join(inner, "rep", "left").select("node", F.coalesce("component", "rep").alias("component"))
