"""Connected parts of a graph, by grouped minima and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import discard, written


def parts(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 100) -> DataFrame:
    """(node, part): the smallest node that each node of an edge reaches, itself included.

    A round gives every node the least label of its neighbours, then the label of its label, so labels travel ever longer
    ways. Labels are written after each round; rounds end when none changes. Edges with a null are ignored.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    e = written(e.union(e.select("b", "a")).toDF("node", "near").distinct(), "edges")
    label = written(e.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("part")), "labels")
    for _ in range(rounds):
        least = e.join(label.select(F.col("node").alias("near"), "part"), "near").groupBy("node").agg(F.min("part").alias("low"))
        step = label.join(least, "node").select("node", F.col("part").alias("before"), F.least("part", "low").alias("part"))
        jump = step.alias("s").join(label.select(F.col("node").alias("at"), F.col("part").alias("further")).alias("l"), F.col("s.part") == F.col("l.at"))
        new = written(jump.select("node", "before", F.least("part", "further").alias("part")), "labels")
        changed = new.where("part <> before").limit(1).count()
        discard(label)
        label = new
        if not changed:
            return new.select("node", "part")
    raise RuntimeError(f"parts did not settle in {rounds} rounds")
