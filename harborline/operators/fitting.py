"""Weights between two editions of codes: licensed links, their connected groups, proportional fitting to both margins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns, kernels
from ..sources.store import discard, written
from . import graph

# Fixed values of the fitting's prior: the power of the name similarity, and what every licensed link has at least.
POWER, FLOOR = 8.0, 1e-6
STEPS, LEAST_SHARE = 400, 1e-4  # fixed: rounds of fitting, the share a link must pass


def priors(links: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """(hs_from, hs_to, prior) of links (hs_from, hs_to) by names (hs10, leaf, path) of both editions.

    A code's own link has the full weight; others have their names' similarity to a power. Names are compared by letters and
    digits only, each pair of names once.
    """
    for side, names, a, b in (("hs_from", before, "a", "pa"), ("hs_to", after, "b", "pb")):
        links = links.join(names.select(F.col("hs10").alias(side), columns.letters(F.col("leaf")).alias(a), columns.letters(F.col("path")).alias(b)), side, "left")
    moved = F.col("hs_from") != F.col("hs_to")
    links = links.fillna("", ["a", "b", "pa", "pb"])
    near = links.where(moved).select("a", "b", "pa", "pb").distinct().withColumn("near", columns.similarity()("a", "b", "pa", "pb"))
    links = links.join(near, ["a", "b", "pa", "pb"], "left")
    return links.select("hs_from", "hs_to", F.when(~moved, F.lit(1 + FLOOR)).otherwise(F.pow(F.coalesce("near", F.lit(0.0)), F.lit(POWER)) + FLOOR).alias("prior"))


def groups(links: DataFrame) -> DataFrame:
    """(side, hs10, grp): the codes of links by the connected group they fall in, named by its least code.

    The same code is two nodes, one of either edition. Margins of a group can be fitted without the others.
    """
    found = graph.parts(links.select(F.concat(F.lit("a"), "hs_from").alias("a"), F.concat(F.lit("b"), "hs_to").alias("b")))
    return found.select(F.substring("node", 1, 1).alias("side"), F.expr("substring(node, 2)").alias("hs10"), F.expr("substring(part, 2)").alias("grp"))


def margins(links: DataFrame, before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hs_from, row_margin) and (hs_to, col_margin) from values (hs10, v): all positive, columns scaled to the rows' total."""
    sides = []
    for side, values in (("hs_from", before), ("hs_to", after)):
        sides.append(links.select(side).distinct().join(values.select(F.col("hs10").alias(side), F.col("v").cast("double").alias("v")), side, "left").fillna(0.0, ["v"]))
    rows, cols = sides
    of = rows.agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("rs"), F.count("*").alias("n")).join(cols.agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("cs"), F.count("*").alias("m")))  # one row each
    of = of.withColumn("eps", F.greatest("rs", F.lit(1.0)) * 1e-9)
    of = F.broadcast(of.withColumn("scale", (F.col("rs") + F.col("n") * F.col("eps")) / (F.col("cs") + F.col("m") * F.col("eps"))))
    rows = rows.join(of).select("hs_from", (F.col("v") + F.col("eps")).alias("row_margin"))
    return rows, cols.join(of).select("hs_to", ((F.col("v") + F.col("eps")) * F.col("scale")).alias("col_margin"))


def _fit_bucket(steps: int):
    def run(table):
        import pyarrow as pa

        table = table.combine_chunks()
        codes = [table[c].combine_chunks().dictionary_encode() for c in ("hs_from", "hs_to")]
        i, j = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in codes)
        row, col = (np.zeros(len(c.dictionary)) for c in codes)
        row[i], col[j] = table["row_margin"].to_numpy(), table["col_margin"].to_numpy()
        mass = kernels.ipf(table["prior"].to_numpy(), row, col, i, j, steps)
        return table.select(["hs_from", "hs_to", "prior", "grp"]).append_column("mass", pa.array(mass))

    return run


def _rounds(links: DataFrame, steps: int, every: int = 4, tolerance: float = 1e-13) -> DataFrame:
    """Fitting of groups of any size: each half of a round sums a side's links and joins the sums to them.

    Links are written every few rounds; rounds end early once none changes a link by more than `tolerance` of itself.
    """
    def half(x, side, margin):
        total = x.groupBy(side).agg(F.sum("mass").alias("total"))
        return x.join(total, side).withColumn("mass", F.when(F.col("total") > 0, F.col("mass") * F.col(margin) / F.col("total")).otherwise(0.0)).drop("total")

    state = written(links.withColumn("mass", F.col("prior")).withColumn("change", F.lit(1.0)), "masses")
    done = 0
    while done < steps:
        x = state
        for _ in range(min(every, steps - done)):
            last = F.col("mass").alias("last")
            x = half(half(x.select("hs_from", "hs_to", "prior", "grp", "row_margin", "col_margin", "mass", last), "hs_from", "row_margin"), "hs_to", "col_margin")
            done += 1
        new = written(x.withColumn("change", F.abs(F.col("mass") - F.col("last")) / F.greatest("last", F.lit(1e-300))).drop("last"), "masses")
        discard(state)
        state = new
        if (state.agg(F.max("change")).first()[0] or 0.0) <= tolerance:
            break
    return state.select("hs_from", "hs_to", "prior", "grp", "mass")


def masses(links: DataFrame, before: DataFrame, after: DataFrame, steps: int = STEPS, most: int = 4_000_000, together: int = 200_000, found: DataFrame | None = None) -> DataFrame:
    """(hs_from, hs_to, prior, grp, mass), written: links (hs_from, hs_to, prior) fitted to values (hs10, v) before and after.

    Sums of a source's and of a target's masses approach their margins; targets' are met last. Connected groups of up to
    `most` links, which a task holds as numbers (some 100 bytes a link), are fitted in a task, small ones many at a time, about
    `together` links; greater ones in rounds of joins. found: the groups as `groups` gives them, if they are known.
    """
    links = written(links, "links")
    rows, cols = margins(links, before, after)
    of = (groups(links) if found is None else found).where("side = 'a'").select(F.col("hs10").alias("hs_from"), "grp")
    whole = written(links.join(of, "hs_from").join(rows, "hs_from").join(cols, "hs_to"), "linked")
    sizes = written(whole.groupBy("grp").agg(F.count("*").alias("n")), "sizes")
    few = sizes.where(F.col("n") <= most)
    buckets = int(4 * (few.agg(F.sum("n")).first()[0] or 0) // together) + 1
    held = whole.join(few.select("grp"), "grp").withColumn("bucket", F.pmod(F.xxhash64("grp"), F.lit(buckets)))
    columns = ("hs_from", "hs_to", "prior", "grp", "mass")
    out = held.groupBy("bucket").applyInArrow(_fit_bucket(steps), "hs_from string, hs_to string, prior double, grp string, mass double").select(*columns)
    great = sizes.where(F.col("n") > most)
    if great.limit(1).count():
        out = out.union(_rounds(whole.join(great.select("grp"), "grp"), steps).select(*columns))
    return written(out, "fitted")


def weights(fitted: DataFrame) -> DataFrame:
    """(hs_from, hs_to, grp, weight, score, relation) of masses: weight is the share of the source.

    Shares up to LEAST_SHARE are left out and the rest scaled up. score is the similarity behind the prior.
    """
    def shares(x, value):
        total = x.groupBy("hs_from").agg(F.sum(value).alias("total"))
        return x.join(total, "hs_from").withColumn("weight", F.when(F.col("total") > 0, F.col(value) / F.col("total")).otherwise(0.0)).drop("total")

    kept = shares(fitted, "mass").where(F.col("weight") > LEAST_SHARE)
    out = shares(kept.withColumnRenamed("weight", "share"), "share")
    score = F.pow(F.greatest(F.col("prior") - FLOOR, F.lit(0.0)), F.lit(1 / POWER))
    relation = F.when(F.col("hs_from") == F.col("hs_to"), "identity").otherwise("moved")
    return out.select("hs_from", "hs_to", "grp", "weight", score.alias("score"), relation.alias("relation"))
