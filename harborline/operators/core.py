"""Joins, concordances and vintages as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def year_over_year(fact: DataFrame, keys: list[str], value: str, month: str = "yyyymm") -> DataFrame:
    """Each row with its value a year earlier, by an equi-join on the keys and the month moved by 100."""
    before = fact.select(*keys, (F.col(month) + 100).alias(month), F.col(value).alias("prev"))
    return fact.select(*keys, month, F.col(value).alias("cur")).join(before, [*keys, month])


def concord(fact: DataFrame, concordance: DataFrame, values: list[str], version: Column, period: list[str]) -> DataFrame:
    """Values by current code: weights split each past code's sum; codes without a map stay as they are.

    The fact is summed to (period, code, version) first, so the join meets each code once a period, not every detail row.
    """
    small = fact.withColumn("version", version).groupBy(*period, "hs10", "version").agg(*[F.sum(v).alias(v) for v in values])
    c = concordance.select(F.col("hs_past").alias("hs10"), F.col("past_version").alias("version"), "hs2022", "weight")
    joined = small.join(c, ["hs10", "version"], "left")
    return joined.groupBy(*period, F.coalesce("hs2022", "hs10").alias("hs10")).agg(*[F.sum(F.col(v) * F.coalesce("weight", F.lit(1.0))).alias(v) for v in values])


def dominant_successor(concordance: DataFrame) -> DataFrame:
    """The current code with the greatest weight for each past code; ties go to the smaller code."""
    w = Window.partitionBy("hs_past", "past_version").orderBy(F.desc("weight"), F.asc("hs2022"))
    return concordance.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def latest(vintages: DataFrame, keys: list[str], seen: str = "fetched_at") -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(seen))
    return vintages.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def vintage_delta(known: DataFrame, new: DataFrame, keys: list[str], value: str, tolerance: float = 0.0, seen: str = "fetched_at") -> DataFrame:
    """Rows of `new` whose key is unknown or whose value differs from the latest known one by more than `tolerance`."""
    old = latest(known, keys, seen).select(*keys, F.col(value).alias("old"))
    joined = new.join(old, keys, "left")
    return joined.where(F.col("old").isNull() | (F.abs(F.col("old") - F.col(value)) > tolerance)).drop("old")


def increments(cumulative: DataFrame, keys: list[str], value: str, before: dict[int, int]) -> DataFrame:
    """Cumulative values with their increments: each cut-off less the one before it (`before`: cut-off -> earlier one)."""
    step = F.lit(None).cast("int")
    for cutoff, earlier in before.items():
        step = F.when(F.col("cutoff") == cutoff, F.lit(earlier)).otherwise(step)
    past = cumulative.select(*keys, F.col("cutoff").alias("step"), F.col(value).alias("past"))
    joined = cumulative.withColumn("step", step).join(past, [*keys, "step"], "left")
    return joined.select(*keys, "cutoff", (F.col(value) - F.coalesce("past", F.lit(0))).alias("seg_kusd"), F.col(value).alias("cum_kusd"))


def carry_forward(df: DataFrame, group: list[str], order: str, columns: list[str], reset: Column | None = None) -> DataFrame:
    """Blanks take the last value above them in their group; where `reset` holds, what came before no longer counts."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_part", F.sum(F.when(reset, 1).otherwise(0)).over(w) if reset is not None else F.lit(0))
    inner = Window.partitionBy(*group, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.select(*[F.last(c, ignorenulls=True).over(inner).alias(c) if c in columns else F.col(c) for c in df.columns if c != "_part"])


def fill_hierarchy(df: DataFrame, group: list[str], order: str, levels: list[str]) -> DataFrame:
    """Cells of nested levels that are blank (null) take the last value above them in their group, unless an upper level changed since.

    levels: from the upper to the deeper. A row that has an upper level's value forgets the deeper ones of the rows above,
    its own deeper cells stand. A group is one table's rows.
    """
    upper = F.lit(False)
    for level in levels:
        df = carry_forward(df.withColumn("_upper", upper), group, order, [level], F.col("_upper")) if level != levels[0] else carry_forward(df.withColumn("_upper", upper).withColumns({f"_own_{c}": F.col(c).isNotNull() for c in levels}), group, order, [level])
        upper = upper | F.col(f"_own_{level}")
    return df.drop("_upper", *[f"_own_{c}" for c in levels])


def enclosing(df: DataFrame, group: list[str], order: str, code: str, name: str, lengths: tuple[int, ...] = (2, 4, 6, 8)) -> DataFrame:
    """df with `path`: the names of the headings that enclose each row of a printed list, from the outermost, and its own.

    A heading of a length holds until a row that is no longer than it, or one whose code does not begin with its code.
    """
    size, within = F.length(code), Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    for k in lengths:
        df = df.withColumn(f"_seg{k}", F.sum(F.when(size <= k, 1).otherwise(0)).over(within))
        inner = Window.partitionBy(*group, f"_seg{k}").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        head = F.first(F.when(size == k, F.struct(F.col(code).alias("code"), F.col(name).alias("name")))).over(inner)
        df = df.withColumn(f"_head{k}", head)
        holds = F.min(F.coalesce(F.col(code).startswith(F.col(f"_head{k}.code")), F.lit(False))).over(inner)
        df = df.withColumn(f"_name{k}", F.when(holds & (size > k), F.col(f"_head{k}.name")))
    path = F.concat_ws(" ", *[f"_name{k}" for k in lengths], name)
    return df.withColumn("path", path).drop(*[f"_{x}{k}" for k in lengths for x in ("seg", "head", "name")])
