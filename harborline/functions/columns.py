"""Column expressions of the domain: months, periods, rate texts, name similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_index(ym: Column) -> Column:
    """Months since year 0 of a yyyymm integer."""
    return (F.floor(ym / 100) * 12 + ym % 100 - 1).cast("int")


def shift(ym: Column, months: int) -> Column:
    """yyyymm moved by a number of months."""
    at = month_index(ym) + months
    return (F.floor(at / 12) * 100 + at % 12 + 1).cast("int")


def cutoff_of(period: Column) -> Column:
    """10, 20 or 99 of a period text such as 01~10."""
    return F.when(period.endswith("10"), 10).when(period.endswith("20"), 20).otherwise(99)


def rate(text: Column) -> Column:
    """(ad valorem per cent, specific amount) of a rate text such as `270% or 6,210 won`."""
    number = lambda pattern: F.regexp_replace(F.regexp_extract(text, pattern, 1), ",", "")
    adval = F.when(number(r"([0-9][0-9.,]*)\s*%") != "", number(r"([0-9][0-9.,]*)\s*%").cast("double"))
    specific = F.when(number(r"([0-9][0-9,.]*)\s*(?:won|원)") != "", number(r"([0-9][0-9,.]*)\s*(?:won|원)").cast("double"))
    return F.struct(adval.alias("adval"), specific.alias("specific"))


# Fixed pattern of a rate with the days it holds: `value - (from ~ to)`, the last day open.
PERIOD = r"([^()~]*?)\s*-\s*\((\d{4}-\d{2}-\d{2})\s*~\s*(\d{4}-\d{2}-\d{2})?\)"


def periods(text: Column) -> Column:
    """(value, valid_from, valid_to) of each period in a text; the whole text without dates where it holds none."""
    part = lambda n: F.regexp_extract_all(text, F.lit(PERIOD), F.lit(n))
    split = F.transform(F.arrays_zip(part(1).alias("v"), part(2).alias("a"), part(3).alias("b")), lambda x: F.struct(F.trim(x["v"]).alias("value"), x["a"].try_cast("date").alias("valid_from"), x["b"].try_cast("date").alias("valid_to")))
    none = F.array(F.struct(text.alias("value"), F.lit(None).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to")))
    return F.when(F.size(split) > 0, split).otherwise(none)


def away(number: Column, digits: int) -> Column:
    """A double rounded by its binary value, halves away from zero, that keeps its sign where nothing is left: -0.0."""
    size = F.floor(F.abs(number) * 10.0**digits + 0.5) / 10.0**digits
    return F.when(number > 0, size).when(number < 0, -size).otherwise(number)


def percent(share: Column) -> Column:
    """A share as +x.x%; a fall that rounds to nothing is -0.0%."""
    return F.format_string("%+.1f%%", away(share * 100, 1))


def month_label(ym: Column) -> Column:
    """A yyyymm integer as YYYY.MM."""
    return F.format_string("%04d.%02d", F.floor(ym / 100), ym % 100)


def letters(text: Column) -> Column:
    """Letters and digits only."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}]", "")


def similarity():
    """A vectorised function (leaf, leaf, path, path) -> 0.6 and 0.4 weighted matching-block ratios."""
    from difflib import SequenceMatcher

    import pandas as pd

    def ratio(a, b, c, d):
        one = lambda x, y: SequenceMatcher(None, x or "", y or "").ratio()
        return pd.Series([0.6 * one(p, q) + 0.4 * one(r, s) for p, q, r, s in zip(a, b, c, d, strict=True)])

    ratio.__annotations__ = {**dict.fromkeys("abcd", pd.Series), "return": pd.Series}  # postponed annotations are texts, which pandas_udf cannot read
    return F.pandas_udf(ratio, "double")
