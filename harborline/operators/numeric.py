"""Regressions, forecasts, trends and breaks, a group of a series at a time."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import components, kernels

# Fixed values of the elasticities and forecasts: p of an elasticity in use, widening of forecast bounds.
USED, WIDEN = 0.10, 1.1
# Fixed values of the one-step forecast: least rows of a month's effect, weight and number of the last residuals.
MONTH_ROWS, CARRY, RECENT = 3, 0.75, 6


# Columns of a scope: value, a year earlier, workdays, a year earlier.
SCOPES = {"seg": ("seg_kusd", "p_seg", "workdays", "p_workdays"), "cum": ("cum_kusd", "p_cum", "cum_workdays", "p_cum_workdays")}


def elasticities(lagged: DataFrame, asof: int | None = None, lags: int = 12, least: int = 24, scope: str = "seg") -> DataFrame:
    """(series, item, beta, se, t, p, n, r2, resid_sd, beta_used): growth on workday growth over twelve months, cut-offs pooled.

    Scope `seg` takes increments, `cum` cumulative values and workdays. A task holds one series' item.
    """
    y, p, w, q = SCOPES[scope]
    x = lagged.select("series", "item", "cutoff", "base_ym", *[F.col(c).alias(n) for c, n in zip((y, p, w, q), ("y", "p", "w", "q"), strict=True)]).where("y > 0 and p > 0 and w > 0 and q > 0")
    if asof is not None:
        x = x.where(F.col("base_ym") <= asof)

    def fit(pdf):
        import pandas as pd

        if len(pdf) < least:
            return pdf[["series", "item"]].iloc[:0].assign(**dict.fromkeys(("beta", "se", "t", "p"), 0.0), n=0, r2=0.0, resid_sd=0.0, beta_used=0.0)
        pdf = pdf.sort_values(["cutoff", "base_ym"])
        r = kernels.slope(np.log(pdf.y.to_numpy(float) / pdf.p.to_numpy(float)), np.log(pdf.w.to_numpy(float) / pdf.q.to_numpy(float)), lags)
        return pd.DataFrame([{"series": pdf.series.iloc[0], "item": pdf.item.iloc[0], **r, "beta_used": r["beta"] if r["p"] < USED else 0.0}])

    return x.groupBy("series", "item").applyInPandas(fit, "series string, item string, beta double, se double, t double, p double, n long, r2 double, resid_sd double, beta_used double")


def expanding_forecast(features: DataFrame, least: int = 36) -> DataFrame:
    """One-step forecasts of the month's total from its first days, each from the months before it.

    features: series, item, cutoff, base_ym, cum_kusd, act, lwr, lr. Slope and constant of every prefix come from running
    moments, in one pass of a window. The prediction adds the mean residual of the calendar month (of MONTH_ROWS rows at
    least) and a part of the last residuals' mean. A level is cum_kusd over the exponential of a log ratio: a high quantile
    of the ratio's residuals, less their months' means, gives a lower bound.
    """
    before = Window.partitionBy("series", "item", "cutoff").orderBy("base_ym").rowsBetween(Window.unboundedPreceding, -1)
    known = F.col("lr").isNotNull() & F.col("act").isNotNull()
    y, x, month = F.when(known, F.col("lr")), F.when(known, F.col("lwr")), (F.col("base_ym") % 100).cast("int")
    f = features.select("*", month.alias("mon"), F.count(y).over(before).alias("n"), F.regr_slope(y, x).over(before).alias("b"), F.regr_intercept(y, x).over(before).alias("a"),
                        F.collect_list(F.when(known, F.struct(month.alias("mon"), "lr", "lwr"))).over(before).alias("past"))
    f = f.where((F.col("n") >= least) & (F.col("cum_kusd") > 0))
    f = f.withColumn("e", F.transform("past", lambda r: F.struct(r.mon.alias("mon"), (r.lr - F.col("a") - F.col("b") * r.lwr).alias("e"))))

    def effect(m):
        mine = F.filter("e", lambda r: r.mon == m)
        return F.when(F.size(mine) >= MONTH_ROWS, F.aggregate(mine, F.lit(0.0), lambda s, r: s + r.e) / F.size(mine)).otherwise(0.0)

    f = f.withColumn("effects", F.transform(F.sequence(F.lit(1), F.lit(12)), effect))
    last = F.slice("e", -RECENT, RECENT)
    drift = CARRY * F.aggregate(last, F.lit(0.0), lambda s, r: s + r.e) / F.size(last)
    f = f.withColumn("pred", F.col("a") + F.col("b") * F.col("lwr") + F.get("effects", F.col("mon") - 1) + drift)
    f = f.withColumn("r", F.array_sort(F.transform("e", lambda r: r.e - F.get("effects", r.mon - 1))))

    def level(q):
        at = (F.col("n") - 1) * q
        low, high = F.get("r", F.floor(at).cast("int")), F.get("r", F.ceil(at).cast("int"))
        return F.col("cum_kusd") / F.exp(F.col("pred") + WIDEN * (low + (high - low) * (at - F.floor(at))))

    bounds = {"lo80": 0.9, "lo50": 0.75, "hi50": 0.25, "hi80": 0.1}
    return f.select("series", "item", "cutoff", "base_ym", (F.col("cum_kusd") / F.exp("pred")).alias("fc"), *[level(q).alias(c) for c, q in bounds.items()], F.col("act").cast("double").alias("act"))


def trend(series: DataFrame, key: str, order: str, value: str, smoothing: float = 129600.0) -> DataFrame:
    """(key, order, value, trend) with the smooth trend of each series' logarithm."""

    def run(pdf):
        pdf = pdf.sort_values(order)
        return pdf.assign(trend=kernels.hp_trend(np.log(pdf[value].to_numpy(float)), smoothing))[[key, order, value, "trend"]]

    return series.where(F.col(value) > 0).select(key, order, value).groupBy(key).applyInPandas(run, f"{key} string, {order} int, {value} double, trend double")


def breaks(series: DataFrame, key: str, order: str, value: str, least: int = 24, most: int = 5) -> DataFrame:
    """(key, n_bic, n_lwz, sup_f, breaks, breaks_bic, phases): shifts of the mean of each series.

    Breaks are the values of `order` at which a phase begins, by the modified criterion and by Schwarz's; phases are the
    means of y between the former.
    """

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values(order)
        r = kernels.mean_breaks(pdf[value].to_numpy(float), least, most)
        at = lambda rows: [int(pdf[order].iloc[i]) for i in rows]
        return pd.DataFrame([{key: pdf[key].iloc[0], "n_bic": r["n_bic"], "n_lwz": r["n_lwz"], "sup_f": r["sup_f"], "breaks": at(r["lwz"]), "breaks_bic": at(r["bic"]), "phases": r["phases"]}])

    return series.select(key, order, value).groupBy(key).applyInPandas(run, f"{key} string, n_bic int, n_lwz int, sup_f double, breaks array<int>, breaks_bic array<int>, phases array<double>")


def seasonal_trend(series: DataFrame, key: str, order: str, value: str, period: int = 12, seasonal: int = 13) -> DataFrame:
    """(key, order, value, seasonal, trend, remainder) by local regression, robust to outliers, a series at a time.

    Values stand at equal steps of `order`. A series shorter than two periods has its mean as trend and no seasonal part.
    """

    def run(pdf):
        pdf = pdf.sort_values(order)
        y = pdf[value].to_numpy(float)
        s, t = kernels.stl(y, period, seasonal)
        return pdf.assign(seasonal=s, trend=t, remainder=y - s - t)

    return series.select(key, order, value).dropna().groupBy(key).applyInPandas(run, f"{key} string, {order} int, {value} double, seasonal double, trend double, remainder double")


def unobserved(series: DataFrame, key: str, order: str, value: str, together: int = 64) -> DataFrame:
    """(key, order, value, level, slope, cycle, noise, period, loglik): unobserved components by maximum likelihood.

    About `together` series are searched at once in a task, by whole arrays. Steps of `order` are whole numbers; those that
    lack are months without a value. Rows with a null value are left out.
    """
    whole = series.select(key, order, value).dropna()
    buckets = max(1, -(-whole.select(key).distinct().count() // together))

    def run(pdf):
        names, at = pdf[key].unique(), pdf[order].min()
        y = np.full((len(names), int(pdf[order].max() - at) + 1), np.nan)
        i = pdf[key].map({n: i for i, n in enumerate(names)}).to_numpy()
        j = (pdf[order] - at).to_numpy(int)
        y[i, j] = pdf[value]
        r = components.fit(y)
        out = pdf[[key, order, value]].assign(**{c: r[c][i, j] for c in ("level", "slope", "cycle")})
        return out.assign(noise=out[value] - out.level - out.cycle, period=r["period"][i], loglik=r["loglik"][i])

    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    columns = ("level", "slope", "cycle", "noise", "period", "loglik")
    return whole.groupBy(bucket.alias("bucket")).applyInPandas(run, f"{key} string, {order} int, {value} double, " + ", ".join(f"{c} double" for c in columns))


def trend_methods(series: DataFrame, key: str, order: str, value: str, lag: int = 12) -> DataFrame:
    """A row for each series: how the growth over `lag` steps of three trends (ucm, hp, stl) agrees.

    Rows: n, corr_ucm_hp, corr_ucm_stl, corr_hp_stl, sd_* of each growth and of the series' own, flips_* (changes of sign).
    """
    whole = series.select(key, order, value).dropna()

    def others(pdf):
        pdf = pdf.sort_values(order)
        y = pdf[value].to_numpy(float)
        return pdf.assign(hp=kernels.hp_trend(y), stl=kernels.stl(y)[1])

    both = whole.groupBy(key).applyInPandas(others, f"{key} string, {order} int, {value} double, hp double, stl double")
    t = both.join(unobserved(whole, key, order, value).select(key, order, F.col("level").alias("ucm")), [key, order])
    names = {"y": value, "hp": "hp", "stl": "stl", "ucm": "ucm"}
    past = t.select(key, (F.col(order) + lag).alias(order), *[F.col(c).alias(f"p_{n}") for n, c in names.items()])
    g = t.join(past, [key, order]).select(key, order, *[(F.col(c) - F.col(f"p_{n}")).alias(f"g_{n}") for n, c in names.items()])
    w = Window.partitionBy(key).orderBy(order)
    for n in ("hp", "stl", "ucm"):
        g = g.withColumn(f"f_{n}", (F.signum(f"g_{n}") != F.lag(F.signum(f"g_{n}")).over(w)).cast("int"))
    corr = [F.corr(f"g_{a}", f"g_{b}").alias(f"corr_{a}_{b}") for a, b in (("ucm", "hp"), ("ucm", "stl"), ("hp", "stl"))]
    return g.groupBy(key).agg(F.count("*").alias("n"), *corr, *[F.stddev(f"g_{n}").alias(f"sd_{n}") for n in names], *[F.coalesce(F.sum(f"f_{n}"), F.lit(0)).alias(f"flips_{n}") for n in ("hp", "stl", "ucm")])
