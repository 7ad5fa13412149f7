"""Queries built with DataFrame operators: self joins, concordances, vintages, numeric kernels."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns
from ..operators import core, factors, fitting, links, numeric, quantiles
from ..sources import files, sheets, versions
from ..sources.store import folder, written
from ..sources.trade import STORED, duck_text, frame, run
from ..streaming import state
from . import tenday
from .inference import robust

VERSION = "case when yyyymm < 199701 then 1995 when yyyymm < 199901 then 1997 when yyyymm < 200101 then 1999 else 2001 end"


def yoy_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.year_over_year(frame(spark, sf_dir, "fact_trade"), ["stat_cd", "hs10"], "exp_dlr")


def concord_to_2022(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = core.concord(frame(spark, sf_dir, "fact_trade"), frame(spark, sf_dir, "concordance"), ["exp_dlr", "imp_dlr"], F.expr(VERSION), ["yyyymm"])
    return out.select("yyyymm", "hs10", F.round("exp_dlr", 4).alias("exp_dlr"), F.round("imp_dlr", 4).alias("imp_dlr"))


def dominant_successor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core.dominant_successor(frame(spark, sf_dir, "concordance")).select("hs_past", "past_version", "hs2022", "weight")


def vintage_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = frame(spark, sf_dir, "exp10d")
    return core.vintage_delta(v.where("fetched_at = 1"), v.where("fetched_at = 2"), ["series", "base_ym", "cutoff", "item"], "amt_kusd").select("series", "base_ym", "cutoff", "item", "amt_kusd")


def stream_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second vintage's new and revised rows, found by a stream of both: latest values are kept in its state."""
    rows = written(frame(spark, sf_dir, "exp10d").select("series", "base_ym", "cutoff", "item", "fetched_at", "amt_kusd"), "vintages")
    out = f"{folder(spark)}/harborline-stream-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(rows.schema).parquet(rows._harborline_path)
    state.keep(stream, f"{out}/table", f"{out}/checkpoint", ["series", "base_ym", "cutoff", "item"], "amt_kusd").awaitTermination()
    return spark.read.parquet(f"{out}/table").where("fetched_at = 2").select("series", "base_ym", "cutoff", "item", "amt_kusd", "kind")


def exp10d_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = core.latest(frame(spark, sf_dir, "exp10d"), ["series", "base_ym", "cutoff", "item"])
    return core.increments(v, ["series", "base_ym", "item"], "amt_kusd", {20: 10, 99: 20}).select("series", "base_ym", "cutoff", "item", "seg_kusd", "cum_kusd")


def _betas(b: DataFrame) -> DataFrame:
    return b.select("series", "item", *[F.round(c, 7).alias(c) for c in ("beta", "se", "r2", "resid_sd")], "n")


def elasticity_hac(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elasticities of increments with robust errors; the operator gives p as well."""
    return _betas(numeric.elasticities(frame(spark, sf_dir, "lagged")))


def elasticity_cum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _betas(numeric.elasticities(frame(spark, sf_dir, "lagged"), scope="cum"))


def beta_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _betas(numeric.elasticities(frame(spark, sf_dir, "lagged"), asof=199912))


def weighted_beta_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items' elasticities weighted by their shares of the last twelve months against the total's own."""
    b = numeric.elasticities(frame(spark, sf_dir, "lagged")).select("series", "item", "beta")
    v = run(spark, sf_dir, "select series, item, sumb(seg_kusd) as v from segments where base_ym > 200011 and item <> 'TOTAL' group by 1, 2")
    parts = v.join(b, ["series", "item"]).groupBy("series").agg((F.sum(F.col("v") * F.col("beta")) / F.sum("v")).alias("weighted"))
    both = parts.join(b.where("item = 'TOTAL'").select("series", F.col("beta").alias("direct")), "series")
    return both.select("series", F.round("weighted", 7).alias("weighted"), F.round("direct", 7).alias("direct"), F.round(F.col("weighted") - F.col("direct"), 7).alias("gap"))


def forecast_expanding(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = numeric.expanding_forecast(run(spark, sf_dir, NOWCAST))
    return f.select("series", "item", "cutoff", "base_ym", *[F.round(c, 2).alias(c) for c in ("fc", "lo80", "lo50", "hi50", "hi80", "act")])


def hp_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = frame(spark, sf_dir, "group_month").select(F.col("grp").alias("series"), F.col("midx").cast("int").alias("midx"), F.col("v").cast("double").alias("v"))
    return numeric.trend(m, "series", "midx", "v")


def structural_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifts of the mean growth over twelve months."""
    m = run(spark, sf_dir, "select b.grp as series, cast(b.midx as int) as midx, ln(b.v / (a.v * 1e0)) as y from group_month a join group_month b on a.grp = b.grp and b.midx = a.midx + 12 where a.v > 0 and b.v > 0")
    return numeric.breaks(m, "series", "midx", "y")


def _codes(spark: SparkSession, sf_dir: str, digits: int) -> DataFrame:
    return written(links.codes(run(spark, sf_dir, "select edition, hs10 from editions where edition in (1999, 2001)"), 1999, 2001, digits), "codes")


def _heads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _codes(spark, sf_dir, 6), written(frame(spark, sf_dir, "heads").distinct(), "heads")


def _kinds(found: DataFrame) -> DataFrame:
    return found.select("hs_from", "hs_to", F.when(F.col("hs_from") == F.col("hs_to"), "self").otherwise("candidate").alias("kind"))


def _fitted(spark: SparkSession, sf_dir: str, by_factors, by_links) -> DataFrame:
    """Links from the codes of 1999 to those of 2001 that six-digit successors license, fitted to half a year's exports.

    by_factors takes them fitted as factors of codes, by_links as rows, which they are if they are fewer than the pairs of names.
    """
    names = "select e.hs10, e.name as leaf, k.item || ' ' || e.name as path from editions e join keyed k on k.hs10 = e.hs10 where e.edition = {}"
    heads = _heads(spark, sf_dir)
    names = tuple(run(spark, sf_dir, names.format(edition)) for edition in (1999, 2001))
    values = tuple(frame(spark, sf_dir, name) for name in ("before_value", "after_value"))
    found = factors.fit(*heads, names, values)
    if found is not None:
        return by_factors(found)
    return by_links(fitting.masses(fitting.priors(links.licensed(*heads), *names), *values, found=links.groups(*heads)))


def ipf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_links = lambda masses: fitting.weights(masses).select("hs_from", "hs_to", "weight", "score", "relation")
    return _fitted(spark, sf_dir, factors.weights, by_links)


def link_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The connected groups of licensed links, which are fitted apart."""
    return links.groups(*_heads(spark, sf_dir))


def licensed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kinds(links.licensed(*_heads(spark, sf_dir)))


def licensed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the codes below the same four digits."""
    return _kinds(links.within(_codes(spark, sf_dir, 4)))


def link_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.orphans(*_heads(spark, sf_dir))


def hs6_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traded past codes without a map, split over the current codes of their four digits by these codes' values.

    The sums that the shares need are those of four digits, so they are found before the codes meet.
    """
    traded = run(spark, sf_dir, "select distinct hs10, version from fact_versioned where version <> 2001 and exp_dlr + imp_dlr > 0")
    known = frame(spark, sf_dir, "concordance").select(F.col("hs_past").alias("hs10"), F.col("past_version").alias("version")).distinct()
    four = F.substring("hs10", 1, 4).alias("four")
    todo = written(traded.join(known, ["hs10", "version"], "left_anti").select(F.col("hs10").alias("hs_past"), "version", four), "todo")
    value = run(spark, sf_dir, "select hs10, sumb(exp_dlr + imp_dlr) as v from fact_trade where yyyymm >= 200101 group by 1")
    now = frame(spark, sf_dir, "dim_hs10").select("hs10").join(value, "hs10", "left").select(F.col("hs10").alias("hs2022"), four, F.coalesce("v", F.lit(0)).alias("v"))
    now = written(now, "current")
    now = now.join(now.groupBy("four").agg(F.sum("v").alias("tot"), F.count("*").alias("cnt")), "four")
    now = now.select("hs2022", "four", F.round(F.expr("case when tot > 0 then v / (tot * 1e0) else 1e0 / cnt end"), 10).alias("weight"))
    return links.pairs(todo, now, "four").select("hs_past", "version", "hs2022", "weight")


def fitted_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What fitted links bring to each code: its margin."""
    by_links = lambda masses: masses.groupBy("hs_to").agg(F.sum("mass").alias("mass"), F.count("*").alias("n_links"))
    return _fitted(spark, sf_dir, factors.targets, by_links).select("hs_to", F.round("mass", 2).alias("mass"), "n_links")


def diagonal_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.sum(F.when(F.col("hs_from") == F.col("hs_to"), F.col("mass")).otherwise(0.0))
    by_links = lambda masses: masses.agg((own / F.sum("mass")).alias("retention"), F.countDistinct("hs_from").alias("n_sources"))
    return _fitted(spark, sf_dir, factors.retention, by_links)


def version_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both facts by year in two versions of one store: as loaded, and after 1998 was loaded again with doubled exports.

    The second version brings both tables' year in one commit; the first can still be read.
    """
    store = versions.Versions(spark, f"{folder(spark)}/harborline-facts-{uuid.uuid4().hex}")
    detail, totals = frame(spark, sf_dir, "fact_trade"), frame(spark, sf_dir, "fact_total")
    store.replace_years({"detail": detail, "totals": totals})
    twice = lambda t: t.where("yyyymm div 100 = 1998").withColumn("exp_dlr", 2 * F.col("exp_dlr"))
    versions.reload_year(store, twice(detail), twice(totals), 1998)
    sums = [
        store.read(t, v).groupBy(F.lit(v).alias("version"), F.lit(t).alias("name"), F.expr("cast(yyyymm div 100 as int)").alias("yr")).agg(F.count("*").alias("n"), F.sum("exp_dlr").alias("exp_dlr"))
        for v in store.numbers() for t in ("detail", "totals")
    ]
    return functools.reduce(DataFrame.union, sums)


def unit_value_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles of each year's unit values, without a year's values in one task."""
    v = run(spark, sf_dir, "select yyyymm // 100 as yr, exp_dlr / (exp_wgt * 1e0) as v from fact_trade where exp_wgt > 0 and exp_dlr > 0")
    q = quantiles.quantiles(v, "yr", "v", [0.25, 0.5, 0.75])
    return q.groupBy("yr").agg(*[F.round(F.max(F.when(F.col("share") == s, F.col("q"))), 6).alias(n) for s, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])


def revision_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-digit codes of a printed list whose upper cells stand once: filled down, forgotten where an upper cell changes."""
    filled = core.fill_hierarchy(frame(spark, sf_dir, "printed"), ["chapter"], "i", ["l1", "l2", "l3"])
    code = F.concat("l1", "l2", "l3")
    return filled.select("chapter", "i", code.alias("code")).where(code.rlike("^[0-9]{10}$"))


def code_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the headings above each ten-digit code of a printed list."""
    rows = core.enclosing(frame(spark, sf_dir, "headed"), ["chapter"], "code", "code", "name")
    return rows.where("length(code) = 10").select("code", "path")


def spanned_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of pages, one a heading, whose six-digit cells span their codes' rows and whose rates a script fills."""
    rows = frame(spark, sf_dir, "keyed").select("hs10", F.substring("hs10", 1, 4).alias("page"), F.substring("hs10", 1, 6).alias("hs6"), (F.col("k") % 30).cast("string").alias("rate"))
    six = rows.groupBy("page", "hs6").agg(F.array_sort(F.collect_list(F.struct("hs10", "rate"))).alias("codes"))
    row = lambda c, i: F.concat(F.lit("<tr>"), F.when(i == 0, F.concat(F.lit("<th rowspan="), F.size("codes"), F.lit(">"), F.col("hs6"), F.lit("</th>"))).otherwise(""), F.lit("<td>"), c.hs10, F.lit("<td><span id=rate_"), c.hs10, F.lit("></span></td></tr>"))
    fill = lambda c: F.concat(F.lit('showID = "#rate_" + "'), c.hs10, F.lit('"; <span title="base"><a href="#"><span class="textColor">A</span> <span><a href="#">'), c.rate, F.lit("%</a>\n"))
    parts = six.select("page", "hs6", F.array_join(F.transform("codes", row), "").alias("rows"), F.array_join(F.transform("codes", fill), "").alias("script"))
    pages = parts.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("hs6", "rows", "script"))).alias("p"))
    html = F.concat(F.lit("<table>"), F.array_join(F.transform("p", lambda x: x.rows), ""), F.lit("</table><script>"), F.array_join(F.transform("p", lambda x: x.script), ""), F.lit("</script>"))
    pages = written(pages.select("page", html.alias("html")), "pages")
    grid = sheets.html_grid(pages, "page")
    cells = grid.groupBy("page", "row").agg(*[F.max(F.when(F.col("col") == i, F.col("text"))).alias(n) for i, n in enumerate(("hs6", "code"))], F.max(F.when(F.col("col") == 2, F.get("ids", F.lit(0)))).alias("cell"))
    return cells.join(sheets.script_cells(pages, "page"), ["page", "cell"]).select("page", "hs6", "code", F.col("value").alias("rate"))


def stl_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal and trend parts of each group's monthly logarithm."""
    m = frame(spark, sf_dir, "group_month").where("v > 0").select(F.col("grp").alias("series"), F.col("midx").cast("int").alias("midx"), F.ln(F.col("v").cast("double")).alias("y"))
    return numeric.seasonal_trend(m, "series", "midx", "y")


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "group_month").where("v > 0").select(F.col("grp").alias("series"), F.col("midx").cast("int").alias("midx"), F.ln(F.col("v").cast("double")).alias("y"))


def ucm_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smooth trend and cycle of each group's monthly logarithm, by maximum likelihood."""
    return numeric.unobserved(_logs(spark, sf_dir), "series", "midx", "y")


def trend_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth of three trends of each group side by side."""
    return numeric.trend_methods(_logs(spark, sf_dir), "series", "midx", "y")


def tariff_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each period of a rate text."""
    p = F.explode(columns.periods(F.col("txt")))
    return run(spark, sf_dir, PERIOD_TEXT).select("hs10", p.alias("p")).select("hs10", "p.value", "p.valid_from", "p.valid_to")


def growth_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = run(spark, sf_dir, "select b.yyyymm, b.x / (a.x * 1e0) - 1 as g from monthly a join monthly b on b.midx = a.midx + 12 where a.x > 0")
    return g.select(columns.month_label(F.col("yyyymm")).alias("month"), columns.percent(columns.away(F.col("g"), 6)).alias("growth"))


def param_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values bound to named parameters of a text."""
    text = "select yyyymm, stat_cd, sumb(exp_dlr) as exp_dlr from fact_trade where yyyymm between :first and :last and stat_cd = :country group by 1, 2"
    return run(spark, sf_dir, text, first=199901, last=199912, country="N01")


def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.columns_of(spark, {t: frame(spark, sf_dir, t) for t in STORED}).select("name", "column", "position")


def fact_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail fact against its columns; the status text and rank of responses must not be there."""
    expected = {"yyyymm": "int", "stat_cd": "string", "hs10": "string"} | dict.fromkeys(("exp_dlr", "imp_dlr", "exp_wgt", "imp_wgt", "bal_payments"), "bigint")
    return files.schema_check(frame(spark, sf_dir, "fact_trade"), expected, ("result_code", "rn"))


GROWTH = "select b.yyyymm, round(b.x / (a.x * 1e0) - 1, 6) as g from monthly a join monthly b on b.midx = a.midx + 12 where a.x > 0"
PERIOD_TEXT = """select hs10, case k % 3 when 0 then cast(k % 40 as string) || '%' when 1 then cast(k % 30 as string) || '% - (2000-01-01 ~ 2000-06-30) ' || cast(k % 20 as string) || '% - (2000-07-01 ~ )'
    else cast(k % 10 as string) || '%-(2000-03-01~2000-12-31)' end as txt from keyed"""

QUERIES = {f.__name__: f for f in (yoy_self_join, concord_to_2022, dominant_successor, vintage_delta, stream_delta, exp10d_segments, elasticity_hac, elasticity_cum, beta_asof, weighted_beta_gap, forecast_expanding, hp_trend, structural_breaks, ipf_weights, link_groups, licensed_links, licensed_pairs, link_orphans, hs6_fallback, fitted_columns, diagonal_retention, version_totals, unit_value_quantiles, revision_codes, code_paths, spanned_codes, stl_parts, ucm_parts, trend_methods, tariff_periods, growth_labels, param_filter, catalog_columns, fact_schema)}

NOWCAST = tenday.SQL["nowcast_features"]
BETAS = "select series, item, round(beta, 7) as beta, round(se, 7) as se, round(r2, 7) as r2, round(resid_sd, 7) as resid_sd, n from r"

ORACLES = {
    "yoy_self_join": "select a.stat_cd, a.hs10, a.yyyymm, a.exp_dlr as cur, b.exp_dlr as prev from fact_trade a join fact_trade b on a.stat_cd = b.stat_cd and a.hs10 = b.hs10 and a.yyyymm = b.yyyymm + 100",
    "concord_to_2022": "select f.yyyymm, coalesce(c.hs2022, f.hs10) as hs10, round(sum(f.exp_dlr * coalesce(c.weight, 1e0)), 4) as exp_dlr, round(sum(f.imp_dlr * coalesce(c.weight, 1e0)), 4) as imp_dlr from fact_versioned f left join concordance c on f.hs10 = c.hs_past and f.version = c.past_version group by 1, 2",
    "dominant_successor": "select hs_past, past_version, hs2022, weight from (select *, row_number() over (partition by hs_past, past_version order by weight desc, hs2022) as rn from concordance) x where rn = 1",
    "vintage_delta": "select n.series, n.base_ym, n.cutoff, n.item, n.amt_kusd from exp10d n left join exp10d o on n.series = o.series and n.base_ym = o.base_ym and n.cutoff = o.cutoff and n.item = o.item and o.fetched_at = 1 where n.fetched_at = 2 and (o.amt_kusd is null or o.amt_kusd <> n.amt_kusd)",
    "stream_delta": "select n.series, n.base_ym, n.cutoff, n.item, n.amt_kusd, case when o.amt_kusd is null then 'new' else 'revised' end as kind from exp10d n left join exp10d o on n.series = o.series and n.base_ym = o.base_ym and n.cutoff = o.cutoff and n.item = o.item and o.fetched_at = 1 where n.fetched_at = 2 and (o.amt_kusd is null or o.amt_kusd <> n.amt_kusd)",
    "elasticity_hac": robust(BETAS),
    "elasticity_cum": robust(BETAS, "cum"),
    "beta_asof": robust(BETAS, where="base_ym <= 199912"),
    "weighted_beta_gap": robust("""select w.series, round(w.weighted, 7) as weighted, round(t.beta, 7) as direct, round(w.weighted - t.beta, 7) as gap from (
        select v.series, sum(v.v * r.beta) / sum(v.v) as weighted from (select series, item, sumb(seg_kusd) as v from segments where base_ym > 200011 and item <> 'TOTAL' group by 1, 2) v
        join r on r.series = v.series and r.item = v.item group by v.series) w join r t on t.series = w.series and t.item = 'TOTAL'"""),
    "param_filter": "select yyyymm, stat_cd, sumb(exp_dlr) as exp_dlr from fact_trade where yyyymm between 199901 and 199912 and stat_cd = 'N01' group by 1, 2",
    "exp10d_segments": "select series, base_ym, cutoff, item, seg_kusd, cum_kusd from segments",
    "forecast_expanding": "with f as (" + NOWCAST + """),
        g as (select *, base_ym % 100 as mon from f),
        t as (select * from g where lr is not null and act is not null),
        o as (
          select o.series, o.item, o.cutoff, o.base_ym, o.cum_kusd, o.lwr, o.mon, o.act, count(*) as n, regr_slope(t.lr, t.lwr) as b, regr_intercept(t.lr, t.lwr) as a
          from g o join t on t.series = o.series and t.item = o.item and t.cutoff = o.cutoff and t.base_ym < o.base_ym where o.cum_kusd > 0 group by all having count(*) >= 36),
        e as (
          select o.*, t.mon as tmon, t.lr - o.a - o.b * t.lwr as e, row_number() over (partition by o.series, o.item, o.cutoff, o.base_ym order by t.base_ym desc) as back
          from o join t on t.series = o.series and t.item = o.item and t.cutoff = o.cutoff and t.base_ym < o.base_ym),
        m as (select series, item, cutoff, base_ym, tmon, case when count(*) >= 3 then avg(e) else 0 end as eff from e group by all),
        r as (
          select e.series, e.item, e.cutoff, e.base_ym, e.cum_kusd, e.act, e.a + e.b * e.lwr as fit, avg(e.e) filter (e.back <= 6) as recent, max(m.eff) filter (e.tmon = e.mon) as own,
            quantile_cont(e.e - m.eff, 0.9) as q90, quantile_cont(e.e - m.eff, 0.75) as q75, quantile_cont(e.e - m.eff, 0.25) as q25, quantile_cont(e.e - m.eff, 0.1) as q10
          from e join m on m.series = e.series and m.item = e.item and m.cutoff = e.cutoff and m.base_ym = e.base_ym and m.tmon = e.tmon group by all),
        p as (select *, fit + coalesce(own, 0) + 0.75 * recent as pred from r)
        select series, item, cutoff, base_ym, round(cum_kusd / exp(pred), 2) as fc, round(cum_kusd / exp(pred + 1.1 * q90), 2) as lo80, round(cum_kusd / exp(pred + 1.1 * q75), 2) as lo50,
          round(cum_kusd / exp(pred + 1.1 * q25), 2) as hi50, round(cum_kusd / exp(pred + 1.1 * q10), 2) as hi80, cast(act as double) as act from p""",
    "unit_value_quantiles": "select yyyymm // 100 as yr, round(pct(exp_dlr / (exp_wgt * 1e0), 25e-2), 6) as q25, round(pct(exp_dlr / (exp_wgt * 1e0), 5e-1), 6) as q50, round(pct(exp_dlr / (exp_wgt * 1e0), 75e-2), 6) as q75 from fact_trade where exp_wgt > 0 and exp_dlr > 0 group by 1",
    "revision_codes": "select substr(hs10, 1, 2) as chapter, row_number() over (partition by substr(hs10, 1, 2) order by hs10) as i, hs10 as code from keyed where regexp_matches(hs10, '^[0-9]{10}$')",
    "code_paths": "select k.code, concat_ws(' ', a.name, b.name, c.name, k.name) as path from headed k join headed a on a.code = substr(k.code, 1, 2) join headed b on b.code = substr(k.code, 1, 4) left join headed c on c.code = substr(k.code, 1, 6) where length(k.code) = 10",
    "spanned_codes": "select substr(hs10, 1, 4) as page, substr(hs10, 1, 6) as hs6, hs10 as code, cast(k % 30 as string) || '%' as rate from keyed",
    "version_totals": """with f as (select 'detail' as name, yyyymm, exp_dlr from fact_trade union all select 'totals', yyyymm, exp_dlr from fact_total)
        select v.version, f.name, cast(f.yyyymm // 100 as int) as yr, count(*) as n, sumb(case when v.version = 2 and f.yyyymm // 100 = 1998 then 2 * f.exp_dlr else f.exp_dlr end) as exp_dlr
        from f cross join (values (1), (2)) as v(version) group by 1, 2, 3""",
    "link_groups": """with recursive e as (select 'a' || hs_from as a, 'b' || hs_to as b from licensed union select 'b' || hs_to, 'a' || hs_from from licensed),
        reach(node, part) as (
          select a, least(a, min(b)) from e group by a
          union select e.b, r.part from reach r join e on e.a = r.node where r.part < e.b)
        select substr(node, 1, 1) as side, substr(node, 2) as hs10, substr(min(part), 2) as grp from reach group by node""",
    "fitted_columns": """with r as (select f.hs_from, coalesce(b.v, 0) * 1e0 as v from (select distinct hs_from from licensed) f left join before_value b on b.hs10 = f.hs_from),
        c as (select t.hs_to, t.n, coalesce(a.v, 0) * 1e0 as v from (select hs_to, count(*) as n from licensed group by 1) t left join after_value a on a.hs10 = t.hs_to),
        s as (select (select sum(v) from r) as rs, (select count(*) from r) as n, (select sum(v) from c) as cs, (select count(*) from c) as m),
        e as (select *, greatest(rs, 1) * 1e-9 as eps from s)
        select c.hs_to, round((c.v + e.eps) * ((e.rs + e.n * e.eps) / (e.cs + e.m * e.eps)), 2) as mass, c.n as n_links from c cross join e""",
}

_PERIOD = r"([^()~]*?)\s*-\s*\((\d{4}-\d{2}-\d{2})\s*~\s*(\d{4}-\d{2}-\d{2})?\)"

# texts in DuckDB's own functions
DUCK = {
    "tariff_periods": f"""select hs10, trim(case when m is null then txt else regexp_extract(m, '{_PERIOD}', 1) end) as value, try_cast(regexp_extract(m, '{_PERIOD}', 2) as date) as valid_from, try_cast(regexp_extract(m, '{_PERIOD}', 3) as date) as valid_to
        from (select hs10, txt, unnest(case when len(found) > 0 then found else [null] end) as m from (select hs10, txt, regexp_extract_all(txt, '{_PERIOD}') as found from ({duck_text(PERIOD_TEXT)}) t) u) v""",
    "growth_labels": f"""select printf('%04d.%02d', yyyymm // 100, yyyymm % 100) as month, printf('%+.1f%%', round(g * 100, 1)) as growth from ({duck_text(GROWTH)}) t""",
    "catalog_columns": f"""select table_name as name, column_name as "column", ordinal_position as position from information_schema.columns where table_name in ({', '.join(f"'{t}'" for t in STORED)})""",
    "fact_schema": "select * from (values ('yyyymm', 'ok'), ('stat_cd', 'ok'), ('hs10', 'ok'), ('exp_dlr', 'ok'), ('imp_dlr', 'ok'), ('exp_wgt', 'ok'), ('imp_wgt', 'ok'), ('bal_payments', 'ok')) as v(\"column\", status)",
}
