"""Trade-statistics tables built from the order tables: facts, dimensions, concordances, ten-day series, calendars.

Each table is one SQL text. `spark_text` and `duck_text` give a query over them for either engine, with the tables it
needs as common table expressions; in Spark they are inlined, so filters and columns reach the Parquet scans.

In texts: @name is a stored table, // integer division, sumb(x) a sum as bigint, pct(x, p) the interpolated percentile.

Tables that many queries share (`KEPT`) are written once for each input (`store`), in order of their months, and read from
there: a query scans the detail lines at most when it is the first to need them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

STORED = "region nation customer supplier part orders lineitem events".split()

# written once: columns, and the column that orders the rows of files
KEPT = {
    "fact_trade": ("yyyymm, stat_cd, hs10, exp_dlr, imp_dlr, exp_wgt, imp_wgt, bal_payments", "yyyymm"),
    "exp10d": ("series, base_ym, cutoff, item, fetched_at, amt_kusd", "base_ym"),
    "concordance": ("hs_past, past_version, hs2022, weight, relation", "hs_past"),
    "keyed": ("hs10, k, name, item, size", "k"),
}

FACT_LINES = 400_000  # detail lines that a task sums to the monthly fact

TABLES: dict[str, str] = {
    # one row per month, country and ten-digit code; money and weight by flow
    "codes": """select p_partkey, p_name, p_type, p_size,
        lpad(cast(case p_type when 'ECONOMY' then 1 when 'LARGE' then 2 when 'MEDIUM' then 3 when 'PROMO' then 4 when 'SMALL' then 5 else 6 end as string), 2, '0')
        || lpad(substr(p_brand, 7), 2, '0') || lpad(cast(p_size as string), 2, '0') || lpad(cast(p_partkey % 10000 as string), 4, '0') as hs10 from @part""",
    "ship": """select cast(year(l.l_shipdate) * 100 + month(l.l_shipdate) as int) as yyyymm, cast(day(l.l_shipdate) as int) as dom,
        'N' || lpad(cast(c.c_nationkey as string), 2, '0') as stat_cd, p.hs10, p.p_type as item, l.l_linestatus as status, l.l_returnflag as flag,
        cast(round(l.l_extendedprice) as bigint) as dlr, cast(l.l_quantity as bigint) as wgt
        from @lineitem l join @orders o on l.l_orderkey = o.o_orderkey join @customer c on o.o_custkey = c.c_custkey join codes p on l.l_partkey = p.p_partkey""",
    "fact_trade": """select yyyymm, stat_cd, hs10,
        sumb(case when flag <> 'R' then dlr else 0 end) as exp_dlr, sumb(case when flag = 'R' then dlr else 0 end) as imp_dlr,
        sumb(case when flag <> 'R' then wgt else 0 end) as exp_wgt, sumb(case when flag = 'R' then wgt else 0 end) as imp_wgt,
        sumb(case when flag = 'R' then -dlr else dlr end) as bal_payments
        from ship group by yyyymm, stat_cd, hs10""",
    # detail rolled up by country, and one provisional month that has no detail yet
    "fact_total": """select yyyymm, stat_cd, sumb(exp_dlr) as exp_dlr, sumb(imp_dlr) as imp_dlr, sumb(exp_wgt) as exp_wgt, sumb(imp_wgt) as imp_wgt, sumb(bal_payments) as bal_payments from fact_trade group by yyyymm, stat_cd
        union all select 200112, 'N' || lpad(cast(n_nationkey as string), 2, '0'), cast(1000 as bigint), cast(400 as bigint), cast(10 as bigint), cast(4 as bigint), cast(600 as bigint) from @nation""",
    "months": "select distinct yyyymm from fact_trade",
    # one call per month and country; one in 97 failed, one in 89 claims items that were not loaded
    "meta_calls": """select m.yyyymm, 'N' || lpad(cast(n.n_nationkey as string), 2, '0') as stat_cd, (m.yyyymm * 31 + n.n_nationkey) % 97 <> 0 as success,
        case when (m.yyyymm * 31 + n.n_nationkey) % 97 <> 0 then '00' else '99' end as result_code, cast(coalesce(f.n, case when (m.yyyymm + n.n_nationkey) % 89 = 0 then 3 else 0 end) as bigint) as item_count
        from months m cross join @nation n left join (select yyyymm, stat_cd, count(*) as n from fact_trade group by yyyymm, stat_cd) f
        on f.yyyymm = m.yyyymm and f.stat_cd = 'N' || lpad(cast(n.n_nationkey as string), 2, '0')""",
    "dim_country": """select 'N' || lpad(cast(n_nationkey as string), 2, '0') as stat_cd, n_name as name_en, case when n_nationkey % 11 = 10 then null else r_name end as continent from @nation join @region on n_regionkey = r_regionkey""",
    # every fourth code is abolished: traded, but not in the current list
    "dim_hs10": "select hs10, max(p_name) as name_ko, max(p_type) as kind from codes where p_partkey % 4 <> 0 group by hs10",
    "keyed": "select hs10, min(p_partkey) as k, max(p_name) as name, max(p_type) as item, max(p_size) as size from codes group by hs10",
    # the next code by k: within ranges of k, and from a range's last code to the first of the next, a row a range
    "range_first": "select k // 4096 as b, min_by(hs10, k) as code from keyed group by 1",
    "range_next": "select b, lead(code) over (order by b) as code from range_first",
    "chain_of": "select c.hs10, c.k, coalesce(lead(c.hs10) over (partition by c.k // 4096 order by c.k), n.code) as next_code from keyed c join range_next n on n.b = c.k // 4096",
    "versions": "select * from (values (1995, 199501, 199612, 0), (1997, 199701, 199812, 1), (1999, 199901, 200012, 2)) as v(past_version, from_ym, to_ym, shift)",
    # past codes to current ones: moved, split 0.7 / 0.3, deleted or the same
    "concordance": """select hs_past, past_version, hs2022, weight, case when hs_past = hs2022 and weight = 1 then 'identity' else 'mapped' end as relation from (
        select c.hs10 as hs_past, v.past_version, case when (c.k + v.shift) % 5 = 0 then c.next_code else c.hs10 end as hs2022, case when (c.k + v.shift) % 7 = 0 and (c.k + v.shift) % 5 <> 0 then 7e-1 else 1e0 end as weight
        from chain_of c cross join versions v where (c.k + v.shift) % 11 <> 0 and c.next_code is not null
        union all select c.hs10, v.past_version, c.next_code, 3e-1 from chain_of c cross join versions v where (c.k + v.shift) % 11 <> 0 and (c.k + v.shift) % 7 = 0 and (c.k + v.shift) % 5 <> 0 and c.next_code is not null) x""",
    "fact_versioned": "select *, case when yyyymm < 199701 then 1995 when yyyymm < 199901 then 1997 when yyyymm < 200101 then 1999 else 2001 end as version from fact_trade",
    # yearly editions of the code list with names
    "editions": """select e.edition, k.hs10, k.k, case when (k.k + e.edition) % 9 = 0 then k.name || ' (new)' when (k.k + e.edition) % 4 = 0 then replace(k.name, ' ', '  ') else k.name end as name
        from keyed k cross join (values (1995), (1997), (1999), (2001)) as e(edition) where (k.k + e.edition) % 13 <> 0""",
    # codes of six digits that the successors of past codes lead to, and the links between editions they license: a code may
    # move to any code below a linked six-digit one, but not if both codes are in both editions
    "hs6_links": "select distinct substr(hs_past, 1, 6) as hs6_past, substr(hs2022, 1, 6) as hs6 from concordance where past_version = 1999 and relation = 'mapped'",
    "alive": "select a.hs10 from editions a join editions b on a.hs10 = b.hs10 where a.edition = 1999 and b.edition = 2001",
    "heads": "select hs6_past, hs6 from hs6_links union select substr(hs10, 1, 6), substr(hs10, 1, 6) from editions where edition = 1999",
    "licensed": """select a.hs10 as hs_from, b.hs10 as hs_to from editions a join heads h on h.hs6_past = substr(a.hs10, 1, 6) join editions b on substr(b.hs10, 1, 6) = h.hs6
        left join alive x on x.hs10 = a.hs10 left join alive y on y.hs10 = b.hs10 where a.edition = 1999 and b.edition = 2001 and (a.hs10 = b.hs10 or x.hs10 is null or y.hs10 is null)""",
    "before_value": "select hs10, sum(exp_dlr) as v from fact_trade where yyyymm between 200007 and 200012 group by 1",
    "after_value": "select hs10, sum(exp_dlr) as v from fact_trade where yyyymm between 200101 and 200106 group by 1",
    "cutoffs": "select * from (values (10), (20), (99)) as c(cutoff)",
    # cumulative amounts by cut-off in two vintages: the second adds lines finished later
    "exp10d": """select s.series, s.base_ym, s.cutoff, s.item, cast(v.made as int) as fetched_at, sumb(case when v.made = 2 or s.status = 'O' then s.amt else 0 end) as amt_kusd from (
          select series, base_ym, cutoff, item, status, sumb(dlr) as amt from (
            select case when flag = 'R' then 'imp_item' else 'exp_item' end as series, yyyymm as base_ym, item, status, dlr, case when dom <= 10 then 10 when dom <= 20 then 20 else 99 end as bucket from ship
            union all select case when flag = 'R' then 'imp_item' else 'exp_item' end, yyyymm, 'TOTAL', status, dlr, case when dom <= 10 then 10 when dom <= 20 then 20 else 99 end from ship) b
          join cutoffs c on b.bucket <= c.cutoff where not (base_ym = 200111 and cutoff > 10) group by series, base_ym, cutoff, item, status) s
        cross join (values (1), (2)) as v(made) group by s.series, s.base_ym, s.cutoff, s.item, v.made""",
    "latest10d": "select series, base_ym, cutoff, item, amt_kusd from (select *, row_number() over (partition by series, base_ym, cutoff, item order by fetched_at desc) as rn from exp10d) x where rn = 1",
    "segments": """select c.series, c.base_ym, c.cutoff, c.item, c.amt_kusd - coalesce(p.amt_kusd, 0) as seg_kusd, c.amt_kusd as cum_kusd from latest10d c
        left join latest10d p on c.series = p.series and c.base_ym = p.base_ym and c.item = p.item and p.cutoff = case c.cutoff when 20 then 10 when 99 then 20 end""",
    "calendar": "DAYS",
    # fixed values: days of the solar calendar with the years they hold, lunar days by year, election days
    "solar_rules": """select * from (values (101, 1990, 2001), (102, 1990, 1998), (301, 1990, 2001), (405, 1990, 2001), (505, 1990, 2001), (606, 1990, 2001),
        (717, 1990, 2001), (815, 1990, 2001), (1003, 1990, 2001), (1225, 1990, 2001)) as r(md, from_year, to_year)""",
    # fixed values: lunar years with their leap month (0: none) and the months' lengths in order, the leap one after its own; 1: 30 days, 0: 29
    "lunar_years": """select * from (values (1995, 8, '0110110101001'), (1996, 0, '010110101101'), (1997, 0, '001010110110'), (1998, 5, '1001001101110'), (1999, 0, '100100101110'), (2000, 0, '110010010110'),
        (2001, 4, '1110010010101')) as y(lunar_year, leap_month, lengths)""",
    "month_places": "select * from (values (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12), (13)) as p(i)",
    # every lunar month with its first day (days since 1970) and its days; the first of the table began on 31 January 1995
    "lunar_months": """select lunar_year, month, leap, days, cast(9161 + coalesce(sum(days) over (order by lunar_year, i rows between unbounded preceding and 1 preceding), 0) as int) as first from (
        select y.lunar_year, p.i, case when y.leap_month > 0 and p.i > y.leap_month then p.i - 1 else p.i end as month, y.leap_month > 0 and p.i = y.leap_month + 1 as leap,
          29 + cast(substr(y.lengths, p.i, 1) as int) as days from lunar_years y join month_places p on p.i <= length(y.lengths)) m""",
    # solar days with their lunar dates, and the days of feasts by their lunar dates
    "lunar_dates": "select c.day, c.dayn, m.lunar_year, m.month, m.leap, c.dayn - m.first + 1 as lunar_day from calendar c join lunar_months m on c.dayn >= m.first and c.dayn < m.first + m.days",
    "feast_rules": "select * from (values ('seol', 1, 1), ('buddha', 4, 8), ('chu', 8, 15)) as f(feast, month, lunar_day)",
    "lunar_days": "select f.feast, d.day from lunar_dates d join feast_rules f on f.month = d.month and f.lunar_day = d.lunar_day where not d.leap",
    "order_days": "select cast(o_orderdate as date) as day, count(*) as n from @orders group by 1",
    "election_days": "select cast(d as date) as day from (values ('1995-06-27'), ('1996-04-11'), ('1997-12-18'), ('1998-06-04'), ('2000-04-13')) as e(d)",
    "feasts": "select l.feast, c.dayn as n from lunar_days l join calendar c on c.day = l.day",
    # the two lunar feasts take the day before and the day after, also those of another month or year
    "holiday_days": """select c.day, 'solar' as kind from calendar c join solar_rules r on c.monthday = r.md and c.base_ym // 100 between r.from_year and r.to_year
        union all select c.day, f.feast from feasts f join (values (-1), (0), (1)) as w(k) on f.feast <> 'buddha' or w.k = 0 join calendar c on c.dayn = f.n + w.k
        union all select c.day, 'election' from election_days e join calendar c on c.day = e.day""",
    "workday10d": """select base_ym, cutoff, cast(count(*) as int) as days, cast(sum(case when weekday < 5 and off is null then 1 else 0 end) as int) as workdays from (
        select c.*, h.day as off, case when dom <= 10 then 10 when dom <= 20 then 20 else 99 end as cutoff from calendar c left join (select distinct day from holiday_days) h on c.day = h.day) d where base_ym <= 200111 group by base_ym, cutoff""",
    # shares of the days before, during and after a feast that lie in a month; each less its mean over the month of the year
    "feast_shares": """select base_ym, var, sum(one) as share from (
        select c.base_ym, f.feast || case when c.dayn < f.n - 1 then '_pre' when c.dayn <= f.n + 1 then '_dur' else '_post' end as var, case when c.dayn < f.n - 1 then 1 / 20e0 when c.dayn <= f.n + 1 then 1 / 3e0 else 1 / 10e0 end as one
        from feasts f join calendar c on c.dayn between f.n - 21 and f.n + 11 where f.feast <> 'buddha') d group by base_ym, var""",
    "feast_wide": """select w.base_ym, ln(w.workdays) as ln_wd, coalesce(max(case when var = 'seol_pre' then share end), 0) as seol_pre, coalesce(max(case when var = 'seol_dur' then share end), 0) as seol_dur, coalesce(max(case when var = 'seol_post' then share end), 0) as seol_post,
        coalesce(max(case when var = 'chu_pre' then share end), 0) as chu_pre, coalesce(max(case when var = 'chu_dur' then share end), 0) as chu_dur, coalesce(max(case when var = 'chu_post' then share end), 0) as chu_post
        from (select base_ym, sum(workdays) as workdays from workday10d group by 1) w left join feast_shares s on s.base_ym = w.base_ym group by w.base_ym, w.workdays""",
    "regressors": """select base_ym, ln_wd - avg(ln_wd) over m as ln_wd, seol_pre - avg(seol_pre) over m as seol_pre, seol_dur - avg(seol_dur) over m as seol_dur, seol_post - avg(seol_post) over m as seol_post,
        chu_pre - avg(chu_pre) over m as chu_pre, chu_dur - avg(chu_dur) over m as chu_dur, chu_post - avg(chu_post) over m as chu_post from feast_wide window m as (partition by base_ym % 100)""",
    "cumdays": "select base_ym, cutoff, days, workdays, cast(sum(workdays) over (partition by base_ym order by cutoff rows between unbounded preceding and current row) as bigint) as cum_workdays, cast(sum(days) over (partition by base_ym order by cutoff rows between unbounded preceding and current row) as bigint) as cum_days from workday10d",
    "monthly": "select yyyymm, yyyymm // 100 * 12 + yyyymm % 100 - 1 as midx, sumb(exp_dlr) as x, sumb(imp_dlr) as m, sumb(exp_wgt) as xw from fact_trade group by yyyymm",
    "edges": "select yyyymm, yyyymm // 100 * 12 + yyyymm % 100 - 1 as midx, stat_cd, substr(hs10, 1, 2) as hs, sumb(exp_dlr) as v from fact_trade group by 1, 2, 3, 4 having sum(exp_dlr) > 20000",
    "layers": """select *, case when midx < (select min(midx) from edges) + 11 then null when active >= 11 then 'core' when active <= 3 then 'fringe' else 'middle' end as layer from (
        select *, count(*) over (partition by stat_cd, hs order by midx range between 11 preceding and current row) as active from edges) x""",
    "cells": "select yyyymm // 100 as yr, stat_cd, substr(hs10, 1, 4) as hs, sumb(exp_dlr) as v, sumb(exp_wgt) as w from fact_trade group by 1, 2, 3 having sum(exp_dlr) > 0 and sum(exp_wgt) > 0",
    "spells": "select stat_cd, hs, midx, midx - lag(midx) over (partition by stat_cd, hs order by midx) - 1 as gap_before, lead(midx) over (partition by stat_cd, hs order by midx) - midx - 1 as gap_after, min(midx) over (partition by stat_cd, hs) as first_midx from (select distinct stat_cd, substr(hs10, 1, 4) as hs, yyyymm // 100 * 12 + yyyymm % 100 - 1 as midx from fact_trade where exp_dlr > 0) a",
    "group_month": "select yyyymm, yyyymm // 100 * 12 + yyyymm % 100 - 1 as midx, substr(hs10, 1, 2) as grp, sumb(exp_dlr) as v, sumb(exp_wgt) as w from fact_trade group by 1, 2, 3",
    "metric": """select s.series, s.base_ym, s.base_ym // 100 * 12 + s.base_ym % 100 - 1 as midx, s.cutoff, s.item, s.seg_kusd, s.cum_kusd, w.workdays, c.cum_workdays from segments s join workday10d w on s.base_ym = w.base_ym and s.cutoff = w.cutoff join cumdays c on s.base_ym = c.base_ym and s.cutoff = c.cutoff""",
    "lagged": """select *, case when base_ym - lag(base_ym, 12) over w = 100 then lag(seg_kusd, 12) over w end as p_seg, case when base_ym - lag(base_ym, 12) over w = 100 then lag(cum_kusd, 12) over w end as p_cum,
        case when base_ym - lag(base_ym, 12) over w = 100 then lag(workdays, 12) over w end as p_workdays, case when base_ym - lag(base_ym, 12) over w = 100 then lag(cum_workdays, 12) over w end as p_cum_workdays
        from metric window w as (partition by series, cutoff, item order by base_ym)""",
    "beta": """select series, item, count(*) as n, regr_slope(ln(seg_kusd / (p_seg * 1e0)), ln(workdays / (p_workdays * 1e0))) as b, regr_r2(ln(seg_kusd / (p_seg * 1e0)), ln(workdays / (p_workdays * 1e0))) as r2
        from lagged where seg_kusd > 0 and p_seg > 0 and workdays > 0 and p_workdays > 0 group by series, item having count(*) >= 24""",
    "flow_long": "select yyyymm, 'export' as imexp, item as code, sumb(dlr) as dlr, sumb(wgt) as wgt from ship where flag <> 'R' group by yyyymm, item union all select yyyymm, 'import', item, sumb(dlr), sumb(wgt) from ship where flag = 'R' group by yyyymm, item",
    # the codes' tree: all, two digits, four digits, weighted by their codes; one parent is missing
    "tree": """select 'T' as code, cast(null as string) as parent, 1e0 as wgt union all select 'T' || substr(hs10, 1, 2), 'T', count(*) / (max(n) * 1e0) from (select hs10, count(*) over () as n from keyed) a group by substr(hs10, 1, 2)
        union all select 'T' || substr(hs10, 1, 4), 'T' || substr(hs10, 1, 2), count(*) / (max(n) * 1e0) from (select hs10, count(*) over () as n from keyed) b group by substr(hs10, 1, 4), substr(hs10, 1, 2) union all select 'X9', 'X', 1e-1""",
    # a list of codes with its headings in order, as printed
    "headed": """select substr(code, 1, 2) as chapter, code, name from (select hs10 as code, name from keyed union all select distinct substr(hs10, 1, 2), 'chapter ' || substr(hs10, 1, 2) from keyed
        union all select distinct substr(hs10, 1, 4), 'heading ' || substr(hs10, 1, 4) from keyed union all select distinct substr(hs10, 1, 6), 'part ' || substr(hs10, 5, 2) from keyed where substr(hs10, 5, 2) > '20') x""",
    # rows of a printed list of codes: cells of a level that repeat the row above within the same upper cells are blank
    "printed": """select chapter, i, hs10, case when l1 = lag(l1) over w then null else l1 end as l1, case when l1 = lag(l1) over w and l2 = lag(l2) over w then null else l2 end as l2, l3 from (
        select substr(hs10, 1, 2) as chapter, row_number() over (partition by substr(hs10, 1, 2) order by hs10) as i, hs10, substr(hs10, 1, 4) as l1, substr(hs10, 5, 2) as l2, substr(hs10, 7, 4) as l3 from keyed) x window w as (partition by chapter order by i)""",
}

_DAYS = {
    "spark": "select d as day, cast(year(d) * 100 + month(d) as int) as base_ym, cast(day(d) as int) as dom, cast(month(d) * 100 + day(d) as int) as monthday, weekday(d) as weekday, unix_date(d) as dayn from (select explode(sequence(date'1995-01-01', date'2001-12-31', interval 1 day)) as d) x",
    "duck": "select d as day, cast(year(d) * 100 + month(d) as int) as base_ym, cast(day(d) as int) as dom, cast(month(d) * 100 + day(d) as int) as monthday, cast(isodow(d) - 1 as int) as weekday, cast(date_diff('day', date '1970-01-01', d) as int) as dayn from (select cast(unnest(generate_series(date '1995-01-01', date '2001-12-31', interval 1 day)) as date) as d) x",
}


def _call(text: str, name: str, make) -> str:
    """Replace name(...) by make(inner), brackets balanced."""
    while m := re.search(rf"\b{name}\(", text):
        depth, i = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(text[i], 0)
            i += 1
        text = text[: m.start()] + make(text[m.end() : i - 1]) + text[i:]
    return text


def _needed(text: str, kept: dict[str, str]) -> list[str]:
    """Tables a text names, those they need first; kept ones need none."""
    out: list[str] = []

    def visit(t):
        for name in re.findall(r"\b(?:from|join)\s+([a-z_0-9]+)", t):
            if name in TABLES and name not in out:
                visit(kept.get(name, TABLES[name]))
                if name not in out:
                    out.append(name)

    visit(text)
    return out


def _whole(text: str, engine: str, kept: dict[str, str] | None = None) -> str:
    texts = TABLES | {"calendar": _DAYS[engine]} | (kept or {})
    with_ = ",\n".join(f"{n} as ({texts[n]})" for n in _needed(text, kept or {}))
    text = text.strip()
    if with_:
        own = re.match(r"with (recursive )?", text)
        text = f"with {own[1] or ''}{with_},\n{text[own.end():]}" if own else f"with {with_}\n{text}"
    return text


def duck_text(text: str) -> str:
    text = re.sub(r"// (\d+)", r"// cast(\1 as bigint)", _whole(text, "duck").replace("@", ""))  # as wide as Spark's div
    text = _call(text, "sumb", lambda x: f"cast(sum({x}) as bigint)")
    return _call(text, "pct", lambda x: f"quantile_cont({x})")


def spark_text(text: str, sf_dir: str, kept: dict[str, str] | None = None) -> str:
    text = re.sub(r"@(\w+)", lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", _whole(text, "spark", kept)).replace("//", " div ").replace(": div ", "://")
    text = _call(text, "sumb", lambda x: f"sum({x})")
    return _call(text, "pct", lambda x: f"percentile({x})")


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_trade. Hardly any lines share a month, country and code, so they are dealt out as they are, a bounded number to a task, and summed once."""
    tasks = -(-spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // FACT_LINES) or 1
    keys = ["yyyymm", "stat_cd", "hs10"]
    lines = spark.sql(spark_text("select yyyymm, stat_cd, hs10, flag, dlr, wgt from ship", sf_dir)).repartition(tasks, *keys)
    sums = {"exp_dlr": "case when flag <> 'R' then dlr else 0 end", "imp_dlr": "case when flag = 'R' then dlr else 0 end", "exp_wgt": "case when flag <> 'R' then wgt else 0 end",
            "imp_wgt": "case when flag = 'R' then wgt else 0 end", "bal_payments": "case when flag = 'R' then -dlr else dlr end"}
    return lines.groupBy(*keys).agg(*[F.sum(F.expr(e)).alias(c) for c, e in sums.items()])


def _kept(spark: SparkSession, sf_dir: str, text: str) -> dict[str, str]:
    """The texts that read kept tables, for those that a text needs; what is not there yet is written."""
    out: dict[str, str] = {}
    for name in KEPT:
        if name not in _needed(text, out):
            continue
        columns, order = KEPT[name]
        whole = f"select {columns} from {name}"
        sources = sorted(set(re.findall(r"@(\w+)", _whole(whole, "spark"))))
        path = store.kept(spark, name, [f"{sf_dir}/{t}.parquet" for t in sources], lambda name=name, whole=whole: _fact(spark, sf_dir) if name == "fact_trade" else spark.sql(spark_text(whole, sf_dir, _kept(spark, sf_dir, TABLES[name]))), order)
        out[name] = f"select {columns} from parquet.`{path}`"
    return out


def run(spark: SparkSession, sf_dir: str, text: str, **args) -> DataFrame:
    """The rows of a text; `args` are values of its :named parameters."""
    return spark.sql(spark_text(text, sf_dir, _kept(spark, sf_dir, text)), args=args or None)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of TABLES, or a stored table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet") if name in STORED else run(spark, sf_dir, f"select * from {name}")
