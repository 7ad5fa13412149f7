"""Analyses: entry and exit, margins, price and quantity indices, networks, event studies, shares and index arithmetic."""

SQL = {
    "seasonal_index": "select mon, round(100 * avg(v) / max(g), 6) as idx from (select yyyymm % 100 as mon, x as v, avg(x) over () as g from monthly where yyyymm <= 200012) s group by mon",
    "bilateral_balance": "select stat_cd, bal, cast(rank() over (order by bal desc) as int) as rk_surplus, cast(rank() over (order by bal) as int) as rk_deficit from (select stat_cd, sumb(bal_payments) as bal from fact_total where yyyymm // 100 = 2000 and stat_cd <> 'N24' group by 1) x",
    "entry_exit_raw": "with a as (select distinct hs10 from fact_trade where yyyymm // 100 = 1998 and exp_dlr > 0), b as (select distinct hs10 from fact_trade where yyyymm // 100 = 2000 and exp_dlr > 0) select (select count(*) from b where not exists (select 1 from a where a.hs10 = b.hs10)) as n_entry, (select count(*) from a where not exists (select 1 from b where b.hs10 = a.hs10)) as n_exit, (select count(*) from a where hs10 in (select hs10 from b)) as n_stay",
    "entry_exit_stable": "with s as (select hs_past as hs10 from concordance where relation = 'identity' group by 1 having count(distinct past_version) = 3), a as (select distinct f.hs10 from fact_trade f join s on f.hs10 = s.hs10 where f.yyyymm // 100 = 1998 and f.exp_dlr > 0), b as (select distinct f.hs10 from fact_trade f join s on f.hs10 = s.hs10 where f.yyyymm // 100 = 2000 and f.exp_dlr > 0) select (select count(*) from b where not exists (select 1 from a where a.hs10 = b.hs10)) as n_entry, (select count(*) from a where not exists (select 1 from b where b.hs10 = a.hs10)) as n_exit, (select count(*) from a where hs10 in (select hs10 from b)) as n_stay",
    "entry_value_share": "with a as (select distinct hs10 from fact_trade where yyyymm // 100 = 1998 and exp_dlr > 0) select round(sum(case when a.hs10 is null then f.exp_dlr else 0 end) / (sum(f.exp_dlr) * 1e0), 8) as entrant_share, count(distinct case when a.hs10 is null and f.exp_dlr > 0 then f.hs10 end) as n_entrants from fact_trade f left join a on f.hs10 = a.hs10 where f.yyyymm // 100 = 2000",
    "threshold_sensitivity": "select tau, count(*) as n_edges, round(avg(v), 4) as mean_v from (select e.*, t.tau from (select yyyymm, stat_cd, substr(hs10, 1, 2) as hs, sumb(exp_dlr) as v from fact_trade group by 1, 2, 3) e cross join (values (0), (10000), (50000), (100000)) as t(tau) where e.v > t.tau) x group by tau",
    "network_metrics": "select midx, n, c, h, round(n / (c * h * 1e0), 8) as density, round(core_n / (n * 1e0), 8) as core_share_n, round(core_v / (v * 1e0), 8) as core_share_v from (select midx, count(*) as n, count(distinct stat_cd) as c, count(distinct hs) as h, sum(v) as v, sum(case when layer = 'core' then 1 else 0 end) as core_n, sum(case when layer = 'core' then v else 0 end) as core_v from layers group by 1) x",
    "core_concentration": "select midx, count(*) as n_core, round(sum(case when rk <= greatest(1, floor(n * 1e-1)) then v else 0 end) / (sum(v) * 1e0), 8) as top10pct from (select midx, v, row_number() over (partition by midx order by v desc, stat_cd, hs) as rk, count(*) over (partition by midx) as n from layers where layer = 'core') x group by midx",
    "product_degree": "select hs, yr, count(distinct stat_cd) as degree, count(*) as n_edge_months from (select hs, stat_cd, yyyymm // 100 as yr from edges) x group by 1, 2",
    "dest_share_ma3": "select stat_cd, midx, case when count(*) over w = 3 then round(avg(s) over w, 8) end as ma3 from (select stat_cd, midx, sum(v) / (sum(sum(v)) over (partition by midx) * 1e0) as s from edges group by 1, 2) x window w as (partition by stat_cd order by midx rows between 2 preceding and current row)",
    "drop_vs_baseline": "select a.mon, a.n as n_1998, b.base, round(b.base - a.n, 4) as missing from (select yyyymm % 100 as mon, count(*) as n from edges where yyyymm // 100 = 1998 group by 1) a join (select mon, pct(n, 5e-1) as base from (select yyyymm % 100 as mon, yyyymm // 100 as yr, count(*) as n from edges where yyyymm // 100 in (1997, 1999) group by 1, 2) x group by mon) b on a.mon = b.mon",
    "fourway_level1": "with t as (select yr, ln(sum(v)) as lx, ln(count(*)) as ln_n from cells where yr <= 2000 group by 1), d as (select a.yr, a.lx - b.lx as g, a.ln_n - b.ln_n as dn, (a.lx - b.lx) - (a.ln_n - b.ln_n) as db from t a join t b on a.yr = b.yr + 1) select round(var_samp(dn) / var_samp(g), 6) as ext, round(var_samp(db) / var_samp(g), 6) as intensive, round(2 * covar_samp(dn, db) / var_samp(g), 6) as cov from d",
    "fourway_level2": "with c as (select b.yr, ln(b.v / (b.w * 1e0)) - ln(a.v / (a.w * 1e0)) as dp, ln(b.w / (a.w * 1e0)) as dq, 5e-1 * (a.v / (sum(a.v) over (partition by b.yr) * 1e0) + b.v / (sum(b.v) over (partition by b.yr) * 1e0)) as s from cells a join cells b on a.stat_cd = b.stat_cd and a.hs = b.hs and b.yr = a.yr + 1) select yr, count(*) as n, round(sum(s * dp) / sum(s), 8) as d_price, round(sum(s * dq) / sum(s), 8) as d_quantity from c where abs(dp) <= ln(50) and abs(dq) <= ln(50) group by yr",
    "fourway_decomp": "with t as (select yr, ln(sum(v)) as lx, ln(count(*)) as ln_n from cells where yr <= 2000 group by 1), d as (select a.yr, a.lx - b.lx as g, a.ln_n - b.ln_n as dn, (a.lx - b.lx) - (a.ln_n - b.ln_n) as db from t a join t b on a.yr = b.yr + 1), c as (select b.yr, ln(b.v / (b.w * 1e0)) - ln(a.v / (a.w * 1e0)) as dp, ln(b.w / (a.w * 1e0)) as dq, 5e-1 * (a.v / (sum(a.v) over (partition by b.yr) * 1e0) + b.v / (sum(b.v) over (partition by b.yr) * 1e0)) as s from cells a join cells b on a.stat_cd = b.stat_cd and a.hs = b.hs and b.yr = a.yr + 1 where b.yr <= 2000), i as (select yr, sum(s * dp) / sum(s) as p, sum(s * dq) / sum(s) as q from c where abs(dp) <= ln(50) and abs(dq) <= ln(50) group by yr), l as (select var_samp(dn) / var_samp(g) as ext, var_samp(db) / var_samp(g) as it, 2 * covar_samp(dn, db) / var_samp(g) as cv from d), m as (select var_samp(p) / var_samp(p + q) as ps, var_samp(q) / var_samp(p + q) as qs, 2 * covar_samp(p, q) / var_samp(p + q) as cs from i) select round(l.ext, 6) as ext, round(l.it * m.ps, 6) as price, round(l.it * m.qs, 6) as quantity, round(l.cv + l.it * m.cs, 6) as cov from l cross join m",
    "parts_share_screen": "select yr, hs2, round(s, 8) as share from (select yyyymm // 100 as yr, substr(hs10, 1, 2) as hs2, sum(case when substr(hs10, 3, 2) = '13' then exp_dlr else 0 end) / (sum(exp_dlr) * 1e0) as s from fact_trade group by 1, 2 having sum(exp_dlr) > 0) x where s > 3e-2",
    "frontrun_excess": "select stat_cd, sumb(case when yyyymm between 199810 and 199812 then x else 0 end) - cast(round(3 * avg(case when yyyymm between 199801 and 199809 then x end)) as bigint) as excess, cast(round((avg(case when yyyymm between 199801 and 199809 then x end) - avg(case when yyyymm between 199901 and 199906 then x end)) * 6) as bigint) as shortage from (select stat_cd, yyyymm, sumb(exp_dlr) as x from fact_trade where yyyymm between 199801 and 199906 group by 1, 2) a group by stat_cd",
    "q1_concentration": "select yr, round(avg(case when mon <= 3 then x end) / avg(x), 8) as q1_rel, round(max(x) / avg(x), 8) as max_rel from (select yyyymm // 100 as yr, yyyymm % 100 as mon, x from monthly) a group by yr having count(*) = 12",
    "unit_value_premium": "select a.yr, round(a.uv / b.uv - 1, 8) as premium from (select yyyymm // 100 as yr, sum(exp_dlr) / (sum(exp_wgt) * 1e0) as uv from fact_trade where stat_cd = 'N01' and exp_wgt > 0 group by 1) a join (select yyyymm // 100 as yr, sum(exp_dlr) / (sum(exp_wgt) * 1e0) as uv from fact_trade where stat_cd <> 'N01' and exp_wgt > 0 group by 1) b on a.yr = b.yr",
    "event_window_uv": "select substr(hs10, 1, 2) as hs2, round(sum(case when yyyymm < 199901 then exp_dlr else 0 end) / (nullif(sum(case when yyyymm < 199901 then exp_wgt else 0 end), 0) * 1e0), 6) as before_uv, round(sum(case when yyyymm >= 199901 then exp_dlr else 0 end) / (nullif(sum(case when yyyymm >= 199901 then exp_wgt else 0 end), 0) * 1e0), 6) as after_uv from fact_trade where yyyymm between 199801 and 199912 group by 1",
    "weight_coverage": "select yyyymm // 100 as yr, count(*) filter (where exp_dlr > 0) as n_value, count(*) filter (where exp_dlr > 0 and exp_wgt > 0) as n_weight, round(sum(case when exp_wgt > 0 then exp_dlr else 0 end) / (sum(exp_dlr) * 1e0), 8) as value_share from fact_trade group by 1",
    "group_series": "select yyyymm, grp, v from group_month union all select yyyymm, 'total', sumb(v) from group_month group by 1 union all select yyyymm, 'ex_01', sumb(case when grp <> '01' then v else 0 end) from group_month group by 1",
    "phase_contribution": "with a as (select grp, sum(case when yyyymm // 100 = 1996 then v else 0 end) as v0, sum(case when yyyymm // 100 = 1998 then v else 0 end) as v1, sum(case when yyyymm // 100 = 2000 then v else 0 end) as v2 from group_month group by 1) select grp, round((v1 - v0) * 100e0 / (sum(v0) over ()) / 2, 8) as phase1, round((v2 - v1) * 100e0 / (sum(v1) over ()) / 2, 8) as phase2 from a",
    "tornqvist_bilateral": "with y as (select yyyymm // 100 as yr, substr(hs10, 1, 4) as hs, sum(exp_dlr) as v, sum(exp_wgt) as w from fact_trade group by 1, 2), m as (select b.yr, a.v as v0, b.v as v1, a.w as w0, b.w as w1, a.v / (sum(a.v) over (partition by b.yr) * 1e0) as s0, b.v / (sum(b.v) over (partition by b.yr) * 1e0) as s1 from y a join y b on a.hs = b.hs and b.yr = a.yr + 1 where a.v > 0 and b.v > 0 and a.w > 0 and b.w > 0), t as (select yr, sum(v) as v from y group by 1) select p.yr, round(p.dp, 8) as d_price, round(ln(t1.v / (t0.v * 1e0)) - p.dp, 8) as d_quantity from (select yr, sum(5e-1 * (s0 + s1) * (ln(v1 / (w1 * 1e0)) - ln(v0 / (w0 * 1e0)))) as dp from m group by yr) p join t t1 on t1.yr = p.yr join t t0 on t0.yr = p.yr - 1",
    "tornqvist_chain": "with t as (select midx, sum(v) as tv from group_month group by 1), m as (select b.midx, 5e-1 * (a.v / (t0.tv * 1e0) + b.v / (t1.tv * 1e0)) as s, ln(b.v / (b.w * 1e0)) - ln(a.v / (a.w * 1e0)) as dp from group_month a join group_month b on a.grp = b.grp and b.midx = a.midx + 1 join t t0 on t0.midx = a.midx join t t1 on t1.midx = b.midx where a.v > 0 and b.v > 0 and a.w > 0 and b.w > 0), p as (select midx, sum(s * dp) / sum(s) as dp from m group by 1), q as (select t1.midx, coalesce(ln(t1.tv / (t0.tv * 1e0)) - p.dp, 0) as dq from t t1 left join t t0 on t0.midx = t1.midx - 1 left join p on p.midx = t1.midx), c as (select midx, exp(sum(dq) over (order by midx rows between unbounded preceding and current row)) as lev from q) select midx, round(100 * lev / (select avg(lev) from c where midx // 12 = 2000), 6) as idx from c",
    "tornqvist_yoy": "with m as (select b.midx, a.v as v0, b.v as v1, a.w as w0, b.w as w1, a.v / (sum(a.v) over (partition by b.midx) * 1e0) as s0, b.v / (sum(b.v) over (partition by b.midx) * 1e0) as s1 from group_month a join group_month b on a.grp = b.grp and b.midx = a.midx + 12 where a.v > 0 and b.v > 0 and a.w > 0 and b.w > 0) select midx, round(sum(5e-1 * (s0 + s1) * (ln(w1 / (w0 * 1e0)))), 8) as dq, count(*) as n from m group by midx",
    "variance_share": "with c as (select b.grp, b.midx, (b.v - a.v) / (t.tv * 1e0) as ci from group_month a join group_month b on a.grp = b.grp and b.midx = a.midx + 12 join (select midx, sum(v) as tv from group_month group by 1) t on t.midx = a.midx where b.yyyymm <= 200110), g as (select midx, sum(ci) as g from c group by 1) select c.grp, round(covar_samp(c.ci, g.g) / var_samp(g.g), 6) as share, count(*) as n from c join g on c.midx = g.midx group by c.grp",
    "rolling_corr60": "select midx, case when count(*) over w = 60 then round(corr(a, b) over w, 6) end as r60 from (select x.midx, x.v * 1e0 as a, y.v * 1e0 as b from group_month x join group_month y on x.midx = y.midx and y.grp = '02' where x.grp = '01') p window w as (order by midx rows between 59 preceding and current row)",
    "index_compose": "select p.yyyymm, round(case when m.v is null then p.v * 1e0 else (7e-1 * p.v - 2e-1 * m.v) / 5e-1 end, 4) as composed from (select yyyymm, v from group_month where grp = '01') p left join (select yyyymm, v from group_month where grp = '02' and yyyymm % 100 <> 7) m on p.yyyymm = m.yyyymm",
    "xcorr_lags": "select k, n, round(r, 6) as r, round(2 / sqrt(n), 6) as band from (select l.k, count(*) as n, corr(x.v * 1e0, y.v * 1e0) as r from (values (-12), (-6), (-3), (-2), (-1), (0), (1), (2), (3), (6), (12)) as l(k) cross join (select midx, v from group_month where grp = '01') y join (select midx, v from group_month where grp = '02') x on x.midx = y.midx - l.k group by l.k) z where n > 24",
    "ttm_annual": "select case when yyyymm > 200010 then 'TTM' else cast(yyyymm // 100 as string) end as yr, sumb(x) as exp_dlr, count(*) as n from monthly where yyyymm <= 200110 and (yyyymm > 200010 or yyyymm // 100 <= 1999) group by 1",
    "ratio_crossover": "with r as (select yyyymm // 100 as yr, sum(case when substr(hs10, 1, 2) = '01' then exp_dlr else 0 end) / (nullif(sum(case when substr(hs10, 1, 2) = '02' then exp_dlr else 0 end), 0) * 1e0) as ratio from fact_trade group by 1) select (select min(yr) from r where ratio > 9e-1) as first_year, (select count(*) from r where ratio <= 9e-1 and yr > (select min(yr) from r where ratio > 9e-1)) as n_returns",
    "rebase_index": "select grp, yyyymm, round(100 * v / avg(case when yyyymm // 100 = 2000 then v end) over (partition by grp), 6) as idx from group_month",
    "fiscal_position": "select fy, q, round(avg(rel), 8) as rel from (select case when yyyymm % 100 >= 2 then yyyymm // 100 else yyyymm // 100 - 1 end as fy, (yyyymm % 100 + 10) % 12 // 3 + 1 as q, x / avg(x) over (partition by case when yyyymm % 100 >= 2 then yyyymm // 100 else yyyymm // 100 - 1 end) as rel from monthly) a group by 1, 2",
    "partner_share_trajectory": "with s as (select yyyymm // 100 as yr, stat_cd, sum(exp_dlr) / (sum(sum(exp_dlr)) over (partition by yyyymm // 100) * 1e0) as share from fact_trade group by 1, 2) select stat_cd, max_by(yr, share) as peak_year, round(max(share), 8) as peak, round(max(case when yr = 2000 then share end), 8) as share_2000 from s where stat_cd in ('N00', 'N01', 'N02', 'N03', 'N04') group by stat_cd",
    "group_share_by_year": "select yyyymm // 100 as yr, round(sum(case when substr(hs10, 1, 2) in ('01', '02') then exp_dlr else 0 end) / (sum(exp_dlr) * 1e0), 8) as s_a, round(sum(case when substr(hs10, 1, 2) in ('03', '04') then exp_dlr else 0 end) / (sum(exp_dlr) * 1e0), 8) as s_b, round(sum(case when substr(hs10, 1, 2) not in ('01', '02', '03', '04') then exp_dlr else 0 end) / (sum(exp_dlr) * 1e0), 8) as s_rest from fact_trade group by 1",
}
