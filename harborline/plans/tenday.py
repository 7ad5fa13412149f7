"""Ten-day cumulative series: segments, workdays, adjusted growth, progress, reconciliation, logs."""

SQL = {
    "exp10d_with_other": "select series, base_ym, cutoff, item, seg_kusd, cum_kusd from segments where item in ('TOTAL', 'PROMO', 'SMALL', 'LARGE') union all select series, base_ym, cutoff, 'OTHER', sumb(case when item = 'TOTAL' then seg_kusd when item in ('PROMO', 'SMALL', 'LARGE') then -seg_kusd else 0 end), sumb(case when item = 'TOTAL' then cum_kusd when item in ('PROMO', 'SMALL', 'LARGE') then -cum_kusd else 0 end) from segments group by 1, 2, 3",
    "forecast_log_delta": "select n.series, n.base_ym, n.cutoff, n.item, n.amt_kusd from (select * from exp10d where fetched_at = 2) n left join (select * from exp10d where fetched_at = 1) o on n.series = o.series and n.base_ym = o.base_ym and n.cutoff = o.cutoff and n.item = o.item where n.base_ym >= 200101 and n.cutoff < 99 and (o.amt_kusd is null or abs(o.amt_kusd - n.amt_kusd) > 1)",
    "progress_ratio": "select series, base_ym, item, round(c10 / (c99 * 1e0), 8) as p10, round(c20 / (c99 * 1e0), 8) as p20, round(w10 / (w99 * 1e0), 8) as w10, round(w20 / (w99 * 1e0), 8) as w20 from (select series, base_ym, item, max(case when cutoff = 10 then cum_kusd end) as c10, max(case when cutoff = 20 then cum_kusd end) as c20, max(case when cutoff = 99 then cum_kusd end) as c99, max(case when cutoff = 10 then cum_workdays end) as w10, max(case when cutoff = 20 then cum_workdays end) as w20, max(case when cutoff = 99 then cum_workdays end) as w99, count(*) as n from metric group by 1, 2, 3) x where n = 3 and c99 > 0",
    "progress_beta": "select series, item, cutoff, count(*) as n, round(regr_slope(ln(cum_kusd / (c99 * 1e0)), ln(cum_workdays / (w99 * 1e0))), 8) as slope from (select m.*, t.cum_kusd as c99, t.cum_workdays as w99 from metric m join metric t on m.series = t.series and m.base_ym = t.base_ym and m.item = t.item and t.cutoff = 99 where m.cutoff < 99) x where cum_kusd > 0 and c99 > 0 group by 1, 2, 3",
    "progress_summary": "with r as (select m.series, m.item, m.cutoff, m.base_ym, m.cum_kusd / (t.cum_kusd * 1e0) as p from metric m join metric t on m.series = t.series and m.base_ym = t.base_ym and m.item = t.item and t.cutoff = 99 where m.cutoff < 99 and t.cum_kusd > 0) select series, item, cutoff, mon, count(*) as n, round(avg(p), 8) as mean, round(stddev_samp(p), 8) as sd, round(pct(p, 1e-1), 8) as p10, round(pct(p, 5e-1), 8) as p50, round(pct(p, 9e-1), 8) as p90 from (select series, item, cutoff, base_ym % 100 as mon, p from r union all select series, item, cutoff, 0, p from r) u group by 1, 2, 3, 4",
    "elasticity_ols": "select series, item, n, round(b, 8) as slope, round(r2, 8) as r2 from beta",
    "contribution_pp": "select l.series, l.base_ym, l.cutoff, l.item, round(100 * (l.seg_kusd - l.p_seg) / (t.p_seg * 1e0), 8) as pp from lagged l join lagged t on l.series = t.series and l.base_ym = t.base_ym and l.cutoff = t.cutoff and t.item = 'TOTAL' where t.p_seg > 0 and l.p_seg is not null and l.item <> 'TOTAL'",
    "yoy_adjusted": "select l.series, l.base_ym, l.cutoff, l.item, round(l.seg_kusd / (l.p_seg * 1e0) - 1, 8) as yoy_raw, round((l.seg_kusd / (l.workdays * 1e0)) / (l.p_seg / (l.p_workdays * 1e0)) - 1, 8) as yoy_daily, round(l.seg_kusd * power(l.p_workdays / (l.workdays * 1e0), coalesce(b.b, 0)) / l.p_seg - 1, 8) as yoy_adj from lagged l left join beta b on l.series = b.series and l.item = b.item where l.p_seg > 0 and l.workdays > 0 and l.p_workdays > 0",
    "adjusted_total": "select series, base_ym, cutoff, case when count(adj) = 6 then round(sum(adj), 4) end as adj_total, count(adj) as n_items from (select l.series, l.base_ym, l.cutoff, l.item, case when l.p_seg > 0 and l.workdays > 0 and l.p_workdays > 0 then l.seg_kusd * power(l.p_workdays / (l.workdays * 1e0), coalesce(b.b, 0)) end as adj from lagged l left join beta b on l.series = b.series and l.item = b.item where l.item <> 'TOTAL') x group by 1, 2, 3",
    "nowcast_features": "select m.series, m.item, m.base_ym, m.cutoff, m.cum_kusd, t.cum_kusd as act, round(ln(m.cum_workdays / (c.cum_workdays * 1e0)), 10) as lwr, case when t.cum_kusd > 0 and m.cum_kusd > 0 then round(ln(m.cum_kusd / (t.cum_kusd * 1e0)), 10) end as lr from metric m join cumdays c on c.base_ym = m.base_ym and c.cutoff = 99 left join metric t on t.series = m.series and t.item = m.item and t.base_ym = m.base_ym and t.cutoff = 99 where m.cutoff < 99 and m.cum_workdays > 0",
    "reconcile_proportional": "select i.series, i.base_ym, i.item, round(i.fc * t.fc / nullif(s.total, 0), 6) as fc from (select series, base_ym, item, cum_kusd * 18e-1 as fc from segments where cutoff = 20 and item <> 'TOTAL') i join (select series, base_ym, sum(cum_kusd * 18e-1) as total from segments where cutoff = 20 and item <> 'TOTAL' group by 1, 2) s on i.series = s.series and i.base_ym = s.base_ym join (select series, base_ym, cum_kusd * 17e-1 as fc from segments where cutoff = 20 and item = 'TOTAL') t on i.series = t.series and i.base_ym = t.base_ym",
    "forecast_yoy": "select f.series, f.base_ym, f.item, round(f.cum_kusd * 18e-1 / p.cum_kusd - 1, 8) as yoy, round(100 * (f.cum_kusd * 18e-1 - p.cum_kusd) / pt.cum_kusd, 8) as contribution from segments f join segments p on f.series = p.series and f.item = p.item and f.base_ym = p.base_ym + 100 and p.cutoff = 99 join segments pt on pt.series = f.series and pt.base_ym = p.base_ym and pt.cutoff = 99 and pt.item = 'TOTAL' where f.cutoff = 20 and p.cum_kusd > 0",
    "forecast_skill": "select series, item, count(*) as n, round(avg(ape), 6) as mape, round(pct(ape, 5e-1), 6) as mdape, round(avg(case when ape <= 20 then 1e0 else 0e0 end), 6) as within_20, case when avg(ape) <= 5 then 'A' when avg(ape) <= 10 then 'B' when avg(ape) <= 20 then 'C' else 'D' end as grade from (select f.series, f.item, 100 * abs(f.cum_kusd * 15e-1 / a.cum_kusd - 1) as ape from segments f join segments a on f.series = a.series and f.base_ym = a.base_ym and f.item = a.item and a.cutoff = 99 where f.cutoff = 20 and a.cum_kusd > 0) x group by 1, 2",
    "growth_ex_item": "select l.series, l.base_ym, l.cutoff, round((t.seg_kusd - l.seg_kusd) / ((t.p_seg - l.p_seg) * 1e0) - 1, 8) as growth_ex, round(l.seg_kusd / (t.seg_kusd * 1e0), 8) as share from lagged l join lagged t on l.series = t.series and l.base_ym = t.base_ym and l.cutoff = t.cutoff and t.item = 'TOTAL' where l.item = 'PROMO' and t.p_seg - l.p_seg > 0 and t.seg_kusd > 0",
    "surprise_score": "with y as (select series, item, base_ym, cutoff, seg_kusd / (p_seg * 1e0) - 1 as g, seg_kusd from lagged where p_seg > 0 and item <> 'TOTAL'), h as (select a.series, a.item, a.base_ym, a.cutoff, a.g, a.seg_kusd, avg(b.g) as m, stddev_samp(b.g) as s from y a join y b on a.series = b.series and a.item = b.item and a.cutoff = b.cutoff and b.base_ym < a.base_ym group by 1, 2, 3, 4, 5, 6) select h.series, h.item, h.base_ym, h.cutoff, round(abs(h.g - h.m) / h.s * sqrt(h.seg_kusd / (t.seg_kusd * 1e0)), 6) as score from h join segments t on h.series = t.series and h.base_ym = t.base_ym and h.cutoff = t.cutoff and t.item = 'TOTAL' where h.s > 0 and t.seg_kusd > 0 and h.seg_kusd >= 0",
    "workday_effect": "select a.base_ym, round(exp(6e-1 * ln(a.wd / (b.wd * 1e0))) - 1, 10) as effect from (select base_ym, sum(workdays) as wd from workday10d group by 1) a join (select base_ym, sum(workdays) as wd from workday10d group by 1) b on a.base_ym = b.base_ym + 100 join months m on m.yyyymm = a.base_ym",
    "strain_points": "select series, base_ym, cutoff, round(ln(workdays / (p_workdays * 1e0)), 8) as dlnw, abs(ln(workdays / (p_workdays * 1e0))) > 25e-2 as flagged from lagged where item = 'TOTAL' and workdays > 0 and p_workdays > 0 order by abs(ln(workdays / (p_workdays * 1e0))) desc, series, base_ym, cutoff limit 5",
    "masked_decline": "select l.series, l.base_ym, l.cutoff from lagged l join lagged t on l.series = t.series and l.base_ym = t.base_ym and l.cutoff = t.cutoff and t.item = 'TOTAL' where l.item = 'PROMO' and t.p_seg > 0 and t.seg_kusd > t.p_seg and t.p_seg - l.p_seg > 0 and t.seg_kusd - l.seg_kusd < t.p_seg - l.p_seg",
}
