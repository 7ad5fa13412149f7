"""Scans, projections, joins, aggregates, windows, top-k and set operations over the trade tables."""

SQL = {
    # --- scans, projection, filters
    "scan_project": "select yyyymm, stat_cd, exp_dlr from fact_trade where yyyymm between 199901 and 199906",
    "annual_totals": "select yyyymm // 100 as yr, round(sum(exp_dlr) / 1e8, 6) as exp_eok, round(sum(imp_dlr) / 1e8, 6) as imp_eok, round(sum(bal_payments) / 1e8, 6) as bal_eok from fact_total group by 1",
    "hs6_country_month": "select substr(hs10, 1, 6) as hs6, stat_cd, yyyymm, sumb(exp_dlr) as exp_dlr, sumb(imp_dlr) as imp_dlr from fact_trade group by 1, 2, 3",
    "hs_version_bucket": "select case when yyyymm < 199701 then 'HS1995' when yyyymm < 199901 then 'HS1997' when yyyymm < 200101 then 'HS1999' else 'HS2001' end as hs_version, count(*) as n, sumb(exp_dlr) as exp_dlr from fact_trade group by 1",
    "unit_value_monthly": "select yyyymm, round(sum(exp_dlr) / (nullif(sum(exp_wgt), 0) * 1e0), 6) as exp_uv, round(sum(imp_dlr) / (nullif(sum(imp_wgt), 0) * 1e0), 6) as imp_uv from fact_trade group by yyyymm",
    "major10_label": "select substr(hs10, 1, 2) as hs2, case when hs10 like '01%' then 'food' when hs10 like '02%' or hs10 like '03%' then 'machines' when substr(hs10, 3, 2) = '13' then 'ships' else 'other' end as major10, sumb(exp_dlr) as exp_dlr from fact_trade group by 1, 2",
    "recent12_by_group": "select substr(hs10, 1, 2) as grp, sumb(exp_dlr) as exp_dlr from fact_trade where yyyymm > (select max(yyyymm) - 100 from fact_trade) group by 1",
    "active_edges": "select yyyymm, stat_cd, hs, v from edges",
    "dedup_keep_first": "select hs10, k, name from (select hs10, p_partkey as k, p_name as name, row_number() over (partition by substr(hs10, 1, 4) order by p_partkey desc, hs10) as rn from codes) x where rn = 1",
    "pair_todo_anti": "select m.yyyymm, d.stat_cd from months m cross join dim_country d left join meta_calls c on m.yyyymm = c.yyyymm and d.stat_cd = c.stat_cd and c.success where c.stat_cd is null and m.yyyymm <= 200110",
    "confirmed_months": "select yyyymm from meta_calls where stat_cd = 'N07' and item_count > 1",
    "segment_balance": "select yyyymm // 100 as yr, case when substr(hs10, 1, 2) in ('01', '02') then 'chips' when substr(hs10, 1, 2) in ('03', '04') then 'equipment' else 'materials' end as layer, sumb(exp_dlr) as exp_dlr, sumb(imp_dlr) as imp_dlr, sumb(exp_dlr - imp_dlr) as balance from fact_trade group by 1, 2",
    "exp10d_partsum_check": "select series, base_ym, cutoff, sumb(case when item = 'TOTAL' then amt_kusd else 0 end) as total, sumb(case when item not like 'TOT%' then amt_kusd else 0 end) as parts from latest10d group by 1, 2, 3",
    # --- joins
    "dim_join_agg": "select d.continent, h.kind, sumb(f.exp_dlr) as exp_dlr from fact_trade f left join dim_country d on f.stat_cd = d.stat_cd left join dim_hs10 h on f.hs10 = h.hs10 where f.yyyymm between 199801 and 200003 group by 1, 2",
    "top_partners": "select d.name_en, x.exp_dlr, round(100 * x.exp_dlr / (select sum(exp_dlr) from fact_total where yyyymm between 200001 and 200012), 6) as share from (select stat_cd, sumb(exp_dlr) as exp_dlr from fact_total where yyyymm between 200001 and 200012 group by stat_cd) x join dim_country d using (stat_cd) order by x.exp_dlr desc, d.name_en limit 10",
    "yoy_12m_avg": "select a.grp, round(avg(a.v / (b.v * 1e0) - 1), 8) as yoy_avg, count(*) as n from group_month a join group_month b on a.grp = b.grp and a.yyyymm = b.yyyymm + 100 where a.yyyymm // 100 = 2000 and b.v > 0 group by a.grp",
    "concordance_join_count": "select c.past_version, count(*) as n, sumb(f.exp_dlr) as exp_dlr from fact_trade f join concordance c on f.hs10 = c.hs_past group by 1",
    "stable_code_count": "select v.version, count(distinct v.hs10) as n_codes, count(distinct case when c.relation = 'identity' then v.hs10 end) as n_stable, count(distinct case when v.version <> 2001 and c.hs2022 is null then v.hs10 end) as n_unmatched from fact_versioned v left join concordance c on v.version <> 2001 and c.past_version = v.version and c.hs_past = v.hs10 group by 1",
    "full_outer_reconcile": "select coalesce(a.stat_cd, b.stat_cd) as stat_cd, coalesce(a.official, 0) as official, coalesce(b.derived, 0) as derived, abs(coalesce(a.official, 0) - coalesce(b.derived, 0)) as abs_err from (select stat_cd, sumb(exp_dlr) as official from fact_total where stat_cd <> 'N03' group by 1) a full outer join (select stat_cd, sumb(exp_dlr) as derived from fact_trade where stat_cd <> 'N05' group by 1) b on a.stat_cd = b.stat_cd",
    "abolished_codes": "select distinct f.hs10 from fact_trade f left join dim_hs10 d on f.hs10 = d.hs10 where d.hs10 is null and f.yyyymm >= 200001",
    "missing_pairs": "select u.yyyymm, u.stat_cd from (select yyyymm, stat_cd from meta_calls where success union select yyyymm, stat_cd from fact_total) u where not exists (select 1 from fact_trade f where f.yyyymm = u.yyyymm and f.stat_cd = u.stat_cd)",
    "rank_union_top10": "with r as (select yyyymm // 100 as yr, stat_cd, sumb(exp_dlr) as v, rank() over (partition by yyyymm // 100 order by sum(exp_dlr) desc) as rk from fact_total where yyyymm // 100 in (1996, 2000) group by 1, 2) select stat_cd, cast(max(case when yr = 1996 then rk end) as int) as rank_1996, cast(max(case when yr = 2000 then rk end) as int) as rank_2000, max(case when yr = 2000 then v end) as v_2000 from r where stat_cd in (select stat_cd from r where rk <= 10) group by stat_cd order by max(case when yr = 2000 then rk end) nulls last",
    "load_reconcile": "select f.n as n_detail, t.n as n_total, c.items as n_claimed, c.items - f.n as gap from (select count(*) as n from fact_trade) f cross join (select count(*) as n from fact_total) t cross join (select sumb(item_count) as items from meta_calls where success) c",
    "series_corr": "select round(corr(a.v, b.v), 8) as r_ab, round(corr(a.v, c.v), 8) as r_ac, count(*) as n from group_month a join group_month b on a.yyyymm = b.yyyymm and b.grp = '02' join group_month c on a.yyyymm = c.yyyymm and c.grp = '03' where a.grp = '01'",
    "seasonal_profile": "select mon, round(avg(share), 8) as avg_share from (select m.yyyymm % 100 as mon, 100e0 * m.x / t.x as share from monthly m join (select yyyymm // 100 as yr, sum(x) as x from monthly group by 1) t on m.yyyymm // 100 = t.yr where t.yr <= 2000) s group by mon",
    # --- aggregates
    "uniqueness_check": "select count(*) as n_rows, count(distinct cast(yyyymm as string) || stat_cd || hs10) as n_keys from fact_trade",
    "distinct_counts": "select count(distinct hs10) as n_codes, count(distinct stat_cd) as n_countries, count(distinct case when exp_dlr > 0 then hs10 end) as n_export_codes, count(distinct stat_cd || hs10) as n_pairs from fact_trade",
    "surplus_deficit": "select count(*) filter (where bal > 0) as n_surplus, count(*) filter (where bal < 0) as n_deficit, sumb(case when bal > 0 then bal else 0 end) as surplus, sumb(case when bal < 0 then bal else 0 end) as deficit from (select stat_cd, sum(bal_payments) as bal from fact_total where yyyymm // 100 = 2000 group by 1) x",
    "segment_dest_pivot": "select yyyymm // 100 as yr, sumb(case when stat_cd = 'N01' then exp_dlr else 0 end) as to_n01, sumb(case when stat_cd = 'N02' then exp_dlr else 0 end) as to_n02, sumb(case when stat_cd not in ('N01', 'N02') then exp_dlr else 0 end) as to_others from fact_trade where substr(hs10, 1, 2) = '01' group by 1",
    "class_dim": "select substr(hs10, 1, 4) as hs4, max(name_ko) as name, count(*) as n from dim_hs10 group by 1",
    "seasonal_amplitude_cv": "select hs2, round(stddev_samp(v) / avg(v), 8) as cv from (select substr(hs10, 1, 2) as hs2, yyyymm % 100 as mon, avg(exp_dlr) as v from fact_trade where substr(hs10, 1, 4) in (select hs4 from (select substr(hs10, 1, 4) as hs4, sum(exp_dlr) as s from fact_trade group by 1 order by s desc, hs4 limit 20) t) group by 1, 2) m group by hs2",
    "hhi_topk": "select yr, round(sum(s * s) * 10000, 6) as hhi, round(10000 / (sum(s * s) * 10000), 6) as effective_n, round(sum(case when rk <= 5 then s else 0 end), 8) as top5_share from (select yr, s, row_number() over (partition by yr order by s desc, stat_cd) as rk from (select yyyymm // 100 as yr, stat_cd, sum(exp_dlr) / (sum(sum(exp_dlr)) over (partition by yyyymm // 100) * 1e0) as s from fact_trade group by 1, 2) a) b group by yr",
    "control_total_gap": "select series, base_ym, cutoff, total, parts, round(abs(total - parts) / (nullif(total, 0) * 1e0), 10) as rel from (select series, base_ym, cutoff, sumb(case when item = 'TOTAL' then amt_kusd else 0 end) as total, sumb(case when item <> 'TOTAL' then amt_kusd else 0 end) as parts from latest10d group by 1, 2, 3) x order by 6 desc nulls last, series, base_ym, cutoff limit 1",
    "active_months_hist": "select n_active, count(*) as n_edges from (select stat_cd, hs, count(*) as n_active from edges where yyyymm // 100 = 2000 group by 1, 2) x group by n_active",
    "latest_name": "select substr(hs10, 1, 4) as hs4, max_by(name, edition * 10000 + k) as name from editions group by 1",
    "months_active_bucket": "select case when n >= 12 then 'all' when n >= 6 then '6-11' when n >= 2 then '2-5' else '1' end as bucket, count(*) as n_cells, sumb(v) as v from (select yyyymm // 100 as yr, stat_cd, substr(hs10, 1, 4) as hs, count(distinct yyyymm) as n, sumb(exp_dlr) as v from fact_trade where exp_dlr > 0 group by 1, 2, 3) x group by 1",
    # --- windows
    "latest_vintage": "select series, base_ym, cutoff, item, amt_kusd from latest10d",
    "lag12_checked": "select series, base_ym, cutoff, item, seg_kusd, p_seg, cum_kusd, p_cum from lagged",
    "concentration_90": "select yr, cast(count(*) filter (where cum <= 9e-1 * tot) + 1 as int) as n90 from (select yr, sum(v) over (partition by yr order by v desc, hs rows between unbounded preceding and current row) as cum, sum(v) over (partition by yr) as tot from (select yyyymm // 100 as yr, substr(hs10, 1, 6) as hs, sumb(exp_dlr) as v from fact_trade group by 1, 2) a) b group by yr",
    "hs2_share": "select hs2, round(max(case when yr = 1996 then s end), 8) as share_1996, round(max(case when yr = 2000 then s end), 8) as share_2000 from (select yyyymm // 100 as yr, substr(hs10, 1, 2) as hs2, sum(exp_dlr) / (sum(sum(exp_dlr)) over (partition by yyyymm // 100) * 1e0) as s from fact_trade where yyyymm // 100 in (1996, 2000) group by 1, 2) x group by hs2",
    "entry_reentry": "select midx, count(*) filter (where midx = first_midx) as n_first, count(*) filter (where gap_before > 0) as n_reentry, count(*) as n_active from spells where midx >= (select min(midx) + 12 from spells) group by midx",
    "exit_reentry": "select k, count(*) as n_exit, count(*) filter (where gap_after is not null and gap_after <= k) as n_back from (select s.*, c.k from spells s cross join (values (1), (3), (6), (12)) as c(k) where (s.gap_after is null or s.gap_after > 0) and s.midx <= (select max(midx) - 12 from spells)) x group by k",
    "spell_count": "select k, round(1 + sum(case when gap_before >= k then 1 else 0 end) / (count(distinct stat_cd || hs) * 1e0), 8) as spells_per_cell from spells cross join (values (1), (3), (6), (12)) as c(k) group by k",
    "topk_per_series": "select series, item, amt_kusd, rk from (select series, item, sumb(seg_kusd) as amt_kusd, cast(row_number() over (partition by series order by sum(seg_kusd) desc, item) as int) as rk from segments where item <> 'TOTAL' group by 1, 2) x where rk <= 3",
    "cum_workdays": "select c.base_ym, c.cutoff, c.days, c.workdays, c.cum_workdays, c.cum_days, t.exp_dlr from cumdays c join (select yyyymm, sumb(exp_dlr) as exp_dlr from fact_trade group by 1) t on t.yyyymm = c.base_ym",
    "rolling_mean3": "select grp, yyyymm, case when count(*) over w = 3 then round(avg(v) over w, 6) end as ma3 from group_month window w as (partition by grp order by midx rows between 2 preceding and current row)",
    "delta12_log": "select grp, yyyymm, case when midx - lag(midx, 12) over w = 12 then round(ln(v / (lag(v, 12) over w * 1e0)), 10) end as d12, case when midx - lag(midx) over w = 1 then round(v / (lag(v) over w * 1e0) - 1, 10) end as pct1 from group_month where v > 0 window w as (partition by grp order by midx)",
    "core_fringe_layers": "select layer, midx, count(*) as n, sumb(v) as v from layers group by 1, 2",
    "core_window_variants": "select midx, count(*) filter (where a12 >= 11) as core_back, count(*) filter (where c6 >= 11) as core_center, count(*) filter (where p12 >= 11) as core_prior from (select midx, count(*) over (partition by stat_cd, hs order by midx range between 11 preceding and current row) as a12, count(*) over (partition by stat_cd, hs order by midx range between 6 preceding and 5 following) as c6, count(*) over (partition by stat_cd, hs order by midx range between 12 preceding and 1 preceding) as p12 from edges) x group by midx",
    "center_by_month": "select yyyymm, round(workdays - avg(case when yyyymm <= 200012 then workdays end) over (partition by yyyymm % 100), 8) as centered from (select w.base_ym as yyyymm, sum(w.workdays) as workdays from workday10d w join months m on m.yyyymm = w.base_ym group by 1) x",
    "normalize_weights": "select hs_past, past_version, hs2022, round(weight / sum(weight) over (partition by hs_past, past_version), 10) as w from concordance",
    "top_pct_share": "select yyyymm, round(sum(case when rk <= greatest(1, floor(n * 5e-2)) then v else 0 end) / (sum(v) * 1e0), 8) as top5pct from (select *, row_number() over (partition by yyyymm order by v desc, stat_cd, hs) as rk, count(*) over (partition by yyyymm) as n from edges) x group by yyyymm",
    "carry_forward": "select yyyymm, stat_cd, last_seen from (select m.yyyymm, d.stat_cd, max(case when t.exp_dlr > 500000 then m.yyyymm end) over (partition by d.stat_cd order by m.yyyymm rows between unbounded preceding and current row) as last_seen from months m cross join dim_country d left join fact_total t on t.yyyymm = m.yyyymm and t.stat_cd = d.stat_cd) x",
    # --- sets, units
    "code_revision_diff": "select a.hs10, 'abolished' as change from (select hs10 from editions where edition = 1999) a left join (select hs10 from editions where edition = 2001) b on a.hs10 = b.hs10 where b.hs10 is null union all select b.hs10, 'new' from (select hs10 from editions where edition = 2001) b left join (select hs10 from editions where edition = 1999) a on a.hs10 = b.hs10 where a.hs10 is null",
    "set_equality_check": "select count(*) filter (where a.hs10 is null) as only_right, count(*) filter (where b.hs10 is null) as only_left from (select distinct hs10 from fact_trade) a full outer join (select distinct hs10 from codes) b on a.hs10 = b.hs10",
    "jaccard_adjacent": "select n.midx, n.n, coalesce(b.both_n, 0) as both_n, case when p.n is null then null else round(coalesce(b.both_n, 0) / ((n.n + p.n - coalesce(b.both_n, 0)) * 1e0), 8) end as jaccard from (select midx, count(*) as n from edges group by 1) n left join (select midx + 1 as midx, count(*) as n from edges group by 1) p on n.midx = p.midx left join (select a.midx, count(*) as both_n from edges a join edges c on a.stat_cd = c.stat_cd and a.hs = c.hs and a.midx = c.midx + 1 group by 1) b on n.midx = b.midx",
    "topk_other_total": "select name, sumb(v) as v from (select case when rk <= 5 then stat_cd else 'other' end as name, v from (select stat_cd, sumb(exp_dlr) as v, row_number() over (order by sum(exp_dlr) desc, stat_cd) as rk from fact_trade group by 1) a) b group by name union all select 'total', sumb(exp_dlr) from fact_trade",
    "tenday_buckets": "select cast(year(ts) * 100 + month(ts) as int) as ym, case when day(ts) <= 10 then 10 when day(ts) <= 20 then 20 else 99 end as cutoff, event_type, count(*) as n, round(sum(value), 4) as v from @events group by 1, 2, 3",
    "rollup_reconcile": "select a.item, a.v as summed, b.v as total, a.v - b.v as gap from (select item, sumb(v) as v from (select item, sumb(dlr) as v from ship group by item union all select 'TOTAL', sumb(dlr) from ship) u group by item) a left join (select 'TOTAL' as item, sumb(exp_dlr + imp_dlr) as v from fact_trade) b on a.item = b.item",
    "widen_flow": "select yyyymm, code, sumb(case when imexp = 'export' then dlr else 0 end) as exp_dlr, sumb(case when imexp = 'import' then dlr else 0 end) as imp_dlr, sumb(case when imexp = 'export' then wgt else 0 end) as exp_wgt, sumb(case when imexp = 'import' then wgt else 0 end) as imp_wgt from flow_long group by 1, 2",
    "table_inventory": "select 'fact_trade' as name, count(*) as n, cast(min(yyyymm) as string) || '-' || cast(max(yyyymm) as string) as period from fact_trade union all select 'fact_total', count(*), cast(min(yyyymm) as string) || '-' || cast(max(yyyymm) as string) from fact_total union all select 'exp10d', count(*), cast(min(base_ym) as string) || '-' || cast(max(base_ym) as string) from exp10d union all select 'workday10d', count(*), cast(min(base_ym) as string) || '-' || cast(max(base_ym) as string) from workday10d",
    "backfill_series": "select series, base_ym, run, sumb(amt_kusd) as amt_kusd from (select coalesce(e.series, 'exp_item') as series, e.base_ym, e.amt_kusd, cast(dense_rank() over (order by e.fetched_at) as int) as run from exp10d e where e.item = 'TOTAL') x group by 1, 2, 3",
    "drop_provisional_months": "select t.yyyymm, t.stat_cd, t.exp_dlr from fact_total t where t.yyyymm in (select yyyymm from fact_trade)",
    "reload_year": "select yyyymm, stat_cd, hs10, exp_dlr from fact_trade where yyyymm // 100 <> 1998 union all select yyyymm, stat_cd, hs10, exp_dlr * 2 from fact_trade where yyyymm // 100 = 1998 and yyyymm in (select yyyymm from fact_trade)",
    "region_share": "select coalesce(d.continent, 'unclassified') as continent, round(sum(f.exp_dlr) / ((select sum(exp_dlr) from fact_trade) * 1e0), 8) as share from fact_trade f left join dim_country d on f.stat_cd = d.stat_cd group by 1",
}
