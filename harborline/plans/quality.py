"""Checks of the facts and dimensions, each as a query."""

SQL = {
    "identity_violations": "select 'fact_trade' as name, count(*) as n, count(*) filter (where bal_payments <> exp_dlr - imp_dlr) as n_bad from fact_trade union all select 'fact_total', count(*), count(*) filter (where bal_payments <> exp_dlr - imp_dlr) from fact_total",
    "negative_values": "select 'money' as what, 'FAIL' as severity, count(*) filter (where exp_dlr < 0 or imp_dlr < 0) as n from fact_trade union all select 'weight', 'INFO', count(*) filter (where exp_wgt < 0 or imp_wgt < 0) from fact_trade",
    "null_counts": "select count(*) filter (where yyyymm is null) as n_yyyymm, count(*) filter (where stat_cd is null) as n_stat_cd, count(*) filter (where hs10 is null) as n_hs10, count(*) filter (where exp_dlr is null or imp_dlr is null) as n_money, count(*) filter (where exp_wgt is null or imp_wgt is null) as n_weight from fact_trade",
    "missing_months": "select c.base_ym from (select distinct base_ym from calendar where base_ym <= 200112) c left join months m on c.base_ym = m.yyyymm where m.yyyymm is null",
    "orphan_parents": "select t.code, t.parent from tree t left join tree p on t.parent = p.code where t.parent is not null and p.code is null",
    "load_summary": "select count(*) as n_calls, count(*) filter (where success and item_count = 0) as n_zero, count(*) filter (where not success) as n_failed, min(yyyymm) as from_ym, max(yyyymm) as to_ym, count(distinct stat_cd) as n_countries from meta_calls",
    "detail_total_reconcile": "select t.yyyymm, t.stat_cd, t.exp_dlr as total, coalesce(d.exp_dlr, 0) as detail, t.exp_dlr - coalesce(d.exp_dlr, 0) as gap from fact_total t left join (select yyyymm, stat_cd, sumb(exp_dlr) as exp_dlr from fact_trade group by 1, 2) d on t.yyyymm = d.yyyymm and t.stat_cd = d.stat_cd where t.exp_dlr <> coalesce(d.exp_dlr, 0)",
    "validation_report": "select 'values' as category, 'balance identity' as name, case when count(*) filter (where bal_payments <> exp_dlr - imp_dlr) = 0 then 'PASS' else 'FAIL' end as status from fact_trade union all select 'values', 'no negative money', case when count(*) filter (where exp_dlr < 0 or imp_dlr < 0) = 0 then 'PASS' else 'FAIL' end from fact_trade union all select 'dims', 'codes known', case when count(*) filter (where d.hs10 is null) = 0 then 'PASS' else 'WARN' end from (select distinct hs10 from fact_trade) f left join dim_hs10 d on f.hs10 = d.hs10 union all select 'loading', 'calls without failure', case when count(*) filter (where not success) = 0 then 'PASS' else 'FAIL' end from meta_calls",
}
