"""Code lists, their revisions and weighted concordances."""

SQL = {
    "dim_country": "select d.stat_cd, d.name_en, d.continent, f.first_ym from dim_country d left join (select stat_cd, min(yyyymm) as first_ym from fact_trade group by 1) f on d.stat_cd = f.stat_cd",
    "dim_coverage": "select count(*) as n_codes, count(d.hs10) as n_known, round(count(d.hs10) / (count(*) * 1e0), 8) as coverage from (select distinct hs10 from fact_trade) f left join dim_hs10 d on f.hs10 = d.hs10",
    "concordance_relation": "select hs_past, past_version, hs2022, case when hs2022 is null then 'deleted' when hs_past is null then 'new' when hs_past = hs2022 then 'identity' else 'mapped' end as relation from (select k.hs10 as hs_past, v.past_version, c.hs2022 from keyed k cross join versions v left join concordance c on c.hs_past = k.hs10 and c.past_version = v.past_version) x",
    "split_merge_counts": "select s.past_version, s.n_split, m.n_merged from (select past_version, count(*) as n_split from (select past_version, hs_past from concordance group by 1, 2 having count(*) > 1) a group by 1) s join (select past_version, count(*) as n_merged from (select past_version, hs2022 from concordance group by 1, 2 having count(*) > 1) b group by 1) m on s.past_version = m.past_version",
    "licensed_pairs": "select a.hs10 as hs_from, b.hs10 as hs_to, case when a.hs10 = b.hs10 then 'self' else 'candidate' end as kind from (select hs10 from editions where edition = 1999) a join (select hs10 from editions where edition = 2001) b on substr(a.hs10, 1, 4) = substr(b.hs10, 1, 4) left join (select hs10 from editions where edition = 2001) a2 on a2.hs10 = a.hs10 left join (select hs10 from editions where edition = 1999) b2 on b2.hs10 = b.hs10 where a.hs10 = b.hs10 or not (a2.hs10 is not null and b2.hs10 is not null)",
    "hs6_links": "select hs6_past, hs6 from hs6_links",
    "licensed_links": "select hs_from, hs_to, case when hs_from = hs_to then 'self' else 'candidate' end as kind from licensed",
    "link_orphans": """select a.hs10, case when b.hs10 is null then 'abolished' else 'alive' end as state from editions a left join (select hs10 from editions where edition = 2001) b on b.hs10 = a.hs10
        where a.edition = 1999 and not exists (select 1 from licensed l where l.hs_from = a.hs10)""",
    "ipf_margins": "with r as (select hs10, sum(exp_dlr) as v from fact_trade where yyyymm between 200007 and 200012 group by 1), c as (select hs10, sum(exp_dlr) as v from fact_trade where yyyymm between 200101 and 200106 group by 1), t as (select (select sum(v) from r) as rs, (select sum(v) from c) as cs) select k.hs10, round(coalesce(r.v, 0) + greatest(t.rs, 1) * 1e-9, 6) as row_margin, round((coalesce(c.v, 0) + greatest(t.rs, 1) * 1e-9) * (t.rs / (t.cs * 1e0)), 6) as col_margin from keyed k cross join t left join r on k.hs10 = r.hs10 left join c on k.hs10 = c.hs10",
    "compose_maps": "select a.hs_past, b.hs2022, round(sum(a.weight * b.weight), 10) as weight from concordance a join concordance b on a.hs2022 = b.hs_past where a.past_version = 1995 and b.past_version = 1997 group by 1, 2",
    "chain_maps": "with m99 as (select hs_past, hs2022, weight, 1999 as past_version from concordance where past_version = 1999), m97 as (select a.hs_past, b.hs2022, sum(a.weight * b.weight) as weight, 1997 as past_version from concordance a join m99 b on a.hs2022 = b.hs_past where a.past_version = 1997 group by a.hs_past, b.hs2022), every as (select * from m97 where hs_past not like '%7' union all select * from m99 where not exists (select 1 from m97 where m97.hs_past = m99.hs_past and m97.hs_past not like '%7')) select hs_past, past_version, hs2022, round(weight / sum(weight) over (partition by hs_past, past_version), 10) as weight from every",
    "hs6_fallback": "with todo as (select distinct v.hs10, v.version from fact_versioned v left join concordance c on c.hs_past = v.hs10 and c.past_version = v.version where v.version <> 2001 and v.exp_dlr + v.imp_dlr > 0 and c.hs_past is null), now as (select d.hs10, coalesce(sum(f.exp_dlr + f.imp_dlr), 0) as v from dim_hs10 d left join fact_trade f on d.hs10 = f.hs10 and f.yyyymm >= 200101 group by 1), cand as (select t.hs10 as hs_past, t.version, n.hs10 as hs2022, n.v, sum(n.v) over (partition by t.hs10, t.version) as tot, count(*) over (partition by t.hs10, t.version) as cnt from todo t join now n on substr(t.hs10, 1, 4) = substr(n.hs10, 1, 4)) select hs_past, version, hs2022, round(case when tot > 0 then v / (tot * 1e0) else 1e0 / cnt end, 10) as weight from cand",
    "weight_audit": "select past_version, round(max(abs(s - 1)), 10) as max_dev, count(*) as n_sources from (select past_version, hs_past, sum(weight) as s from concordance group by 1, 2) x group by 1",
    "map_direct_chain": "with cls as (select hs10, kind as class from dim_hs10), era as (select hs_past, max(past_version) as v from concordance group by 1) select hs10, class, round(weight, 10) as weight, method from (select hs10, class, 1e0 as weight, 'direct' as method from cls union all select c.hs_past, k.class, sum(c.weight), 'chain' from concordance c join era e on c.hs_past = e.hs_past and c.past_version = e.v join cls k on c.hs2022 = k.hs10 where not exists (select 1 from cls where cls.hs10 = c.hs_past) group by 1, 2) x",
    "major10_map": "with lab as (select hs10, case when kind in ('PROMO', 'SMALL') then 'consumer' when kind = 'LARGE' then 'capital' else 'material' end as major10 from dim_hs10) select hs10, major10, round(weight, 10) as weight from (select hs10, major10, 1e0 as weight from lab union all select c.hs_past, l.major10, sum(c.weight) from concordance c join lab l on c.hs2022 = l.hs10 where c.past_version = 1999 and not exists (select 1 from lab where lab.hs10 = c.hs_past) group by 1, 2) x",
    "value_coverage": "select f.version, round(sum(f.exp_dlr * coalesce(c.w, 0)) / (sum(f.exp_dlr) * 1e0), 8) as coverage from fact_versioned f left join (select hs_past, past_version, sum(weight) as w from concordance group by 1, 2) c on c.hs_past = f.hs10 and c.past_version = f.version group by 1",
    "name_change_rate": "select count(*) as n_codes, sumb(case when n > 1 then 1 else 0 end) as n_changed, round(avg(case when n > 1 then 1e0 else 0e0 end), 8) as rate from (select hs10, count(distinct replace(name, ' ', '')) as n from editions group by 1 having count(*) > 1) x",
    "name_agreement": "select a.edition, count(*) as n, round(avg(case when replace(a.name, ' ', '') = replace(k.name, ' ', '') then 1e0 else 0e0 end), 8) as share from editions a join keyed k on a.hs10 = k.hs10 group by 1",
    "revision_events": "select 2001 as rev, hs10, change, reason from (select a.hs10, 'abolished' as change, 'renumbered' as reason from (select hs10 from editions where edition = 1999) a left join (select hs10 from editions where edition = 2001) b on a.hs10 = b.hs10 where b.hs10 is null union all select b.hs10, 'new', c.reason from (select hs10 from editions where edition = 2001) b left join (select hs10 from editions where edition = 1999) a on a.hs10 = b.hs10 left join (select hs2022, max(relation) as reason from concordance where past_version = 1999 group by 1) c on c.hs2022 = b.hs10 where a.hs10 is null) x",
    "abolished_residual": "select count(*) as n_codes, count(*) filter (where dist <= 3) as within_3, count(*) filter (where dist > 12) as beyond_12 from (select a.hs10, max(f.yyyymm // 100 * 12 + f.yyyymm % 100 - (2000 * 12 + 1)) as dist from (select k.hs10 from keyed k left join dim_hs10 d on k.hs10 = d.hs10 where d.hs10 is null) a join fact_trade f on a.hs10 = f.hs10 where f.yyyymm >= 200001 group by 1) x",
    "workday10d": "select w.base_ym, w.cutoff, w.days, w.workdays, w.days - w.workdays as holidays from workday10d w join months m on m.yyyymm = w.base_ym",
    "tariff_fill": "select hs10, adval, source, 19990101 as valid_from, 19991231 as valid_to from (select hs10, cast(k % 30 as double) as adval, 'table' as source from keyed where k % 4 <> 0 union all select k.hs10, cast(8 as double), 'fill' from keyed k left join (select hs10 from keyed where k % 4 <> 0) t on k.hs10 = t.hs10 where t.hs10 is null) x",
    "tree_levels": "with recursive walk(code, level, path) as (select code, 1, code from tree where parent is null union all select t.code, w.level + 1, w.path || '/' || t.code from tree t join walk w on t.parent = w.code where w.level < 9) select code, level, path from walk",
    "count_dominant_vs_apportion": "with dom as (select hs_past, hs2022 from (select hs_past, hs2022, row_number() over (partition by hs_past order by weight desc, hs2022) as rn from concordance where past_version = 1999) x where rn = 1), f as (select distinct hs10, stat_cd from fact_versioned where version = 1999 and exp_dlr > 0) select (select count(distinct d.hs2022 || f.stat_cd) from f join dom d on f.hs10 = d.hs_past) as n_dominant, (select count(distinct c.hs2022 || f.stat_cd) from f join concordance c on f.hs10 = c.hs_past and c.past_version = 1999) as n_apportioned",
    "revision_overlap": "select p.past_version, count(*) as n_mapped, count(*) filter (where e.hs10 is not null) as n_in_edition from (select distinct past_version, hs_past from concordance where relation = 'mapped') p left join editions e on e.hs10 = p.hs_past and e.edition = p.past_version group by 1",
    "concordance_coverage": "select f.version, count(distinct f.hs10) as n_codes, count(distinct case when c.hs_past is not null then f.hs10 end) as n_covered from fact_versioned f left join concordance c on c.hs_past = f.hs10 and c.past_version = f.version where f.version <> 2001 group by 1",
    "carryover_compare": "with a as (select distinct hs10 from fact_trade where yyyymm // 100 = 1998 and exp_dlr > 0), b as (select distinct hs10 from fact_trade where yyyymm // 100 = 2000 and exp_dlr > 0), a2 as (select distinct coalesce(c.hs2022, a.hs10) as hs10 from a left join concordance c on c.hs_past = a.hs10 and c.past_version = 1997), b2 as (select distinct coalesce(c.hs2022, b.hs10) as hs10 from b left join concordance c on c.hs_past = b.hs10 and c.past_version = 1999) select 'raw' as basis, count(*) filter (where a.hs10 is not null and b.hs10 is not null) as n_both, count(*) filter (where b.hs10 is null) as n_gone, count(*) filter (where a.hs10 is null) as n_new from a full outer join b on a.hs10 = b.hs10 union all select 'concorded', count(*) filter (where a2.hs10 is not null and b2.hs10 is not null), count(*) filter (where b2.hs10 is null), count(*) filter (where a2.hs10 is null) from a2 full outer join b2 on a2.hs10 = b2.hs10",
    "yearly_code_coverage": "select f.yr, round(sum(case when e.hs10 is not null then f.v else 0 end) / (sum(f.v) * 1e0), 8) as coverage, count(*) as n_codes, count(e.hs10) as n_known from (select yyyymm // 100 as yr, hs10, sum(exp_dlr + imp_dlr) as v from fact_trade group by 1, 2) f left join (select distinct edition, hs10 from editions) e on f.hs10 = e.hs10 and e.edition = case when f.yr < 1997 then 1995 when f.yr < 1999 then 1997 when f.yr < 2001 then 1999 else 2001 end group by f.yr",
    "two_source_agreement": "select a.edition, count(*) as n, count(*) filter (where coalesce(a.rate, -1) = coalesce(b.rate, -1)) as n_equal, round(avg(case when coalesce(a.rate, -1) = coalesce(b.rate, -1) then 1e0 else 0e0 end), 8) as share from (select edition, hs10, case when k % 6 = 0 then null else k % 30 end as rate from editions) a join (select edition, hs10, case when k % 6 = 0 then null when (k + edition) % 50 = 0 then 5 else k % 30 end as rate from editions where k % 3 <> 1) b on a.edition = b.edition and a.hs10 = b.hs10 group by 1",
}
