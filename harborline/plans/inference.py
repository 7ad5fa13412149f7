"""Calendar effects, invariants, cross-series checks, labels and bounds, as SQL; regressions with robust errors as proof texts."""

SQL = {
    "holiday_days": "select h.day, h.kind, coalesce(o.n, 0) as n_orders from holiday_days h left join order_days o on o.day = h.day",
    "calendar_regressors": """select base_ym, round(ln_wd, 8) as ln_wd, round(seol_pre, 8) as seol_pre, round(seol_dur, 8) as seol_dur, round(seol_post, 8) as seol_post,
        round(chu_pre, 8) as chu_pre, round(chu_dur, 8) as chu_dur, round(chu_post, 8) as chu_post from regressors r join months m on m.yyyymm = r.base_ym""",
    "orders_by_lunar_month": "select d.lunar_year, d.month, d.leap, count(*) as n_days, sumb(o.n) as n_orders from order_days o join lunar_dates d on d.day = o.day group by 1, 2, 3",
    # each invariant with the points it was checked at and its largest deviation
    "invariants": """with parts as (
          select l.series, l.base_ym, l.cutoff, sum(l.seg_kusd - l.p_seg) as d, count(l.p_seg) as n from lagged l where l.item <> 'TOTAL' group by 1, 2, 3),
        running as (
          select series, base_ym, item, cum_kusd, sum(seg_kusd) over (partition by series, base_ym, item order by cutoff rows between unbounded preceding and current row) as run from segments)
        select 'contributions add up to growth' as name, count(*) as n, round(max(abs(100 * p.d / (t.p_seg * 1e0) - 100 * (t.seg_kusd - t.p_seg) / (t.p_seg * 1e0))), 6) as gap
          from parts p join lagged t on t.series = p.series and t.base_ym = p.base_ym and t.cutoff = p.cutoff and t.item = 'TOTAL' where p.n = 6 and t.p_seg > 0
        union all select 'increments add up to levels', count(*), round(max(abs(run - cum_kusd)) * 1e0, 6) from running
        union all select 'an elasticity of one is the daily mean', count(*), round(max(abs(cum_kusd * (p_cum_workdays / (cum_workdays * 1e0)) / p_cum - (cum_kusd / (cum_workdays * 1e0)) / (p_cum / (p_cum_workdays * 1e0)))), 6)
          from lagged where p_cum > 0 and cum_workdays > 0 and p_cum_workdays > 0
        union all select 'progress lies between 0 and 1', count(*), round(max(case when m.cum_kusd > t.cum_kusd then m.cum_kusd - t.cum_kusd when m.cum_kusd < 0 then -m.cum_kusd else 0 end) * 1e0, 6)
          from metric m join metric t on t.series = m.series and t.base_ym = m.base_ym and t.item = m.item and t.cutoff = 99""",
    "totals_beta": """select series, cast(count(*) as bigint) as n_items, round(min(b), 6) as least, round(avg(b), 6) as mean, round(max(b), 6) as most, round(max(case when item = 'TOTAL' then b end), 6) as total,
        count(*) filter (where b <= 0 or b >= 16e-1) as n_outside from beta group by series""",
    "graded_bins": """select case when w <= 5 then '(0, 5]' when w <= 10 then '(5, 10]' when w <= 20 then '(10, 20]' when w <= 50 then '(20, 50]' else '(50, inf)' end as bin, count(*) as n, sumb(exp_dlr) as exp_dlr
        from (select exp_wgt as w, exp_dlr from fact_trade where exp_wgt > 0) x group by 1""",
    "extreme_months": """select grp, max(case when hi = 1 then yyyymm end) as most_ym, max(v) as most, max(case when lo = 1 then yyyymm end) as least_ym, min(v) as least
        from (select grp, yyyymm, v, row_number() over (partition by grp order by v desc, yyyymm) as hi, row_number() over (partition by grp order by v, yyyymm) as lo from group_month) x group by grp""",
    "nlargest_months": """select grp, yyyymm, v, cast(rn as int) as rank from (select grp, yyyymm, v, row_number() over (partition by grp order by v desc, yyyymm) as rn from group_month) x where rn <= 3""",
    "display_order": """select o.pos, g.kind, g.n from (values (1, 'PROMO'), (2, 'SMALL'), (3, 'LARGE'), (4, 'MEDIUM'), (5, 'STANDARD'), (6, 'ECONOMY')) as o(pos, kind)
        join (select kind, count(*) as n from dim_hs10 group by kind) g on g.kind = o.kind order by o.pos""",
    # levels known of the tables whatever their size
    "anchor_check": """select a.name, a.expected, g.got, a.expected = g.got as ok from (values ('first month', 199501), ('last month', 200111), ('months', 83), ('continents', 5)) as a(name, expected)
        join (select 'first month' as name, min(yyyymm) as got from months union all select 'last month', max(yyyymm) from months union all select 'months', count(*) from months
              union all select 'continents', count(distinct continent) from dim_country) g on g.name = a.name""",
}

def eliminated(panel: str, names: tuple[str, ...], rows: str, where: str = "true", kept: dict[int, str] | None = None) -> tuple[list[str], str]:
    """Common table expressions whose last one has f, the least-squares value of y on names, for each row of panel (series, midx, y, names).

    `rows` is the window's frame: the rows whose sums of products are the normal equations, a window for each sum. A column is
    eliminated at a time, from the equations and from the row itself alike, and adds its part to f; a column without anything
    of its own adds nothing. kept: f after so many columns, under a name.
    """
    k = len(names)
    pair = lambda i, j: f"a{min(i, j)}{max(i, j)}"
    sums = [f"sum({names[i]} * {names[j]}) {rows} as {pair(i, j)}" for i in range(k) for j in range(i, k)] + [f"sum({names[i]} * y) {rows} as b{i}" for i in range(k)]
    layers = [f"panel as ({panel})", f"l0 as (select series, midx, y, {', '.join(f'{n} as x{i}' for i, n in enumerate(names))}, {', '.join(sums)}, count(*) {rows} as n, 0e0 as f from panel)"]
    done: list[str] = []
    for s in range(k):
        over = f"case when a{s}{s} > 1e-14 then {{}} / a{s}{s} else 0 end"
        columns = ["series", "midx", "y", "n", *done]
        if kept and s in kept:
            columns.append(f"f as {kept[s]}")
            done.append(kept[s])
        for i in range(s + 1, k):
            columns += [f"{pair(i, j)} - {pair(s, i)} * {over.format(pair(s, j))} as {pair(i, j)}" for j in range(i, k)]
            columns += [f"b{i} - {pair(s, i)} * {over.format(f'b{s}')} as b{i}", f"x{i} - {pair(s, i)} * {over.format(f'x{s}')} as x{i}"]
        columns.append(f"f + x{s} * {over.format(f'b{s}')} as f")
        layers.append(f"l{s + 1} as (select {', '.join(columns)} from l{s} where {where if s == 0 else 'true'})")
    return layers, f"l{k}"


def nested(panel: str, start: int, names: tuple[str, ...] = ("c", "y1", "y2", "v"), base: int = 3, least: int = 12, lags: int = 12) -> str:
    """SQL text: one-step forecasts of y by least squares on names[:base] and on all names, each from the rows before it.

    Rows: series, n, rmse of both models, t of the adjusted difference of squared errors (robust).
    """
    before = "over (partition by series order by midx rows between unbounded preceding and 1 preceding)"
    layers, last = eliminated(panel, names, before, f"n >= {least}", {base: "f0"})
    layers.append(f"w as (select series, row_number() over (partition by series order by midx) as i, (y - f0) * (y - f0) as e0, (y - f) * (y - f) as e1, (f0 - f) * (f0 - f) as d from {last} where midx >= {start})")
    layers.append("s as (select series, count(*) as n, avg(e0) as m0, avg(e1) as m1, avg(e0 - e1 + d) as m from w group by series)")
    layers.append("u as (select w.series, w.i, w.e0 - w.e1 + w.d - s.m as u from w join s on s.series = w.series)")
    weights = ", ".join(f"({j}, {1 if j == 0 else 2 * (1 - j / (lags + 1))!r}e0)" for j in range(lags + 1))
    layers.append(f"h as (select p.series, sum(g.w * p.u * q.u) as v from u p cross join (select cast(j as bigint) as j, w from (values {weights}) as g(j, w)) g join u q on q.series = p.series and q.i = p.i - g.j group by p.series)")
    return "with " + ",\n    ".join(layers) + "\n    select s.series, s.n, round(sqrt(s.m0), 8) as rmse0, round(sqrt(s.m1), 8) as rmse1, round(case when h.v > 0 then s.m * s.n / sqrt(h.v) end, 6) as cw_t from s join h on h.series = s.series"


def residuals(panel: str, names: tuple[str, ...]) -> str:
    """SQL text: (series, midx, y, e), what a regression of y on names leaves of each row of its series."""
    layers, last = eliminated(panel, names, "over (partition by series)", f"n >= {len(names)}")
    return "with " + ",\n    ".join(layers) + f"\n    select series, midx, round(y, 8) as y, round(y - f, 8) as e from {last}"


# growth of each group over twelve months: its own two lags, and the growth of all exports
PANEL = """select series, midx, y, 1e0 as c, y1, y2, v from (
      select b.grp as series, b.midx, ln(b.v / (a.v * 1e0)) as y, ln(t1.x / (t0.x * 1e0)) as v, lag(ln(b.v / (a.v * 1e0)), 1) over w as y1, lag(ln(b.v / (a.v * 1e0)), 2) over w as y2
      from group_month a join group_month b on a.grp = b.grp and b.midx = a.midx + 12 join monthly t0 on t0.midx = a.midx join monthly t1 on t1.midx = b.midx
      where a.v > 0 and b.v > 0 and t0.x > 0 and t1.x > 0 window w as (partition by b.grp order by b.midx)) g where y2 is not null"""
SQL["bridge_oos"] = nested(PANEL, 1999 * 12)
# the same growth on that of the seven calendar regressors
CALENDAR = ("ln_wd", "seol_pre", "seol_dur", "seol_post", "chu_pre", "chu_dur", "chu_post")
SQL["decalendar_residuals"] = residuals(f"""select b.grp as series, b.midx, ln(b.v / (a.v * 1e0)) as y, 1e0 as c, {', '.join(f'r.{n} - p.{n} as {n}' for n in CALENDAR)} from group_month a join group_month b on a.grp = b.grp and b.midx = a.midx + 12
      join regressors r on r.base_ym = b.yyyymm join regressors p on p.base_ym = a.yyyymm where a.v > 0 and b.v > 0""", ("c", *CALENDAR))

# slope and robust error of growth on workday growth; $y, $p, $w, $q: columns, $where: rows
_ROBUST = """with x as (
      select series, item, row_number() over (partition by series, item order by cutoff, base_ym) as i, ln($y / ($p * 1e0)) as y, ln($w / ($q * 1e0)) as x
      from lagged where $y > 0 and $p > 0 and $w > 0 and $q > 0 and $where),
    f as (
      select series, item, count(*) as n, sum(x) as sx, sum(x * x) as sxx, sum(y) as sy, sum(x * y) as sxy, regr_slope(y, x) as b, regr_intercept(y, x) as a, regr_r2(y, x) as r2
      from x group by series, item having count(*) >= 24),
    e as (select x.series, x.item, x.i, x.x, x.y - f.a - f.b * x.x as e from x join f on f.series = x.series and f.item = x.item),
    g as (
      select p.series, p.item, sum(w.w * p.e * q.e) as s00, sum(w.w * 5e-1 * (p.x + q.x) * p.e * q.e) as s01, sum(w.w * p.x * q.x * p.e * q.e) as s11, sum(case when w.k = 0 then p.e * p.e else 0 end) as ss
      from e p cross join (select cast(k as bigint) as k, case when k = 0 then 1e0 else 2 * (1 - k / 13e0) end as w from (values (0), (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12)) as l(k)) w
      join e q on q.series = p.series and q.item = p.item and q.i = p.i - w.k group by p.series, p.item),
    r as (
      select f.series, f.item, f.b as beta, sqrt(greatest(f.sx * f.sx * g.s00 - 2 * f.n * f.sx * g.s01 + f.n * f.n * g.s11, 0)) / abs(f.n * f.sxx - f.sx * f.sx) as se, f.n, f.r2, sqrt(g.ss / (f.n - 2)) as resid_sd
      from f join g on g.series = f.series and g.item = f.item)
    """


def robust(select: str, scope: str = "seg", where: str = "true") -> str:
    """SQL text of `select` over r (series, item, beta, se, n, r2, resid_sd)."""
    y, p, w, q = {"seg": ("seg_kusd", "p_seg", "workdays", "p_workdays"), "cum": ("cum_kusd", "p_cum", "cum_workdays", "p_cum_workdays")}[scope]
    return _ROBUST.replace("$where", where).replace("$y", y).replace("$p", p).replace("$w", w).replace("$q", q) + select
