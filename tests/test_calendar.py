"""The lunar months against computed new moons."""

import datetime as dt
import math

from harborline.sources import trade

SF = "/root/testdata/sf0.001"


def new_moon(k: int) -> dt.datetime:
    """The k-th new moon after that of January 2000 (universal time), by the usual periodic terms; good to some minutes."""
    t = k / 1236.85
    e = 1 - 0.002516 * t
    m, n, f, o = (math.radians(x) for x in (2.5534 + 29.1053567 * k, 201.5643 + 385.81693528 * k, 160.7108 + 390.67050284 * k, 124.7746 - 1.56375588 * k))
    day = 2451550.09766 + 29.530588861 * k + 0.00015437 * t * t
    day += -0.4072 * math.sin(n) + 0.17241 * e * math.sin(m) + 0.01608 * math.sin(2 * n) + 0.01039 * math.sin(2 * f) + 0.00739 * e * math.sin(n - m) - 0.00514 * e * math.sin(n + m)
    day += 0.00208 * e * e * math.sin(2 * m) - 0.00111 * math.sin(n - 2 * f) - 0.00057 * math.sin(n + 2 * f) + 0.00056 * e * math.sin(2 * n + m) - 0.00042 * math.sin(3 * n)
    day += 0.00042 * e * math.sin(m + 2 * f) + 0.00038 * e * math.sin(m - 2 * f) - 0.00024 * e * math.sin(2 * n - m) - 0.00017 * math.sin(o)
    return dt.datetime(2000, 1, 1, 12) + dt.timedelta(days=day - 2451545) - dt.timedelta(seconds=63)


def test_months_begin_at_new_moons(spark):
    months = trade.run(spark, SF, "select * from lunar_months").collect()
    seoul = {(new_moon(k) + dt.timedelta(hours=9)).date() for k in range(-70, 40)}
    first = {dt.date(1970, 1, 1) + dt.timedelta(days=x.first): x for x in months}
    assert len(first) == len(months) == 12 * 7 + 3
    assert set(first) <= seoul
    days = sorted(first)
    assert all((b - a).days == first[a].days for a, b in zip(days, days[1:], strict=False))


def test_feasts(spark):
    got = {(x.feast, str(x.day)) for x in trade.run(spark, SF, "select feast, day from lunar_days").collect()}
    # fixed values, as announced
    for feast, days in {
        "seol": ("1995-01-31", "1996-02-19", "1997-02-08", "1998-01-28", "1999-02-16", "2000-02-05", "2001-01-24"),
        "chu": ("1995-09-09", "1996-09-27", "1997-09-16", "1998-10-05", "1999-09-24", "2000-09-12", "2001-10-01"),
        "buddha": ("1995-05-07", "1996-05-24", "1997-05-14", "1998-05-03", "1999-05-22", "2000-05-11", "2001-05-01"),
    }.items():
        assert {d for f, d in got if f == feast} == set(days)


def test_every_day_has_one_lunar_date(spark):
    rows = trade.run(spark, SF, "select day, lunar_year, month, leap, lunar_day from lunar_dates").collect()
    assert len(rows) == len({x.day for x in rows}) == len({(x.lunar_year, x.month, x.leap, x.lunar_day) for x in rows}) == (dt.date(2001, 12, 31) - dt.date(1995, 1, 31)).days + 1
    assert {(x.month, x.lunar_day) for x in rows if str(x.day) == "1998-10-05"} == {(8, 15)}
