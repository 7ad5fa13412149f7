"""Workbooks, HTML tables, periods, labels, and changes of stored tables."""

import datetime
import zipfile

import pytest
from pyspark.sql import functions as F

from harborline.functions import columns
from harborline.sources import files, sheets, store, trade

BOOK = {
    "xl/workbook.xml": '<workbook xmlns="m" xmlns:r="rel"><sheets><sheet name="2025" sheetId="1" r:id="a"/><sheet name="2026" sheetId="2" r:id="b"/><sheet name="notes" sheetId="3" r:id="c"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="a" Target="worksheets/s1.xml"/><Relationship Id="b" Target="/xl/worksheets/s2.xml"/><Relationship Id="c" Target="worksheets/s3.xml"/></Relationships>',
    "xl/sharedStrings.xml": '<sst xmlns="m"><si><t>HS code</t></si><si><r><t>Na</t></r><r><t>me</t></r></si><si><t>0101010101</t></si><si><t> horse </t></si></sst>',
    "xl/worksheets/s1.xml": '<worksheet xmlns="m"><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>List</t></is></c></row><row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c></row><row r="3"><c r="A3" t="s"><v>2</v></c><c r="C3" t="s"><v>3</v></c></row><row r="4"><c r="A4"><v>0202020202</v></c></row></sheetData></worksheet>',
    "xl/worksheets/s2.xml": '<worksheet xmlns="m"><sheetData><row r="1"><c r="A1" t="s"><v>1</v></c><c r="B1" t="s"><v>0</v></c></row><row r="2"><c r="A2"><v>7</v></c><c r="B2" t="s"><v>2</v></c></row></sheetData></worksheet>',
    "xl/worksheets/s3.xml": '<worksheet xmlns="m"><sheetData/></worksheet>',
}


def test_workbook_with_sheets_of_different_layouts(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        for name, text in BOOK.items():
            z.writestr(name, text)
    rows = sheets.workbook_rows(spark, str(tmp_path / "b.xlsx"))
    assert sorted((r.sheet, r.row, tuple(r.cells)) for r in rows.collect())[:2] == [("2025", 1, ("List",)), ("2025", 2, ("HS code", None, "Name"))]
    table = sheets.with_header(rows, {"(?i)^hs": "hs10", "(?i)name": "name", "rate": "rate"})
    assert sorted((r.sheet, r.hs10, r.name, r.rate) for r in table.collect()) == [("2025", "0101010101", "horse", None), ("2025", "0202020202", None, None), ("2026", "0101010101", "7", None)]
    last = sheets.latest_sheet(table, "hs10", F.col("sheet"))
    assert sorted((r.hs10, r.sheet) for r in last.collect()) == [("0101010101", "2026"), ("0202020202", "2025")]


def test_html_tables(spark):
    html = "<table><thead><tr><th>Code</th><th>A&amp;B</th></tr></thead><tbody><TR class=x><td>01</td><td> 8 %<br>\n<b>x</b>&nbsp;</td></TR><tr><td>02</td><td></td></tr></tbody></table>"
    got = sheets.html_rows(spark.createDataFrame([(1, html), (2, None), (3, "<p>none")], "id int, html string")).collect()
    assert sorted((r.id, r.row, r.head, tuple(r.cells)) for r in got) == [(1, 0, True, ("Code", "A&B")), (1, 1, False, ("01", "8 % x")), (1, 2, False, ("02", ""))]


def test_periods_and_labels(spark):
    df = spark.createDataFrame([("8% - (2000-01-01 ~ 2000-06-30) 5%-(2000-07-01~)",), ("270%",), (None,)], "t string")
    got = [[tuple(p) for p in r[0]] for r in df.select(columns.periods(F.col("t"))).collect()]
    day = datetime.date
    assert got == [[("8%", day(2000, 1, 1), day(2000, 6, 30)), ("5%", day(2000, 7, 1), None)], [("270%", None, None)], [(None, None, None)]]
    one = spark.createDataFrame([(0.1234, 199901), (-0.05, 200012)], "g double, ym int").select(columns.percent(F.col("g")), columns.month_label(F.col("ym"))).collect()
    assert [tuple(r) for r in one] == [("+12.3%", "1999.01"), ("-5.0%", "2000.12")]


def test_append_replace_and_migrate(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(path)
    files.append_by_name(spark.createDataFrame([("b", 2)], "v string, k long"), path)
    files.append_by_name(spark.createDataFrame([(3,)], "k int"), path)
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert read() == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError, match="lacks: w"):
        files.append_by_name(spark.createDataFrame([(3, 1)], "k int, w int"), path)
    files.replace_table(spark.read.parquet(path).where("k < 3"), path)
    assert read() == [(1, "a"), (2, "b")]
    moved = files.migrate(spark.read.parquet(path), {"v": "name"}, {"made": "int"})
    assert moved.columns == ["k", "name", "made"] and files.migrate(moved, {"v": "name"}, {"made": "int"}).columns == moved.columns


def test_csv_starts_with_a_mark(spark, tmp_path):
    files.export_csv(spark.createDataFrame([("가", 1)], "name string, n int").coalesce(1), str(tmp_path / "c"))
    text = next((tmp_path / "c").glob("part-*.csv")).read_bytes()
    assert text.decode("utf-8-sig").split() == ["name,n", "가,1"] and text.startswith(b"\xef\xbb\xbf")


def test_schema_check(spark):
    df = spark.createDataFrame([(1, "a", 2)], "k int, v string, rn int")
    got = {r.column: r.status for r in files.schema_check(df, {"k": "int", "v": "bigint", "w": "int"}, ("rn",)).collect()}
    assert got == {"k": "ok", "v": "type", "w": "missing", "rn": "forbidden"}


def test_kept_tables_follow_their_input(spark, tmp_path):
    source = str(tmp_path / "in.parquet")
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(source)

    spark.range(5).write.parquet(source)
    a = store.kept(spark, "t", [source], build, "id")
    assert store.kept(spark, "t", [source], build, "id") == a and len(built) == 1
    spark.range(9).write.mode("overwrite").parquet(source)
    assert spark.read.parquet(store.kept(spark, "t", [source], build, "id")).count() == 9 and len(built) == 2


def test_a_month_filter_reaches_the_kept_fact(spark):
    plan = trade.run(spark, "/root/testdata/sf0.001", "select hs10 from fact_trade where yyyymm = 199905")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(yyyymm,199905)" in plan and "lineitem" not in plan and "Exchange" not in plan


def test_feasts_and_workdays(spark):
    run = lambda text: {tuple(r) for r in trade.run(spark, "/root/testdata/sf0.001", text).collect()}
    assert run("select count(*), sum(case when workdays between 0 and 10 then 1 else 0 end) from workday10d") == {(249, 249)}
    assert run("select distinct days from workday10d where base_ym % 100 = 2 and cutoff = 99") == {(8,), (9,)}
    assert run("select var, round(sum(share), 6) from feast_shares where base_ym // 100 = 1998 group by 1") == {(f"{f}_{p}", 1.0) for f in ("seol", "chu") for p in ("pre", "dur", "post")}
    assert run("select cast(day as string), kind from holiday_days where day between date'1998-10-01' and date'1998-10-31'") == {("1998-10-03", "solar"), ("1998-10-04", "chu"), ("1998-10-05", "chu"), ("1998-10-06", "chu")}
