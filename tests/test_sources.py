import gzip
import json

from harborline.functions import columns
from harborline.sources import files


def item(**values):
    return "<item>" + "".join(f"<{k}>{v}</{k}>" for k, v in values.items()) + "</item>"


def response(code, *items):
    return f"<?xml version='1.0' encoding='UTF-8'?><response><header><resultCode>{code}</resultCode><resultMsg>m</resultMsg></header><body><items>{''.join(items)}</items></body></response>"


def test_monthly_xml(spark, tmp_path):
    pages = {
        "200001_NA.xml.gz": response("00", item(year="총계", statCd="-", expDlr="30", impDlr="5", expWgt="1", impWgt="2", balPayments="25"), item(year="2000.01", hsCd="0101010101", statCd="NA", expDlr="1,030", impDlr=" 5", expWgt="1", impWgt="2", balPayments="-25"), item(year="2000.01", hsCd="0202020202", expDlr="0", impDlr="0", expWgt="", impWgt="x", balPayments="0")),
        "200002_US.xml.gz": response("00"),
        "200003_US.xml.gz": response("99", item(year="2000.03", hsCd="0101010101", expDlr="7")),
        "notes.xml.gz": response("00", item(year="2000.03", hsCd="0101010101", expDlr="7")),
    }
    for name, text in pages.items():
        with gzip.open(tmp_path / name, "wb") as f:
            f.write(text.encode())
    detail, totals = files.monthly_xml(spark, str(tmp_path))
    assert sorted(tuple(x) for x in detail.collect()) == [(200001, "NA", "0101010101", 1030, 5, 1, 2, -25), (200001, "NA", "0202020202", 0, 0, 0, 0, 0)]
    assert sorted(tuple(x) for x in totals.collect()) == [(200001, "NA", 30, 5, 1, 2, 25), (200002, "US", 0, 0, 0, 0, 0)]


def test_call_status(spark, tmp_path):
    (tmp_path / "status_2000.json").write_text(json.dumps({"200001_NA": {"success": True, "result_code": "00", "item_count": 3, "elapsed_sec": 0.5}, "200002_US": {}, "broken": {"success": True}}, indent=1))
    got = sorted(tuple(x) for x in files.call_status(spark, str(tmp_path)).collect())
    assert got == [(200001, "NA", True, "00", "", 3, 0, 0.5, ""), (200002, "US", False, "", "", 0, 0, 0.0, "")]


def test_country_csv_keeps_na(spark, tmp_path):
    (tmp_path / "c.csv").write_text("iso2,name\nNA,Namibia\nUS,\n")
    assert [tuple(x) for x in files.country_csv(spark, str(tmp_path / "c.csv"), ["iso2", "name"]).collect()] == [("NA", "Namibia"), ("US", None)]


def test_code_rows(spark):
    sheet = spark.createDataFrame([("0101010101",), ("010101",), (None,)], "hs10 string")
    assert [x.hs10 for x in files.code_rows(sheet).collect()] == ["0101010101"]


def test_a_fact_by_years(spark, tmp_path):
    d, schema = str(tmp_path / "d"), "yyyymm int, stat_cd string, v long"
    files.write_fact(spark.createDataFrame([(199912, "A", 1), (200001, "A", 2), (200002, "A", 3)], schema), d)
    files.write_fact(spark.createDataFrame([(200001, "B", 9)], schema), d)
    assert sorted((x.yyyymm, x.stat_cd, x.v) for x in spark.read.parquet(d).collect()) == [(199912, "A", 1), (200001, "B", 9)]
    assert [tuple(x) for x in files.inventory({"d": spark.read.parquet(d)}).collect()] == [("d", 2, 199912, 200001)]


def test_columns(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(199911, "270% or 6,210 won", "01~20"), (200001, "8", "01~31"), (200012, None, "01~10")], "ym int, r string, p string")
    got = df.select(columns.shift(F.col("ym"), 3), columns.shift(F.col("ym"), -12), columns.rate(F.col("r")), columns.cutoff_of(F.col("p"))).collect()
    assert [x[0] for x in got] == [200002, 200004, 200103] and [x[1] for x in got] == [199811, 199901, 199912]
    assert tuple(got[0][2]) == (270.0, 6210.0) and [x[3] for x in got] == [20, 99, 10]
