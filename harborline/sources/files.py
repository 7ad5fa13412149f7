"""Readers of the files the trade tables come from, and the fact tables' store. All are Spark scans and writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the monthly files: field names, and the mark of a country's total row.
AMOUNTS = {"expDlr": "exp_dlr", "impDlr": "imp_dlr", "expWgt": "exp_wgt", "impWgt": "imp_wgt", "balPayments": "bal_payments"}
TOTAL = "총계"
ITEM = "struct<" + ",".join(f"{x}:string" for x in (*AMOUNTS, "hsCd", "statCd", "statCdCntnKor1", "statKor", "year")) + ">"
RESPONSE = f"header struct<resultCode:string,resultMsg:string>, body struct<items:struct<item:array<{ITEM}>>>"
STATUS = "success boolean, result_code string, result_msg string, item_count int, response_bytes int, elapsed_sec float, timestamp string"


def amount(text: Column) -> Column:
    """A whole number of a text with blanks and thousands separators; null where it is none."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("long")


def monthly_xml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(detail, totals) of files `YYYYMM_CC.xml`, plain or gzipped.

    Month and country come from the file's name; other names are passed over. Responses with a code other than 00 give
    no rows; one without items gives a total row of zeros. Items of the total row go to totals, others to detail.
    """
    raw = spark.read.format("xml").option("rowTag", "response").schema(RESPONSE).load(path)
    name = F.regexp_extract(F.input_file_name(), r"(\d{6})_([A-Z0-9]{2})\.xml(?:\.gz)?$", 0)
    rows = raw.withColumn("name", name).where("name <> '' and header.resultCode = '00'")
    rows = rows.select(F.substring("name", 1, 6).cast("int").alias("yyyymm"), F.substring("name", 8, 2).alias("stat_cd"), F.explode_outer("body.items.item").alias("i"))
    amounts = [F.coalesce(amount(F.col(f"i.{x}")), F.lit(0).cast("long")).alias(y) for x, y in AMOUNTS.items()]
    detail = rows.where(F.col("i").isNotNull() & (F.trim("i.year") != TOTAL)).select("yyyymm", "stat_cd", F.trim("i.hsCd").alias("hs10"), *amounts)
    totals = rows.where(F.col("i").isNull() | (F.trim("i.year") == TOTAL)).select("yyyymm", "stat_cd", *amounts)
    return detail, totals


def call_status(spark: SparkSession, path: str) -> DataFrame:
    """One row for each `YYYYMM_CC` of status files (one JSON object each); other keys are passed over."""
    calls = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string, struct<{', '.join(x.replace(' ', ':', 1) for x in STATUS.split(', '))}>>")))
    calls = calls.where(F.col("key").rlike(r"^\d{6}_[A-Z0-9]{2}$"))
    blank = lambda c: F.coalesce(f"value.{c}", F.lit("")).alias(c)
    zero = lambda c, t: F.coalesce(f"value.{c}", F.lit(0)).cast(t).alias(c)
    return calls.select(F.substring("key", 1, 6).cast("int").alias("yyyymm"), F.substring("key", 8, 2).alias("stat_cd"), F.coalesce("value.success", F.lit(False)).alias("success"), blank("result_code"), blank("result_msg"), zero("item_count", "int"), zero("response_bytes", "int"), zero("elapsed_sec", "float"), blank("timestamp"))


def country_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A country list, all texts; only empty cells are null, so the country code NA stays."""
    return spark.read.csv(path, header=True, schema=", ".join(f"`{c}` string" for c in columns), nullValue="", emptyValue="", encoding="UTF-8")


def code_rows(sheet: DataFrame, code: str = "hs10") -> DataFrame:
    """Rows of a code sheet whose code has ten characters."""
    return sheet.where(F.length(F.trim(code)) == 10)


def write_fact(fact: DataFrame, path: str) -> None:
    """Write a fact in year folders, in order of month and country; only the years it holds are replaced."""
    years = fact.withColumn("year", F.floor(F.col("yyyymm") / 100).cast("int"))
    ordered = years.repartitionByRange("year", "yyyymm", "stat_cd").sortWithinPartitions("year", "yyyymm", "stat_cd")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def inventory(tables: dict[str, DataFrame], month: str = "yyyymm") -> DataFrame:
    """(name, n, first, last) of each table, in one union."""
    parts = [t.agg(F.count("*").alias("n"), F.min(month).alias("first"), F.max(month).alias("last")).select(F.lit(name).alias("name"), "n", "first", "last") for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def append_by_name(rows: DataFrame, path: str) -> None:
    """Append rows to a Parquet table by column names: columns the rows lack are null, others the table lacks raise."""
    table = rows.sparkSession.read.parquet(path)
    if more := [c for c in rows.columns if c not in table.columns]:
        raise ValueError(f"columns the table lacks: {', '.join(more)}")
    rows.select(*[F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema.fields]).write.mode("append").parquet(path)


def replace_table(rows: DataFrame, path: str) -> None:
    """Write rows beside a table, then put them in its place; rows may read the table they replace. A failed write leaves it as it was."""
    spark = rows.sparkSession
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    target, new, old = jvm_path(path), jvm_path(f"{path}.new"), jvm_path(f"{path}.old")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    rows.write.mode("overwrite").parquet(f"{path}.new")
    fs.delete(old, True)
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"cannot move {path}")
    if not fs.rename(new, target):
        fs.rename(old, target)
        raise OSError(f"cannot move {path}.new")
    fs.delete(old, True)


def migrate(table: DataFrame, renamed: dict[str, str], added: dict[str, str]) -> DataFrame:
    """Columns renamed (old -> new) and added as nulls (name -> type); what has been done already stays, so it can run twice."""
    table = table.withColumnsRenamed({a: b for a, b in renamed.items() if a in table.columns and b not in table.columns})
    return table.withColumns({c: F.lit(None).cast(t) for c, t in added.items() if c not in table.columns})


def export_csv(table: DataFrame, path: str) -> None:
    """Write CSV files with a header that starts with a byte-order mark, for spreadsheets."""
    first, *rest = table.columns
    table.select(F.col(first).alias(f"﻿{first}"), *rest).write.mode("overwrite").csv(path, header=True, encoding="UTF-8", emptyValue="")


def columns_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(name, column, type, position) of each table's schema; no data is read."""
    rows = [(name, f.name, f.dataType.simpleString(), i) for name, t in tables.items() for i, f in enumerate(t.schema.fields, 1)]
    return spark.createDataFrame(rows, "name string, column string, type string, position int")


def schema_check(table: DataFrame, expected: dict[str, str], forbidden: tuple[str, ...] = ()) -> DataFrame:
    """(column, status): ok, missing, type (another one than expected), forbidden or extra."""
    found = dict(table.dtypes)
    rows = [(c, "missing" if c not in found else "ok" if found[c] == t else "type") for c, t in expected.items()]
    rows += [(c, "forbidden" if c in forbidden else "extra") for c in found if c not in expected]
    return table.sparkSession.createDataFrame(rows, "column string, status string")
