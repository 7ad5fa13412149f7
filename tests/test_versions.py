"""Versions of tables: what readers see before, during and after a commit."""

import pytest
from pyspark.sql import functions as F

from harborline.sources import store, versions

SCHEMA = "yyyymm int, stat_cd string, v long"


def rows(df):
    return sorted((x.yyyymm, x.stat_cd, x.v) for x in df.collect())


@pytest.fixture
def facts(spark, tmp_path):
    s = versions.Versions(spark, str(tmp_path / "facts"))
    s.replace_years({
        "detail": spark.createDataFrame([(199912, "A", 1), (200001, "A", 2), (200002, "A", 3)], SCHEMA),
        "totals": spark.createDataFrame([(199912, "A", 1), (200001, "A", 2), (200003, "A", 4)], SCHEMA),
    })
    return s


def test_a_reloaded_year_is_one_version(spark, facts):
    n = versions.reload_year(facts, spark.createDataFrame([(200001, "B", 9), (199912, "B", 9)], SCHEMA), spark.createDataFrame([(200001, "B", 9), (200003, "B", 9)], SCHEMA), 2000)
    assert (n, facts.numbers()) == (2, [1, 2])
    assert rows(facts.read("detail")) == [(199912, "A", 1), (200001, "B", 9)] == rows(facts.read("totals"))
    assert rows(facts.read("detail", 1)) == [(199912, "A", 1), (200001, "A", 2), (200002, "A", 3)]
    assert rows(facts.read("totals", 1))[-1] == (200003, "A", 4)
    assert rows(facts.read("detail", years=[1999])) == [(199912, "A", 1)]
    assert len(facts.read("detail", years=[1999]).inputFiles()) < len(facts.read("detail").inputFiles())


def test_a_failing_write_leaves_both_tables(spark, facts):
    before = {t: rows(facts.read(t)) for t in ("detail", "totals")}
    broken = spark.createDataFrame([(200001, "B", 9)], SCHEMA).withColumn("v", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        facts.replace_years({"detail": spark.createDataFrame([(200001, "B", 9)], SCHEMA), "totals": broken}, [2000])
    assert facts.numbers() == [1] and {t: rows(facts.read(t)) for t in ("detail", "totals")} == before
    assert facts.vacuum() >= 1 and {t: rows(facts.read(t)) for t in ("detail", "totals")} == before


def test_two_writers(spark, facts, monkeypatch):
    other = versions.Versions(spark, facts.root)
    write = other._write

    def late(table, df):
        out = write(table, df)
        facts.replace_years({"detail": spark.createDataFrame([(200101, "C", 1)], SCHEMA)})
        return out

    monkeypatch.setattr(other, "_write", late)
    with pytest.raises(versions.Conflict):
        other.replace_years({"detail": spark.createDataFrame([(200101, "D", 2)], SCHEMA)})
    assert facts.numbers() == [1, 2] and (200101, "C", 1) in rows(facts.read("detail")) and (200101, "D", 2) not in rows(facts.read("detail"))
    assert facts._names("_versions") and not [n for n in facts._names("_versions") if n.startswith(".") and n.endswith("json")]


def test_years_are_loaded_once_unless_forced(spark, facts):
    more = spark.createDataFrame([(199912, "Z", 7), (200101, "Z", 7)], SCHEMA)
    assert facts.load_years({"detail": more}, [1999, 2001]) == [2001]
    assert rows(facts.read("detail"))[0] == (199912, "A", 1)
    assert facts.load_years({"detail": more}, [1999, 2001]) == [] and facts.numbers() == [1, 2]
    assert facts.load_years({"detail": more}, [1999], force=True) == [1999] and rows(facts.read("detail"))[0] == (199912, "Z", 7)


def test_a_year_replaced_by_nothing_and_columns(spark, facts):
    facts.replace_years({"detail": spark.createDataFrame([], SCHEMA)}, [2000])
    assert rows(facts.read("detail")) == [(199912, "A", 1)] and facts.years("detail") == [1999]
    facts.replace_years({"detail": spark.createDataFrame([], SCHEMA)}, [1999])
    assert rows(facts.read("detail")) == []
    with pytest.raises(ValueError, match="columns of detail"):
        facts.replace_years({"detail": spark.createDataFrame([(200001, 1)], "yyyymm int, w long")})
    with pytest.raises(ValueError, match="no version 9"):
        facts.read("detail", 9)


def test_vacuum_keeps_what_is_named(spark, facts):
    for v in range(3):
        facts.replace_years({"totals": spark.createDataFrame([(200001, "A", v)], SCHEMA)})
    assert facts.vacuum(keep=2) == 1 and facts.numbers() == [3, 4]
    assert (200001, "A", 2) in rows(facts.read("totals")) and (200001, "A", 1) in rows(facts.read("totals", 3)) and len(rows(facts.read("detail"))) == 3


def test_state_sees_files_inside_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 5)], "a int, p int").write.partitionBy("p").parquet(path)
    first = store.state(spark, path)
    spark.read.parquet(path).collect()
    assert store.state(spark, path) == first
    spark.createDataFrame([(2,)], "a int").write.mode("append").parquet(f"{path}/p=5")
    assert store.state(spark, path) != first
