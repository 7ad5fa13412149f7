import datetime

from harborline.streaming import vintages

SCHEMA = "series string, base_ym int, amt long, fetched_at int"


def test_a_stream_keeps_changed_rows_only(spark, tmp_path):
    source, table, done = (str(tmp_path / x) for x in ("in", "table", "done"))
    batches = [[("a", 1, 5, 1), ("a", 2, 6, 1)], [("a", 1, 5, 2), ("a", 2, 7, 2), ("b", 1, 1, 2)], [("a", 2, 7, 3)]]
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        vintages.keep_vintages(spark.readStream.schema(SCHEMA).parquet(source), table, done, ["series", "base_ym"], "amt").awaitTermination()
    want = [("a", 1, 5, 1), ("a", 2, 6, 1), ("a", 2, 7, 2), ("b", 1, 1, 2)]
    read = lambda: sorted((x.series, x.base_ym, x.amt, x.fetched_at) for x in spark.read.parquet(table).collect())
    assert read() == want
    vintages.append_changes(spark.createDataFrame(batches[1], SCHEMA), table, "b000000001", ["series", "base_ym"], "amt")  # a batch that comes again
    assert read() == want


def test_tolerance(spark, tmp_path):
    path = str(tmp_path / "t")
    for n, v in enumerate((10, 11, 13)):
        vintages.append_changes(spark.createDataFrame([("a", 1, v, n)], SCHEMA), path, f"p{n}", ["series", "base_ym"], "amt", tolerance=1)
    assert sorted(x.amt for x in spark.read.parquet(path).collect()) == [10, 13]


def test_buckets_and_sessions_of_a_stream_equal_those_of_the_table(spark, tmp_path):
    at = lambda d, m: datetime.datetime(2024, 1, d, 12, m)
    rows = [(1, at(5, 0), 1.0), (1, at(5, 20), 2.0), (1, at(5, 55), 3.0), (2, at(15, 0), 4.0), (2, at(25, 0), 5.0)]
    table = spark.createDataFrame(rows, "user_id long, ts timestamp, value double")
    table.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))
    for name, make in (("buckets", lambda e: vintages.bucket_totals(e, "ts", "value", ["user_id"])), ("spells", lambda e: vintages.sessions(e, "ts", "user_id"))):
        make(stream).writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
        assert sorted(tuple(x) for x in spark.table(name).collect()) == sorted(tuple(x) for x in make(table).collect())
    assert sorted(x.n for x in vintages.sessions(table, "ts", "user_id").collect()) == [1, 1, 1, 2]
    assert {x.cutoff for x in vintages.bucket_totals(table, "ts", "value", ["user_id"]).collect()} == {10, 20, 99}
