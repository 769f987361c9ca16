import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from tidemart.sources import catalog, files, jdbc, kafka, tables
from tidemart.sources.upsert import UpsertTable


@pytest.mark.parametrize("relational,warehouse", [
    ("bigint(20) unsigned", "bigint"), ("decimal(16, 2)", "decimal(16,2)"), ("DECIMAL", "decimal(10,0)"), ("varchar(64)", "string"),
    ("datetime", "timestamp"), ("enum('a','b')", "string"), ("tinyint(1)", "int"), ("geometry", "string")])
def test_warehouse_types(relational, warehouse):
    assert jdbc.warehouse_type(relational) == warehouse


def test_ddl_quotes_comments():
    ddl = jdbc.warehouse_ddl("db.t", [jdbc.RelationalColumn("id", "int", "it's")], "/w/t", comment="c")
    assert "`id` int COMMENT 'it\\'s'" in ddl and "PARTITIONED BY (`dt`)" in ddl


def test_export_options_and_columns(spark):
    df = spark.range(1).select(F.col("id"), F.lit("x").alias("Name"), F.lit("y").alias("name"), F.lit(1.5).cast("decimal(10,2)").alias("m"))
    out = jdbc.unique_columns(df)
    assert out.columns == ["id", "Name", "m"] and out.first()["Name"] == "x"
    options = jdbc.export_options(out)
    assert options["batchsize"] == "10000" and options["createTableColumnTypes"] == "`id` BIGINT, `Name` TEXT, `m` DECIMAL(10,2)"


def test_credentials_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("JDBC_USER", "u")
    monkeypatch.delenv("JDBC_PASSWORD", raising=False)
    assert jdbc.Connection("jdbc:x", "d").properties() == {"driver": "d", "user": "u"}
    monkeypatch.delenv("AWS_ACCESS_KEY_ID", raising=False)
    assert "spark.hadoop.fs.s3a.access.key" not in catalog.object_store_conf("http://store")


def test_topic_options(spark):
    assert kafka.source_options("s", ["a", "b"], "g", max_rows=kafka.LOAD_ROWS)["maxOffsetsPerTrigger"] == "300000"
    assert kafka.sink_options("s", "t")["kafka.acks"] == "all"
    raw = spark.createDataFrame([(bytearray(b'{"id": 1}'), 5), (None, 6)], "value binary, offset bigint")
    text = kafka.as_text(raw)
    assert [r["offset"] for r in text.collect()] == [5]
    parsed = kafka.as_records(text, T.StructType([T.StructField("id", T.LongType())]))
    assert parsed.first()["id"] == 1
    assert kafka.to_messages(parsed, "id").first().asDict() == {"key": "1", "value": '{"id":1}'}


def test_tsv_and_calendar_files(spark, folder):
    with open(f"{folder}/a.tsv", "w") as f:
        f.write("id\tts\n1\t2024-01-02 03:04:05\n2\t\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType())])
    out = files.with_partition(files.read_tsv(spark, f"{folder}/a.tsv", schema), "ts").collect()
    assert [(r["id"], r["dt"]) for r in out] == [(1, "20240102")]
    with pytest.raises(ValueError):
        files.write_columnar(spark.range(1), f"{folder}/x", "csv")


def test_overwriting_a_day_is_idempotent(spark, folder):
    path = f"{folder}/t"
    rows = lambda day, n: spark.createDataFrame([(day, i) for i in range(n)], "dt string, v int")
    tables.overwrite_days(rows("2024-01-01", 3).union(rows("2024-01-02", 2)), path)
    for _ in range(2):
        tables.overwrite_days(rows("2024-01-02", 5), path)
    counts = {str(r["dt"]): r["count"] for r in spark.read.parquet(path).groupBy("dt").count().collect()}
    assert counts == {"2024-01-01": 3, "2024-01-02": 5}
    assert tables.retain_days(spark, path, dt.date(2024, 1, 2), keep_past=0) == ["2024-01-01"]
    assert tables.list_partitions(spark, path) == ["2024-01-02"]
    tables.accumulate_report(rows("2024-01-03", 1).union(rows("2024-01-03", 1)), path)
    assert spark.read.parquet(path).filter("dt = '2024-01-03'").count() == 1


def test_catalog_round_trip(spark, folder):
    df = spark.createDataFrame([("2024-01-01", 1)], "dt string, v int")
    tables.create_day_table(spark, "day_table", f"{folder}/day_table", df.select("v", "dt"))
    tables.overwrite_days(df, f"{folder}/day_table")
    assert spark.table("day_table").count() == 0
    tables.recover_partitions(spark, "day_table")
    assert spark.table("day_table").count() == 1 and "day_table" in catalog.list_tables(spark)
    spark.sql("DROP TABLE day_table")


def test_upsert_table(spark, folder):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("ts_ms", T.LongType())])
    store = UpsertTable(spark, f"{folder}/u", schema, ["k"], slice_ms=1000)
    assert store.latest().count() == 0
    batch = lambda *rows: spark.createDataFrame(list(rows), schema)
    store.upsert(batch((1, "a", 10), (1, "b", 20), (2, "c", 5)), 0)
    store.upsert(batch((1, "late", 15), (2, "d", 3000)), 1)
    store.upsert(batch((1, "late", 15), (2, "d", 3000)), 1)
    current = lambda s, now=None: {r["k"]: r["v"] for r in s.latest(now).collect()}
    assert current(store) == {1: "b", 2: "d"} and store.rows().count() == 4
    assert current(store.compact(f"{folder}/c")) == {1: "b", 2: "d"}
    kept = UpsertTable(spark, f"{folder}/u", schema, ["k"], retention_ms=100, slice_ms=1000)
    assert current(kept, 3050) == {2: "d"}
