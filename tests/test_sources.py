import datetime as dt
import re

from pyspark.sql import functions as F

from riskrules.functions import lists
from riskrules.sources import tables


def test_csv_round_trip_with_list_columns(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "[1.5, null, 3]"), (2, "[]")], "account_id long, payment_history string")
    tables.write_csv(df, path)
    back = tables.csv_extract(spark, path, "account_id long, payment_history string")
    parsed = {r[0]: r[1] for r in back.select("account_id", lists.parse_numbers(F.col("payment_history"))).collect()}
    assert parsed == {1: [1.5, None, 3.0], 2: []}


def test_csv_keeps_quotes_and_commas(spark, tmp_path):
    rows = [(1, '{"k": 1, "t": "a,b"}'), (2, 'say "x"'), (3, "back\\slash"), (4, None)]
    path = str(tmp_path / "out")
    tables.write_csv(spark.createDataFrame(rows, "id long, props string"), path)
    assert sorted(map(tuple, tables.csv_extract(spark, path, "id long, props string").collect())) == rows


def test_extracts_by_name(spark):
    a = spark.createDataFrame([(1, 2.0)], "id int, x double")
    b = spark.createDataFrame([(3.0, 4, "z")], "x double, id int, extra string")
    assert sorted(map(tuple, tables.one_table([a, b]).select("id", "x", "extra").collect())) == [(1, 2.0, None), (4, 3.0, "z")]


def test_json_result_drops_the_first_line_and_what_it_cannot_read(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"result{i}.json").write_text('{"a": "ok", "b": 9}\n{"b": 1, "a": "x"}\nnot json\n[1]\n{"b": null}\n{"c": 5}\n\n')
    found = tables.json_result(spark, str(tmp_path), "b int, a string")
    assert found.columns == ["a", "b"]
    assert sorted(map(str, found.collect())) == sorted(["Row(a='x', b=1)", "Row(a=None, b=None)", "Row(a=None, b=None)"] * 2)
    assert sorted(r[0] for r in tables.json_rejects(spark, str(tmp_path), "b int, a string").collect()) == sorted(["not json", "[1]", '{"a": "ok", "b": 9}'] * 2)
    free = tables.json_result(spark, str(tmp_path))
    assert free.columns == ["a", "b", "c"] and sorted(r.b or "" for r in free.collect()) == ["", "", "", "", "1", "1"]


def test_event_log_is_pruned_by_type_and_reads_few_columns(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = [(i, i % 3, dt.datetime(2024, 1, 1 + i % 4, 10), ["pay", "play"][i % 2], float(i)) for i in range(40)]
    log = spark.createDataFrame(rows, "event_id long, account_id long, event_time timestamp, event_type string, value double")
    tables.write_events(log, path)
    found = tables.event_scan(spark.read.parquet(path), ["pay"], ["event_id"], "2024-01-02", "2024-01-03", day_column="event_date")
    assert sorted(r[0] for r in found.collect()) == [i for i in range(40) if i % 2 == 0 and i % 4 in (1, 2)]
    plan = found._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*\]", plan) and re.search(r"PartitionFilters: \[[^\]]*event_type[^\]]*\]", plan)
    assert "ReadSchema: struct<event_id:bigint>" in plan


def test_busy_day_is_written_by_as_many_tasks_as_it_needs(spark, tmp_path):
    keep, many = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.conf.set(many, "400")  # more shuffle partitions than days, as on a cluster
    at = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40)
    log = spark.range(0, 60_000, 1, 12).select(F.col("id").alias("event_id"), (F.col("id") % 7).alias("account_id"), F.expr("uuid()").alias("note"), F.lit("pay").alias("event_type"), at.alias("day"))
    log = log.withColumn("event_time", F.timestamp_add("DAY", F.col("day").cast("int"), F.lit(dt.datetime(2024, 1, 1))))
    files = {}
    try:
        for size in ("64k", "64m"):
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
            tables.write_events(log, str(tmp_path / size))
            files[size] = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / size / "event_type=pay").iterdir() if d.is_dir()}
            assert spark.read.parquet(str(tmp_path / size)).count() == 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", keep)
        spark.conf.unset(many)
    assert len(files["64k"]) == len(files["64m"]) == 40
    assert files["64k"]["event_date=2024-01-01"] > 8 and files["64m"]["event_date=2024-01-01"] == 1
    assert sorted(files["64k"].values())[20] <= 2


def test_user_scan(spark):
    users = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "a"), (2, dt.datetime(2024, 2, 1), "b")], "account_id long, register_time timestamp, bundle_id string")
    assert [r[0] for r in tables.user_scan(users, ["a", "b"], registered_from="2024-01-15").collect()] == [2]
    assert tables.user_scan(users).count() == 2
