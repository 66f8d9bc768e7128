"""Files written to the shared folder and read back, and columns chosen by name."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskrules.functions import columns as cols
from riskrules.plans.registry import query, sql_time, when_text
from riskrules.session import shared_folder
from riskrules.sources import tables

RESULT_FILES = 32


def _new_folder(spark) -> str:
    return f"{shared_folder(spark).rstrip('/')}/riskrules-{uuid.uuid4().hex}"


@query("A3", "A7", oracle=f"""
SELECT event_id, event_type, value, props, {sql_time('ts')} AS happened FROM events
""")
def csv_written_and_read(r):
    """Events as CSV; their JSON column holds quotes and commas."""
    events = r.table("events").select("event_id", "event_type", "value", "props", F.col("ts").cast("timestamp").alias("ts"))
    path = _new_folder(events.sparkSession)
    tables.write_csv(events, path)
    back = tables.csv_extract(events.sparkSession, path, events.schema)
    return back.select("event_id", "event_type", "value", "props", when_text("ts").alias("happened"))


def _result_files(r) -> tuple:
    """Orders as a query service returns them: files of an envelope line and an object per line, some cut off."""
    orders = r.table("orders")
    text = F.to_json(F.struct("o_orderpriority", "o_orderkey", "o_custkey"))
    line = F.when(F.col("o_orderstatus") == "P", F.substring(text, 1, 20)).otherwise(text)
    lines = orders.select(F.pmod(F.xxhash64("o_orderkey"), F.lit(RESULT_FILES)).alias("file"), F.lit(1).alias("place"), line.alias("value"))
    first = orders.sparkSession.range(RESULT_FILES).select(F.col("id").alias("file"), F.lit(0).alias("place"), F.lit('{"o_custkey": 1, "state": "done"}').alias("value"))
    path = _new_folder(orders.sparkSession)
    laid_out = lines.unionByName(first).repartition(RESULT_FILES, "file").sortWithinPartitions("file", "place")
    laid_out.select("file", "value").write.partitionBy("file").text(path)
    return orders.sparkSession, path, "o_orderkey long, o_custkey long, o_orderpriority string"


@query("A5", oracle="""
SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'
""")
def json_result_read(r):
    return tables.json_result(*_result_files(r))


@query("A5", oracle=f"""
, cut_off AS (SELECT CAST(count(*) AS BIGINT) AS n FROM orders WHERE o_orderstatus = 'P')
SELECT 'envelope' AS kind, CAST({RESULT_FILES} AS BIGINT) AS n UNION ALL SELECT 'cut off', n FROM cut_off
""")
def json_result_rejects(r):
    kind = F.when(F.col("line").endswith("}"), "envelope").otherwise("cut off").alias("kind")
    return tables.json_rejects(*_result_files(r)).groupBy(kind).agg(F.count("*").alias("n"))


@query("B7", "B8", "B9", oracle="""
SELECT l_orderkey AS if_l_order, l_suppkey AS if_l_supp, l_extendedprice AS if_l_extendedprice, l_discount AS if_l_discount FROM lineitem
""")
def columns_by_name(r):
    items = r.table("lineitem")
    wanted = [*cols.with_suffix(items, "key"), *cols.containing(items, "price", "discount", "ship")]
    chosen = cols.without([c for c in wanted if c in cols.numeric(items)], ["l_partkey"])
    return cols.rename_by(cols.strip_suffix(items.select(*chosen), "key"), lambda c: f"if_{c}")
