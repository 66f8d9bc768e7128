"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def event_scan(
    events: DataFrame,
    types: Sequence[str],
    columns: Sequence[str],
    first_day: str | None = None,
    last_day: str | None = None,
    type_column: str = "event_type",
    day_column: str = "event_time",
) -> DataFrame:
    """Events of some types in a range of days, with only the columns asked for.

    On a table partitioned by type and day both predicates prune folders; on plain parquet they
    reach the row groups.
    """
    wanted = F.col(type_column).isin(list(types)) & F.col(day_column).isNotNull()
    if first_day is not None:
        wanted = wanted & (F.col(day_column) >= F.lit(first_day).cast(events.schema[day_column].dataType))
    if last_day is not None:
        end = F.date_add(F.lit(last_day).cast("date"), 1).cast(events.schema[day_column].dataType)
        wanted = wanted & (F.col(day_column) < end)
    return events.filter(wanted).select(*columns)


def user_scan(
    users: DataFrame, bundles: Sequence[str] | None = None, registered_from: str | None = None, registered_before: str | None = None
) -> DataFrame:
    keep: list[Column] = []
    if bundles is not None:
        keep.append(F.col("bundle_id").isin(list(bundles)))
    if registered_from is not None:
        keep.append(F.col("register_time") >= F.lit(registered_from).cast("timestamp"))
    if registered_before is not None:
        keep.append(F.col("register_time") < F.lit(registered_before).cast("timestamp"))
    return users.filter(reduce(lambda a, b: a & b, keep)) if keep else users


def csv_extract(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str) -> DataFrame:
    """CSV with a header and a given schema; list columns arrive as text for ``functions.lists``."""
    return spark.read.csv(paths, header=True, schema=schema, quote='"', escape='"')


def one_table(extracts: Sequence[DataFrame]) -> DataFrame:
    """Extracts of one schema, columns matched by name, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), extracts)


_BAD = "_undecodable"


def json_result(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Newline JSON as a query service returns it: an envelope line, then one object per line.

    The first line of every file is the envelope, whatever it holds; other lines that are not a JSON
    object are dropped, blank lines too. An object without any of the columns is a row of nulls. Columns
    come back sorted by name; without a schema they are the keys found, as text.
    """
    return _decoded(spark, path, schema).filter(F.col(_BAD).isNull()).drop(_BAD)


def json_rejects(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The lines ``json_result`` drops, as text."""
    return _decoded(spark, path, schema).filter(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("line"))


def _decoded(spark: SparkSession, path: str, schema: str | None) -> DataFrame:
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"))
    lines = lines.withColumn("_line", F.monotonically_increasing_id())
    # The line numbers of one split of a file ascend, and the first split begins at byte 0.
    first = lines.filter("_at = 0").groupBy("_file").agg(F.min("_line").alias("_first"))
    lines = lines.join(first, "_file", "left").filter(F.length(F.trim("value")) > 0)
    envelope = F.coalesce(F.col("_line") == F.col("_first"), F.lit(False))
    if schema is None:
        keys = lines.filter(~envelope).select(F.explode(F.json_object_keys("value")).alias("key")).distinct()
        schema = ", ".join(f"`{r.key}` string" for r in keys.collect()) or "nothing string"
    names = sorted(f.name for f in StructType.fromDDL(schema))
    parsed = lines.select("value", envelope.alias("_envelope"), F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    bad = F.col("_envelope") | F.json_object_keys("value").isNull() | F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    return parsed.select(*[F.col(f"r.`{n}`").alias(n) for n in names], F.when(bad, F.col("value")).alias(_BAD))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header, one file per partition; quotes are doubled, as ``csv_extract`` reads them."""
    df.write.mode(mode).csv(path, header=True, quote='"', escape='"')


def write_events(events: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Event log laid out for ``event_scan``: a folder per type and day, accounts clustered inside.

    Rows are brought together by (type, day) and AQE then splits a busy one, and joins small ones, to tasks
    of the session's ``advisoryPartitionSizeInBytes``: as many writers as its bytes need. Days that share a
    shuffle partition are split with each other, so have more initial partitions than days.
    """
    laid_out = events.withColumn("event_date", F.to_date("event_time")).hint("rebalance", "event_type", "event_date")
    laid_out.sortWithinPartitions("event_type", "event_date", "account_id").write.mode(mode).partitionBy("event_type", "event_date").parquet(path)
