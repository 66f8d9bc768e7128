"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot account's join partition even when the aggregate behind the join then needs
    # its own exchange: the partial aggregate runs on the split tasks, the exchange is small.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on. Shuffle partitions stay the cluster's."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "riskrules", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


# Numbers up to which a table made on the driver is sent to every task (8 MB of doubles).
BROADCAST_VALUES = 1_000_000


def small(table: DataFrame, rows: int, width: int = 4) -> DataFrame:
    """A table of a known number of rows and values per row, for a join: broadcast when that is little."""
    return F.broadcast(table) if rows * width <= BROADCAST_VALUES else table


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests) gets a temporary folder; elsewhere a
    missing setting is an error, and so is a folder of one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    local = spark.sparkContext.master.startswith("local")
    if named is not None:
        if named.startswith("file:") and not local:
            raise RuntimeError(f"spark.checkpoint.dir is {named}; executors on other machines cannot reach it")
        return named
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="riskrules-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def cut(df: DataFrame, file_rows: int = 0) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back from there, files of at most ``file_rows``
    rows each unless it is 0.

    Used where several jobs read the same derived rows: the lineage ends at files that outlive any
    executor, and later jobs read only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/riskrules-{uuid.uuid4().hex}"
    (df.write.option("maxRecordsPerFile", file_rows) if file_rows else df.write).parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []


def remove_written(spark: SparkSession) -> int:
    """Delete the tables that ``cut`` has written so far; for a caller that needs no result of them any more."""
    jvm, conf, paths = spark._jvm, spark._jsc.hadoopConfiguration(), list(_WRITTEN)
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
        _WRITTEN.remove(path)
    return len(paths)
