"""Session settings and the shared folder for materialised intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: str | int = "*", app: str = "ticketloom", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ticketloom.scanPartitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor must reach.

    A machine-local folder is only made up for a local master, where driver and
    executors are one process; on a cluster the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="ticketloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_GIVEN_OUT: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet, below the shared folder; the session owns it until ``clear``."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _GIVEN_OUT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear(spark: SparkSession) -> int:
    """Delete the intermediate tables this application has written, and say how many paths it had.

    For the end of a job, when no DataFrame that reads one of them is used any more.
    """
    paths = _GIVEN_OUT.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        for found in (path, f"{path}-checkpoint"):
            where = spark._jvm.org.apache.hadoop.fs.Path(found)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write an aggregate as a table and read it back.

    The plan behind it is cut, it survives lost executors, and its file size is
    known, so Catalyst broadcasts it only when it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
