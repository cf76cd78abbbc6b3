"""The prediction log and what the drift monitor reads instead of it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.operators.retention import within_budget
from ticketloom.sources import commits

LOG_SCHEMA = "ts timestamp, text string, label string"
SOURCE_PREDICTION_LOG = "prediction_log"
SOURCE_TEST_SPLIT = "test_split_fallback"


def scan_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of rotated files or of day folders; a broken line fails the job.

    Day folders ``dt=...`` give the column ``dt``, and a filter on it reads only the
    folders of those days.
    """
    return spark.read.schema(LOG_SCHEMA).option("mode", "FAILFAST").json(path)


RETENTION_SCHEMA = "number long, first_day string, budget long"


def _retention(path: str) -> str:
    return f"{path.rstrip('/')}/_retention"


def first_days(spark: SparkSession, path: str) -> list[str]:
    """The first live day that each retention run told, in order; the latest day of them holds, also if runs met."""
    rows = commits.read(spark, _retention(path), RETENTION_SCHEMA).orderBy("number").collect()
    return [r["first_day"] for r in rows]


def scan_live(spark: SparkSession, path: str) -> DataFrame:
    """The log without the days that retention has dropped, whether or not they are deleted yet."""
    days = first_days(spark, path)
    log = scan_log(spark, path)
    return log.where(F.col("dt") >= F.lit(max(days)).cast("date")) if days else log


def prune_log(spark: SparkSession, path: str, budget: int) -> list[str]:
    """Drop the oldest day folders beyond ``budget`` bytes; returns the days whose folders were deleted.

    Kept days are the newest, so what is live is told by its first day, and one numbered
    commit hides all older ones at once: no reader sees some of them. Their folders are
    deleted by the next run, so that a reader who began before the commit finds its files
    as long as it ends before that run. The first day never goes back. Sizes are those of
    the files, which are listed and not read; a log without day folders is an error, and
    an empty one or one without a path stays as it is.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where):
        return []
    listed = spark.read.format("binaryFile").load(path)
    if "dt" not in listed.columns:
        if listed.isEmpty():
            return []
        raise ValueError(f"{path} has no day folders dt=...")
    days = first_days(spark, path)
    live = listed.where(F.col("dt") >= F.lit(max(days)).cast("date")) if days else listed
    sizes = live.groupBy(F.lit("log").alias("log"), F.col("dt").cast("string").alias("day")).agg(F.sum("length").alias("bytes"))
    first = within_budget(sizes, budget).agg(F.min("day")).first()[0]
    if first is not None:
        commits.append(spark, _retention(path), lambda n: {"number": n, "first_day": first, "budget": budget})
    gone = []
    for status in files.listStatus(where) if days else []:
        name = status.getPath().getName()
        if name.startswith("dt=") and name.removeprefix("dt=") < max(days):
            files.delete(status.getPath(), True)
            gone.append(name.removeprefix("dt="))
    return sorted(gone)


def load_predictions(spark: SparkSession, path: str) -> DataFrame | None:
    """The log, or None when nothing has been served yet."""
    try:
        log = scan_live(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if log.isEmpty() else log


def resolve_current(
    spark: SparkSession, explicit: DataFrame | None, explicit_name: str, log_path: str, test_split: DataFrame
) -> DataFrame:
    """An explicit table, else the log, else the test split; ``current_source`` says which."""
    if explicit is not None:
        current, source = explicit, explicit_name
    else:
        log = load_predictions(spark, log_path)
        current, source = (log, SOURCE_PREDICTION_LOG) if log is not None else (test_split, SOURCE_TEST_SPLIT)
    return current.select("text", "label").withColumn("current_source", F.lit(source))


def write_log(df: DataFrame, path: str) -> None:
    """Append (ts, text, label) as JSON lines, a folder per day."""
    df.withColumn("dt", F.date_format("ts", "yyyy-MM-dd")).write.mode("append").partitionBy("dt").json(path)
