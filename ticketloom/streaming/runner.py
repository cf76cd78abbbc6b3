"""Starting streams with a checkpoint in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ticketloom.session import fresh_path


def start(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Append a stream to files; the checkpoint makes the sink exactly-once."""
    writer = stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start(path)


def drain(stream: DataFrame, name: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> str:
    """Process everything available now and return the folder written to."""
    path = fresh_path(stream.sparkSession, name)
    start(stream, path, f"{path}-checkpoint", fmt, partition_by).awaitTermination()
    return path


def drain_table(stream: DataFrame, name: str) -> DataFrame:
    """As ``drain``, read back with the stream's own columns."""
    spark: SparkSession = stream.sparkSession
    return spark.read.schema(stream.schema).parquet(drain(stream, name))
