"""Connected components by least labels and pointer jumps, and tables that outlive lost executors."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import small_batches
from ticketloom.session import fresh_path


class Stash:
    """Tables in the shared folder: each cuts the lineage, and can be dropped when it is of no more use.

    ``batch_rows`` bounds the rows that Python is given at a time while a table is made.
    """

    def __init__(self, spark: SparkSession, batch_rows: int | None = None) -> None:
        self.spark, self.paths, self.batch_rows = spark, {}, batch_rows

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        with small_batches(self.spark, self.batch_rows) if self.batch_rows else nullcontext():
            df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(kept)] = (path, kept)
        return kept

    def drop(self, kept: DataFrame) -> None:
        path, _ = self.paths.pop(id(kept))
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def connected_components(edges: DataFrame, stash: Stash) -> DataFrame:
    """(a, b) -> (node, root): the least node that can be reached, for every node of an edge.

    Each round gives every node its least neighbour as parent, and then the parent's
    parent; edges between nodes of one parent are gone, and the others are drawn between
    the parents. So the edges shrink from round to round, whatever the size of a star or
    the length of a chain; a round with no edge left is the last. Only that comes to the
    driver. An empty edge table gives an empty result.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stash.put(both.where("a <> b").distinct(), "edges")
    labels: DataFrame | None = None
    while True:
        near = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("parent"))
        near = stash.put(near.select(F.col("a").alias("child"), "parent"), "parents")
        further = near.select(F.col("child").alias("at"), F.col("parent").alias("above"))
        top = near.join(further, near["parent"] == further["at"]).select("child", F.col("above").alias("parent"))
        top = stash.put(top, "parents")
        stash.drop(near)
        if labels is None:
            labels = top.select(F.col("child").alias("node"), F.col("parent").alias("root"))
        else:
            old = labels
            moved = old.join(top, old["root"] == top["child"], "left")
            labels = stash.put(moved.select("node", F.coalesce("parent", "root").alias("root")), "labels")
        left = both.join(top.withColumnRenamed("parent", "pa"), F.col("a") == F.col("child")).drop("child")
        left = left.join(top.withColumnRenamed("parent", "pb"), F.col("b") == F.col("child"))
        left = left.where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct()
        left = stash.put(left, "edges")
        stash.drop(both)
        both = left
        if both.isEmpty():
            return labels
