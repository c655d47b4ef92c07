"""Reachability over parent links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import scratch


def ancestors(edges: DataFrame, start: DataFrame) -> DataFrame:
    """Nodes that ``start`` reaches over ``edges`` (node, parent), itself included.

    Each round joins only the nodes that the last one found, and visits a node once, so
    cycles end. What a round finds is written to the shared folder: the plan of a round
    does not grow with the rounds before it, and the loss of an executor repeats nothing.
    """
    spark = edges.sparkSession
    links = edges.select(F.col("node").alias("__child"), F.col("parent").alias("__parent")).where("__parent is not null")
    folder = scratch(spark, "reached")
    schema = start.select("node").schema
    start.select("node").distinct().write.parquet(f"{folder}/0")
    round_ = 0
    while True:
        seen = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder)
        front = spark.read.schema(schema).parquet(f"{folder}/{round_}")
        if front.isEmpty():
            return seen
        found = front.join(links, F.col("node") == F.col("__child")).select(F.col("__parent").cast(schema["node"].dataType).alias("node")).distinct()
        round_ += 1
        found.join(seen, "node", "left_anti").write.parquet(f"{folder}/{round_}")
