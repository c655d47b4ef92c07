"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, in_few, materialize


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, rows: int | None = None) -> tuple[DataFrame, str]:
    """The component of every linked node: columns ``hi`` (node), ``lo`` (smallest node reachable).

    ``edges`` has two long columns; rows with nulls or equal ends are ignored. The
    smallest node of a component has no row of its own. Each step is written to the
    shared folder, so the lineage stays short and no node of the graph reaches the
    driver. A hub's edges meet its minimum in a sort-merge join on plain exchanges,
    which adaptive execution may split. ``rows`` says how many rows ``edges`` may have;
    each step writes files for the rows that it can have. Returns the table and its path.
    """
    spark = edges.sparkSession
    a, b = edges.columns
    start = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi > lo").distinct()
    state, path = materialize(start if rows is None else in_few(start, rows), "links")
    before = _signature(state)
    while before[0]:
        both = state.select(F.col("hi").alias("node"), F.col("lo").alias("other")).union(state.select("lo", "hi"))
        least = both.groupBy("node").agg(F.min("other").alias("m"))
        # The key is written differently on either side of the aggregate, so that the join has its own exchanges.
        least = least.select(F.col("node").bitwiseXOR(F.lit(1)).alias("key"), F.least("m", "node").alias("m"))
        upper = both.where("other > node").withColumn("key", F.col("node").bitwiseXOR(F.lit(1)))
        large = upper.join(least, "key").select(F.col("other").alias("hi"), F.col("m").alias("lo")).distinct()
        large, large_path = materialize(in_few(large, before[0]), "large-star")
        least = large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").bitwiseXOR(F.lit(1)).alias("key"), "m")
        small = large.withColumn("key", F.col("hi").bitwiseXOR(F.lit(1))).join(least, "key")
        small = small.select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        state, next_path = materialize(in_few(small.select("e.hi", "e.lo").where("hi > lo").distinct(), 2 * before[0]), "links")
        discard(spark, path)
        discard(spark, large_path)
        path = next_path
        after = _signature(state)
        if after == before:
            break
        before = after
    return state, path
