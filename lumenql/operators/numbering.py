"""Numbers for the rows of a table in the order in which it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the column ``name``, from 1, in reading order.

    Rows are written once with their partition and place, so that counting them and
    numbering them see the same table. Only one count for each partition is exchanged.
    """
    held, _ = materialize(df.withColumn("__id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__id", 33)
    counts = held.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")
    counts = counts.select("__part", before.alias("__before"))
    out = held.join(counts, part == F.col("__part"))
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return out.withColumn(name, F.col("__before") + place + 1).drop("__id", "__part", "__before")
