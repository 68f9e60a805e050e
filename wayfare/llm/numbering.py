"""Numbering rows in a global order without gathering any key's rows in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.llm.common import stored


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` with the place of each row in ``order`` from 0 as ``name``.

    Rows are cut into ranges, sorted and written once, so that their places within the ranges are
    fixed; the ranges' row counts, one row each, are then summed up.
    """
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "__place", F.monotonically_increasing_id()), f"ordered-{name}")
    at = F.shiftright("__place", 33)
    rows = rows.withColumn("__range", at).withColumn("__place", F.col("__place") - F.shiftleft(at, 33))
    counts = rows.groupBy("__range").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # A row per range: as many as the shuffle has partitions.
    bases = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return rows.join(F.broadcast(bases), "__range").select(
        *df.columns, (F.col("__before") + F.col("__place")).alias(name))
