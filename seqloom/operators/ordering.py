"""Consecutive numbers in an order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.sources.scratch import Table


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` with a column ``name`` that counts from 0 in ``order``, which should leave no ties.

    Rows are dealt by ranges of the order, sorted range by range and written; the driver sees one
    count a range.
    """
    ranges = Table(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())).df
    part, nth = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before, starts = 0, []
    for r in ranges.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts.append((r["part"], before))
        before += r["count"]
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _before long")
    return ranges.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(*df.columns, (F.col("_before") + nth).alias(name))
