"""Places of rows in an order, without one task per group.

The rows are sorted over the cluster by range, so that a group of any size lies
in consecutive partitions; a row's place is its place among the group's rows of
its partition plus the group's rows in the partitions before (one count per
group and partition, summed in order). Running sums go the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import shuffle_width, stored

PARTITION_SHIFT = 33  # monotonically_increasing_id: partition above, row below


def ranked(rows: DataFrame, group: str, order: list[Column], name: str, sums: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with ``place`` (0, 1, ... in ``order`` within ``group``) and
    ``total`` (rows of the group); each column of ``sums`` becomes its running
    sum, the row included. ``group`` has no nulls. Rows that are equal in
    ``order`` are placed in any order, and may be any share of the table."""
    width = shuffle_width(rows.sparkSession)
    salted = rows.withColumn("__seq", F.monotonically_increasing_id())
    keys = [F.col(group), *order, F.col("__seq")]
    dealt = salted.repartitionByRange(width, *keys).sortWithinPartitions(*keys).drop("__seq")
    table = stored(dealt.withColumn("__at", F.monotonically_increasing_id()), name)
    table = table.withColumn("__part", F.shiftright("__at", PARTITION_SHIFT))
    counts = table.groupBy(group, "__part").agg(
        F.min("__at").alias("__first"), F.count("*").alias("__n"), *[F.sum(c).alias(f"__sum_{c}") for c in sums]
    )
    parts = Window.partitionBy(group).orderBy("__part")
    before = parts.rowsBetween(Window.unboundedPreceding, -1)
    all_parts = Window.partitionBy(group)
    base = counts.select(
        group,
        "__part",
        "__first",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(all_parts).alias("total"),
        *[F.coalesce(F.sum(f"__sum_{c}").over(before), F.lit(0)).alias(f"__sum_{c}") for c in sums],
    )
    if sums:  # within one partition of one group
        run = Window.partitionBy(group, "__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
        table = table.withColumns({c: F.sum(c).over(run) for c in sums})
    out = table.join(base, [group, "__part"])
    place = F.col("__at") - F.col("__first") + F.col("__before")
    kept = [F.col(c) + F.col(f"__sum_{c}") if c in sums else F.col(c) for c in rows.columns]
    return out.select(*[c.alias(n) for c, n in zip(kept, rows.columns, strict=True)], place.alias("place"), "total")
