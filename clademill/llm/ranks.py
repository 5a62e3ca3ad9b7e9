"""Row ranks without one task holding a whole group.

A row number over a group that holds a third of all rows would sort that third in one task. Here rows are first
dealt to about sqrt(n) numbered buckets, bucket sizes are summed up per group, and rows are numbered only inside
a bucket. The bucket table has at most sqrt(n) rows a group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_count(n_rows: int) -> int:
    """About sqrt(n) buckets of about sqrt(n) rows."""
    return max(1, math.isqrt(max(0, n_rows)))


def ranked(df: DataFrame, group: list[str], bucket: str, order: list[Column], rank: str, weight: str | None = None, total: str | None = None) -> DataFrame:
    """Add rank: rows of the same group before this one, by (bucket, order); with weight, the sum of their weights.

    group columns must not be null; bucket is a column of integers whose order is the first sort key. With total,
    that column gets the group's number of rows (or sum of weights).
    """
    measure = F.sum(weight) if weight else F.count(F.lit(1))
    sizes = df.groupBy(*group, bucket).agg(measure.alias("__size"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    cols = [*group, bucket, F.coalesce(F.sum("__size").over(before), F.lit(0)).cast("long").alias("__before")]
    if total:
        cols.append(F.sum("__size").over(Window.partitionBy(*group)).cast("long").alias(total))
    starts = sizes.select(*cols)
    inside = Window.partitionBy(*group, bucket).orderBy(*order)
    if weight:
        own = F.coalesce(F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    else:
        own = F.row_number().over(inside) - 1
    return df.join(starts, [*group, bucket]).withColumn(rank, (F.col("__before") + own).cast("long")).drop("__before")
