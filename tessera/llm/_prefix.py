"""Running sums that never put a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COARSE = 1024  # fine buckets per coarse one


def running_sum(df: DataFrame, group: list[str], fine: str, order: list[str], value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all earlier rows of its group, in
    the order (fine, *order). ``fine`` is a long bucket number that splits a
    group into bounded runs; only sums per bucket cross buckets: windows run
    over the rows of one bucket, the buckets of one coarse bucket and the
    coarse buckets of one group."""
    before = (Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    fine_sums = df.groupBy(*group, fine).agg(F.sum(value).cast("long").alias("_s"))
    fine_sums = fine_sums.withColumn("_coarse", F.floor(F.col(fine) / COARSE).cast("long"))
    coarse = fine_sums.groupBy(*group, "_coarse").agg(F.sum("_s").alias("_c"))
    w = Window.partitionBy(*group).orderBy("_coarse").rowsBetween(*before)
    coarse = coarse.select(*group, "_coarse", F.coalesce(F.sum("_c").over(w), zero).alias("_c0"))
    w = Window.partitionBy(*group, "_coarse").orderBy(fine).rowsBetween(*before)
    fine_sums = fine_sums.withColumn("_f0", F.coalesce(F.sum("_s").over(w), zero))
    offsets = (fine_sums.join(coarse, [*group, "_coarse"])
               .select(*group, fine, (F.col("_c0") + F.col("_f0")).alias("_o")))
    w = Window.partitionBy(*group, fine).orderBy(*order).rowsBetween(*before)
    return (df.join(offsets, [*group, fine])
            .withColumn(name, F.col("_o") + F.coalesce(F.sum(value).over(w).cast("long"), zero)).drop("_o"))
