"""Skew-safe LEAD/LAG must equal the plain window, also when keys are hot."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators.windows import lead_within_key, top1_by_group


def _data(spark):
    # key 'hot' holds most rows; timestamps repeat; some NULL values
    return spark.range(0, 3000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 13).cast("string"))).alias("k"),
        F.timestamp_seconds((F.col("id") * 7919) % 1000).cast("timestamp_ntz").alias("ts"),
        F.col("id"),
        F.when(F.col("id") % 17 == 0, F.lit(None)).otherwise(F.col("id") * 2).alias("v"))


def test_lead_matches_window(spark):
    df = _data(spark)
    got = lead_within_key(df, "k", "ts", "id", "nxt", partitions=9)
    want = df.withColumn("nxt", F.lead("ts").over(Window.partitionBy("k").orderBy("ts", "id")))
    assert got.select("id", "nxt").exceptAll(want.select("id", "nxt")).count() == 0
    assert got.count() == df.count()


def test_lag_of_value_matches_window(spark):
    df = _data(spark)
    got = lead_within_key(df, "k", "ts", "id", "prev", value_col="v", descending=True, partitions=9)
    want = df.withColumn("prev", F.lag("v").over(Window.partitionBy("k").orderBy("ts", "id")))
    assert got.select("id", "prev").exceptAll(want.select("id", "prev")).count() == 0


def test_top1_flag(spark):
    df = _data(spark)
    got = top1_by_group(df, ["k"], "id", F.struct("ts", "id"), "best")
    rn = F.row_number().over(Window.partitionBy("k").orderBy(F.col("ts").desc(), F.col("id").desc()))
    want = df.withColumn("best", rn == 1)
    assert got.select("id", "best").exceptAll(want.select("id", "best")).count() == 0


def test_ffill_matches_window(spark):
    from tessera.operators.windows import ffill_within_key
    df = _data(spark)
    got = ffill_within_key(df, "k", "ts", "id", "v", "filled", partitions=9)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumn("filled", F.last("v", ignorenulls=True).over(w))
    assert got.select("id", "filled").exceptAll(want.select("id", "filled")).count() == 0
    # sparse values: most slices of the hot key have none of their own
    sparse = df.withColumn("v", F.when(F.col("id") % 701 == 0, F.col("id")))
    got = ffill_within_key(sparse, "k", "ts", "id", "v", "filled", partitions=9)
    want = sparse.withColumn("filled", F.last("v", ignorenulls=True).over(w))
    assert got.select("id", "filled").exceptAll(want.select("id", "filled")).count() == 0


def test_bursts_shared_timestamps_and_null_keys_spread(spark):
    """999 of 1000 rows of a key on one day, rows with one timestamp, rows
    without a key: all are cut into bounded partitions and stay right."""
    from tessera.operators.windows import _ranged, ffill_within_key
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 1000, F.lit("burst")).when(F.col("id") < 2000, F.lit("same")).alias("k"),
        F.timestamp_seconds(F.when(F.col("id") == 0, 0).when(F.col("id") < 1000, 10**8 + F.col("id") % 86400)
                            .when(F.col("id") < 2000, 5).otherwise(F.col("id"))).cast("timestamp_ntz").alias("ts"),
        "id", F.when(F.col("id") % 50 == 3, F.col("id")).alias("v"))
    sizes = [r["count"] for r in _ranged(df, "k", [F.col("ts").asc(), F.col("id").asc()], 30).groupBy("_range").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 300
    w = Window.partitionBy("k").orderBy("ts", "id")
    got = lead_within_key(df, "k", "ts", "id", "nxt", value_col="v", partitions=30)
    assert got.select("id", "nxt").exceptAll(df.withColumn("nxt", F.lead("v").over(w)).select("id", "nxt")).count() == 0
    got = ffill_within_key(df, "k", "ts", "id", "v", "f", partitions=30)
    want = df.withColumn("f", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert got.select("id", "f").exceptAll(want.select("id", "f")).count() == 0
