"""Window operators that stay balanced when one key holds a large share of
the rows.

``lead_within_key`` computes ``LEAD(value) OVER (PARTITION BY key ORDER BY
order_cols)`` and ``ffill_within_key`` a forward fill, on one path for every
key, hot or not, NULL included:

1. rows are range-partitioned by (key, order columns) and written with
   their partition's number, so a key with many rows, a burst on one day or
   one shared timestamp simply spans several partitions;
2. the window runs over the rows of a key in one partition;
3. where a key spans partitions, the borders are patched from a table with
   one row per such key and partition, by a join on the written number.

``top1_by_group`` marks the best row per group with an aggregate
(``max_by``, partial-aggregated before the shuffle) and a join back on the
row id, which is unique and therefore evenly hashed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.session import checkpoint_dir


def _ranged(df: DataFrame, key: str, order: list[Column], partitions: int | None) -> DataFrame:
    """``df`` range-partitioned by (key, order), with the partition's number
    ``_range``; written to the shared folder, so every use sees the same ranges."""
    spark = df.sparkSession
    by = [F.col(key).asc(), *order]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    path = f"{checkpoint_dir(spark).rstrip('/')}/tessera/windows-{uuid.uuid4().hex}"
    ranged = ranged.withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """Keys whose rows span several partitions."""
    return (rows.groupBy(key).agg(F.min("_range").alias("_a"), F.max("_range").alias("_b")).filter("_a < _b")
            .select(F.col(key).alias("_border_key")))


def _borders(rows: DataFrame, key: str, value: Column) -> DataFrame:
    """(_border_key, _border_p, _border_v): an aggregate per spread key and partition."""
    spread = _spread(rows, key)
    return (rows.join(spread, rows[key].eqNullSafe(spread["_border_key"]), "left_semi")
            .groupBy(F.col(key).alias("_border_key"), F.col("_range").alias("_border_p")).agg(value.alias("_border_v")))


def _patched(local: DataFrame, borders: DataFrame, key: str) -> DataFrame:
    return local.join(borders, local[key].eqNullSafe(borders["_border_key"]) & (local["_range"] == borders["_border_p"]), "left")


def lead_within_key(df: DataFrame, key: str, ts_col: str, tie_col: str, out_col: str,
                    value_col: str | None = None, descending: bool = False,
                    partitions: int | None = None) -> DataFrame:
    """``out_col`` = ``value_col`` (default ``ts_col``) of the next row within
    ``key`` ordered by (ts_col, tie_col); ``descending=True`` orders newest
    first, which makes this a LAG.

    Rows whose ``key`` is NULL form one group, as in SQL windows.
    """
    value_col = value_col or ts_col
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in (ts_col, tie_col)]
    rows = _ranged(df, key, order, partitions)
    w = Window.partitionBy("_range", key).orderBy(*order)
    local = (rows.withColumn("_range_next", F.lead(value_col).over(w))
             .withColumn("_range_has_next", F.lead(F.lit(True)).over(w).isNotNull()))
    pos = F.struct(F.col(ts_col), F.col(tie_col))
    # a NULL value stays a NULL, so it travels inside a struct
    packed = F.struct(F.col(value_col).alias("v"))
    first = _borders(rows, key, F.max_by(packed, pos) if descending else F.min_by(packed, pos))
    nxt = first.withColumn("_range_n", F.lead("_border_v").over(Window.partitionBy("_border_key").orderBy("_border_p"))).drop("_border_v")
    return (_patched(local, nxt, key)
            .withColumn(out_col, F.when(F.col("_range_has_next"), F.col("_range_next")).otherwise(F.col("_range_n.v")))
            .select(*[c for c in df.columns if c != out_col], out_col))


def ffill_within_key(df: DataFrame, key: str, ts_col: str, tie_col: str, value_col: str,
                     out_col: str, partitions: int | None = None) -> DataFrame:
    """``out_col`` = the last non-NULL ``value_col`` at or before each row
    within ``key`` ordered by (ts_col, tie_col) — a forward fill, the core
    of an as-of join. A partition without a value of a key takes the last
    one of the key's earlier partitions."""
    order = [F.col(ts_col).asc(), F.col(tie_col).asc()]
    rows = _ranged(df, key, order, partitions)
    w = Window.partitionBy("_range", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_range_local", F.last(value_col, ignorenulls=True).over(w))
    last = _borders(rows, key, F.max_by(F.col(value_col), F.when(F.col(value_col).isNotNull(), F.struct(ts_col, tie_col))))
    carry = last.withColumn("_range_in", F.last("_border_v", ignorenulls=True).over(
        Window.partitionBy("_border_key").orderBy("_border_p").rowsBetween(Window.unboundedPreceding, -1))).drop("_border_v")
    return (_patched(local, carry, key).withColumn(out_col, F.coalesce(F.col("_range_local"), F.col("_range_in")))
            .select(*[c for c in df.columns if c != out_col], out_col))


def top1_by_group(df: DataFrame, group_cols: list[str], id_col: str, rank: Column,
                  out_col: str) -> DataFrame:
    """``out_col`` = (row is the one with the greatest ``rank`` in its group).

    ``rank`` must be a struct ending with a unique column so the winner is
    deterministic. NULL group keys form one group, as in SQL windows.
    """
    winners = (df.groupBy(*group_cols)
               .agg(F.max_by(F.col(id_col), rank).alias("_winner"))
               .select(F.col("_winner").alias(id_col), F.lit(True).alias(out_col)))
    return (df.join(winners, on=id_col, how="left")
            .withColumn(out_col, F.coalesce(F.col(out_col), F.lit(False))))


def top1_rows(df: DataFrame, group_cols: list[str], rank: Column) -> DataFrame:
    """The greatest row per group by ``rank`` (ties broken inside ``rank``),
    as an aggregate: no group is ever held in one task."""
    cols = df.columns
    best = (df.groupBy(*group_cols)
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), rank).alias("_best")))
    return best.select("_best.*")
