"""Dense ordered ids across partitions; shuffle-partition sizing."""

from pyspark.sql import functions as F

from tessera.operators import ids
from tessera.operators.ids import dense_index
from tessera.session import size_shuffle_partitions
from conftest import SF_SMALL


def test_dense_index_is_dense_and_ordered_across_partitions(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        F.concat(F.lit("f"), F.lpad((F.lit(4999) - F.col("id")).cast("string"), 5, "0")).alias("name"))
    out = dense_index(df, [F.col("name")], "id", start=100).collect()
    ids = sorted((r.name, r.id) for r in out)
    assert [i for _, i in ids] == list(range(101, 5101))


def test_dense_index_passes_nothing_through_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    df = spark.range(0, 3000, numPartitions=40).select((F.col("id") * 7919 % 3000).alias("k"), (F.col("id") % 3).alias("v"))
    df = df.unionByName(df.filter("k < 0"))
    old, blocks = spark.conf.get("spark.sql.shuffle.partitions"), ids.BLOCK
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        ids.BLOCK = 4  # several blocks of partitions
        with monkeypatch.context() as m:
            m.setattr(DataFrame, "collect", None)
            numbered = dense_index(df, [F.col("k")], "id", start=5)
        assert sorted((r.k, r.id) for r in numbered.collect()) == [(k, k + 6) for k in range(3000)]
        assert dense_index(df.filter("k < 0"), [F.col("k")], "id").count() == 0
    finally:
        ids.BLOCK = blocks
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_size_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = size_shuffle_partitions(spark, [f"{SF_SMALL}/lineitem.parquet"], bytes_per_partition=1024, minimum=1)
        assert n > 1 and spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
