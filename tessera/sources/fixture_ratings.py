"""Raw rating payloads derived from the driver's relational tables.

One raw rating per ``orders`` row, written in exactly the payload shape the
workbook extraction produces (sections, unexpected cells, ``_meta``), so
every model downstream runs on JSON the way it does in production while a
SQL oracle can compute the same results straight from the relational
columns. Mapping (fixed rules, see FIXTURES.md §3):

* id = upload_id = o_orderkey; parsed_at = o_orderdate + o_orderkey ms
* Rated entity / CorporateSector / Country of origin / Business risk
  profile = c_name / c_mktsegment / n_name / o_orderpriority
* data_quality_passed = o_orderstatus <> 'F'
* filename: id % 7 = 0 -> ``corporates-<custkey>.xlsm`` else
  ``corporates_<custkey>_<1 + id % 5>.xlsm``
* year header: distinct year(l_shipdate) ascending, suffix by
  (id + year) % 8; metrics ``quantity`` (sum) and ``price`` (max, 'n.a.'
  when id % 11 = 0) as DECIMAL(18,2) text
* Industry weight: id % 10 = 0 -> [0.6, 0.5]; 1 -> absent; else [0.15, 0.85]

Cell values are JSON strings holding their exact text: Spark's JSON
readers turn number tokens into doubles (``54.00`` -> ``54.0``), the
warehouse needs the text as written.

Scale: lineitem is pre-aggregated per (order, year) before any shuffle
(partial aggregation), so an order with a huge number of lines is combined
map-side; the per-order list is bounded by the number of distinct years.
Orders ⋈ customer is a plain equi join: AQE broadcasts customer when its
runtime size is under the threshold and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import template as tpl
from tessera.sources.tables import read_table

# Fixed values of the fixture mapping.
YEAR_SUFFIXES = ["", "", "A", "E", "P", "R", "F", "Q"]
METRIC_QUANTITY = "quantity"
METRIC_PRICE = "price"
NOT_AVAILABLE = "n.a."
FAILED_WEIGHTS = ["0.6", "0.5"]
GOOD_WEIGHTS = ["0.15", "0.85"]
NOISE_CELL = "Z100"
SCHEMA_TYPE = tpl.DEFAULT_TYPE
SCHEMA_VERSION = tpl.DEFAULT_VERSION


def fixture_schema_sha() -> str:
    return tpl.template_sha(tpl.get_template())


def fixture_parser_sha() -> str:
    import sys
    return tpl.code_sha(sys.modules[__name__])


def filename_col(id_col: Column, custkey: Column) -> Column:
    return F.when(
        id_col % 7 == 0, F.concat(F.lit("corporates-"), custkey.cast("string"), F.lit(".xlsm"))
    ).otherwise(F.concat(F.lit("corporates_"), custkey.cast("string"), F.lit("_"),
                         (F.lit(1) + id_col % 5).cast("string"), F.lit(".xlsm")))


def _str_list(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def order_year_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, years: ARRAY<STRUCT<yr, qty, price>> sorted by year)."""
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity",
                    "l_extendedprice", "l_shipdate")
    per_year = (li.groupBy("l_orderkey", F.year("l_shipdate").alias("yr"))
                .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("qty"),
                     F.max(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price")))
    return (per_year.groupBy("l_orderkey")
            .agg(F.array_sort(F.collect_list(F.struct("yr", "qty", "price"))).alias("years")))


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_corporate_credit_ratings: (id, upload_id, parsed_payload, parsed_at)."""
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                        "o_orderdate", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    years = order_year_metrics(spark, sf_dir)

    base = (orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(years, F.col("o_orderkey") == F.col("l_orderkey"), "left"))

    rid = F.col("o_orderkey")
    ys = F.coalesce(F.col("years"), F.array().cast("array<struct<yr:int,qty:decimal(28,2),price:decimal(18,2)>>"))
    suffixes = F.array(*[F.lit(s) for s in YEAR_SUFFIXES])
    header = F.transform(ys, lambda y: F.concat(
        y["yr"].cast("string"), F.element_at(suffixes, ((rid + y["yr"]) % 8 + 1).cast("int"))))
    qty = F.transform(ys, lambda y: y["qty"].cast("string"))
    price = F.transform(ys, lambda y: F.when(rid % 11 == 0, F.lit(NOT_AVAILABLE))
                        .otherwise(y["price"].cast("string")))
    weights = (F.when(rid % 10 == 0, _str_list(FAILED_WEIGHTS))
               .when(rid % 10 == 1, F.lit(None).cast("array<string>"))
               .otherwise(_str_list(GOOD_WEIGHTS)))
    metadata = F.struct(
        F.col("c_name").alias("Rated entity"),
        F.col("c_mktsegment").alias("CorporateSector"),
        F.col("n_name").alias("Country of origin"),
        F.col("o_orderpriority").alias("Business risk profile"),
        weights.alias("Industry weight"),  # NULL -> key absent in the JSON
    )
    credit_metrics = F.create_map(F.lit(tpl.YEAR_HEADER), header, F.lit(METRIC_QUANTITY), qty,
                                  F.lit(METRIC_PRICE), price)
    passed = F.col("o_orderstatus") != "F"
    unexpected = F.when(passed, F.create_map().cast("map<string,string>")).otherwise(
        F.create_map(F.lit(NOISE_CELL), F.col("o_orderstatus")))
    errors = F.when(passed, F.array().cast("array<string>")).otherwise(F.array(F.concat(
        F.lit(f"Unexpected data point found in cell {NOISE_CELL}: '"), F.col("o_orderstatus"), F.lit("'"))))
    meta = F.struct(
        filename_col(rid, F.col("o_custkey")).alias("filename"),
        F.lit(SCHEMA_TYPE).alias("schema_type"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(fixture_schema_sha()).alias("schema_sha"),
        F.lit(fixture_parser_sha()).alias("parser_sha"),
        passed.alias("data_quality_passed"),
        errors.alias("data_quality_errors"),
    )
    payload = F.to_json(F.struct(metadata.alias("evaluations_metadata"),
                                 credit_metrics.alias("credit_metrics"),
                                 unexpected.alias("unexpected_cells"),
                                 meta.alias("_meta")))
    return base.select(
        rid.alias("id"),
        rid.alias("upload_id"),
        payload.alias("parsed_payload"),
        F.expr("timestampadd(MILLISECOND, o_orderkey, o_orderdate)").cast("timestamp_ntz").alias("parsed_at"),
    )


def source_files_audit(spark: SparkSession, sf_dir: str, archive_root: str = "s3://archive") -> DataFrame:
    """File audit rows matching ``raw_ratings`` (one file per upload).

    The fixture has no file bytes; the content hash is taken over
    ``filename:id`` so both engines can reproduce it.
    """
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    fname = filename_col(F.col("o_orderkey"), F.col("o_custkey"))
    h = F.sha2(F.concat(fname, F.lit(":"), F.col("o_orderkey").cast("string")), 256)
    return orders.select(
        F.col("o_orderkey").alias("id"),
        fname.alias("filename"),
        h.alias("file_hash"),
        F.concat(F.lit(archive_root + "/"), h, F.lit("_"), fname).alias("s3_path"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ingested_at"),
    )
