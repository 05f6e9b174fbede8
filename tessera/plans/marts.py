"""Warehouse models as DataFrame functions: staging -> intermediate -> marts.

Every function takes DataFrames and returns a lazily planned DataFrame.
Shuffles per model: staging models are narrow (parse + generators, no
shuffle); ``int_max_years`` aggregates per rating (partial aggregation);
the dimension uses the skew-safe window operators; the fact joins metrics
to ratings on the unique rating id; details pre-aggregate the fact per
rating before the join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import template as tpl
from tessera.functions.columns import (ACTUAL, leading_int, round4, safe_numeric,
                                       sum_as_numeric, version_from_filename, year_type)
from tessera.operators.windows import lead_within_key, top1_by_group
from tessera.session import checkpoint_dir
from tessera.plans.payload import (LIST_FIELDS, METADATA_FIELDS, WEIGHT_LABEL, list_field,
                                   meta_field, metric_lists, parse_payload, year_header)

STG_RATINGS_COLUMNS = (["id", "upload_id", "updated_at"]
                       + [c for _, c in METADATA_FIELDS] + [c for _, c in LIST_FIELDS]
                       + ["filename", "parser_sha", "schema_sha", "parsed_payload"])

STG_METRICS_COLUMNS = ["rating_id", "upload_id", "updated_at", "metric_name", "year_idx", "metric_year", "metric_year_str",
                       "metric_year_type", "metric_value_numeric", "metric_value_text"]

AUDIT_COLUMNS = ["upload_id", "updated_at", "filename", "parser_sha", "schema_sha", "data_quality_passed",
                 "business_rules_passed", "payload_well_formed", "parsed_payload"]

DIM_COLUMNS = (["id", "upload_id"] + [c for _, c in METADATA_FIELDS] + [c for _, c in LIST_FIELDS]
               + ["filename", "parser_sha", "schema_sha", "sys_valid_from", "sys_valid_to",
                  "is_system_current", "is_latest_version_for_business_year",
                  "max_actual_year", "version_id"])

FCT_COLUMNS = ["rating_id", "upload_id", "company_name", "corporate_sector", "metric_name",
               "metric_year", "metric_year_str", "metric_year_type", "metric_value_numeric",
               "metric_value_text", "updated_at"]

DETAIL_COLUMNS = ["id", "version_id", "company_name", "corporate_sector", "country_of_origin",
                  "reporting_currency", "business_risk_profile", "financial_risk_profile",
                  "end_of_business_year", "accounting_principles", "sys_valid_from",
                  "sys_valid_to", "is_system_current", "is_latest_version_for_business_year",
                  "max_actual_year"]

METRIC_STRUCT = "struct<name:string,value:decimal(25,4),text_value:string,year:int,year_type:string>"


def stg_ratings(raw: DataFrame) -> DataFrame:
    """T-1: typed, passed-only ratings (one row per raw rating). Payloads
    whose configured lists are not JSON arrays are quarantined: they stay
    out of staging and show ``payload_well_formed = false`` in the audit."""
    p = parse_payload(raw).filter(F.col("data_quality_passed") & F.col("_ok"))
    return p.select(*_rating_columns(), F.col("parsed_payload"))


def _rating_columns() -> list:
    em = F.col("_em")
    return [F.col("id"), F.col("upload_id"), F.col("parsed_at").alias("updated_at"),
            *[em[label].alias(col) for label, col in METADATA_FIELDS],
            *[list_field(label).alias(col) for label, col in LIST_FIELDS],
            meta_field("filename").alias("filename"),
            meta_field("parser_sha").alias("parser_sha"),
            meta_field("schema_sha").alias("schema_sha")]


def staged(raw: DataFrame) -> DataFrame:
    """What both staging models say of a rating, in one narrow row: its
    fields (without the payload text), the year header ``_years`` and the
    metrics ``_metrics`` (name and values)."""
    p = parse_payload(raw).filter(F.col("data_quality_passed") & F.col("_ok"))
    metrics = F.transform(metric_lists(), lambda m: F.struct(
        m["key"].alias("key"), F.from_json(m["value"], "array<string>").alias("values")))
    return p.select(*_rating_columns(), year_header().alias("_years"), metrics.alias("_metrics"))


def staged_batch(raw: DataFrame) -> DataFrame:
    """What all three staging models say of an upload, in one row: the columns
    of ``stg_ratings``, both quality gates and, of ratings that enter staging,
    ``_years`` and ``_metrics`` (see ``staged``)."""
    p = parse_payload(raw)
    passed = F.col("data_quality_passed") & F.col("_ok")
    metrics = F.transform(metric_lists(), lambda m: F.struct(
        m["key"].alias("key"), F.from_json(m["value"], "array<string>").alias("values")))
    return p.select(*_rating_columns(), "parsed_payload", "data_quality_passed", "_ok", _business_rules().alias("business_rules_passed"),
                    F.when(passed, year_header()).alias("_years"), F.when(passed, metrics).alias("_metrics"))


def batch_ratings(batch: DataFrame) -> DataFrame:
    """``stg_ratings`` of ``staged_batch`` rows."""
    return batch.filter(F.col("data_quality_passed") & F.col("_ok")).select(*STG_RATINGS_COLUMNS)


def batch_metrics(batch: DataFrame) -> DataFrame:
    """``stg_metrics`` of ``staged_batch`` rows."""
    return staged_metrics(batch.filter(F.col("data_quality_passed") & F.col("_ok"))).select(*STG_METRICS_COLUMNS)


def batch_audits(batch: DataFrame) -> DataFrame:
    """``upload_audits`` of ``staged_batch`` rows."""
    return batch.withColumn("payload_well_formed", F.col("_ok")).select(*AUDIT_COLUMNS)


def staged_max_years(rows: DataFrame) -> DataFrame:
    """``int_max_years`` of ``staged`` rows, without a row per metric value:
    the years count up to the longest metric."""
    length = F.array_max(F.transform("_metrics", lambda m: F.coalesce(F.size(m["values"]), F.lit(0))))
    actual = F.filter(F.slice("_years", 1, F.greatest(F.coalesce(length, F.lit(0)), F.lit(0))), lambda y: year_type(y) == ACTUAL)
    return (rows.select("upload_id", F.col("id").alias("rating_id"), F.array_max(F.transform(actual, leading_int)).alias("_y"))
            .filter("_y IS NOT NULL").groupBy("upload_id", "rating_id").agg(F.max("_y").alias("max_actual_year")))


def stg_metrics(raw: DataFrame) -> DataFrame:
    """T-2: one row per (rating, metric, year position) with the year header
    text at the same position; positions past the header are dropped.
    Quarantined payloads (see ``stg_ratings``) are left out here too."""
    p = (parse_payload(raw).filter(F.col("data_quality_passed") & F.col("_ok"))
         .select(F.col("id").alias("rating_id"), "upload_id",
                 F.col("parsed_at").alias("updated_at"),
                 year_header().alias("_years"),
                 F.explode(metric_lists()).alias("_m")))
    return _metric_rows(p.select("rating_id", "upload_id", "updated_at", "_years", F.col("_m.key").alias("key"),
                                 F.from_json(F.col("_m.value"), "array<string>").alias("values")))


def staged_metrics(rows: DataFrame) -> DataFrame:
    """``stg_metrics`` of ``staged`` rows."""
    return _metric_rows(rows.select(F.col("id").alias("rating_id"), "upload_id", "updated_at", "_years", F.explode("_metrics").alias("_m"))
                        .select("rating_id", "upload_id", "updated_at", "_years", "_m.*"))


def staged_facts(rows: DataFrame) -> DataFrame:
    """``fct_metrics`` of ``staged`` rows: ratings meet by id before their
    metrics become rows, so one row per rating is shuffled."""
    named = rows.select(F.col("id").alias("rating_id"), "company_name", "corporate_sector")
    lists = rows.select(F.col("id").alias("rating_id"), "upload_id", "updated_at", "_years", "_metrics").join(named, on="rating_id")
    own = ["rating_id", "upload_id", "updated_at", "_years", "company_name", "corporate_sector"]
    m = _metric_rows(lists.select(*own, F.explode("_metrics").alias("_m")).select(*own, "_m.*"), "company_name", "corporate_sector")
    return m.withColumn("metric_value_numeric", round4("metric_value_numeric")).select(*FCT_COLUMNS)


def _metric_rows(lists: DataFrame, *others: str) -> DataFrame:
    m = lists.select("rating_id", "upload_id", "updated_at", "_years", *others, F.col("key").alias("metric_name"),
                     F.posexplode("values").alias("_pos", "metric_val"))
    m = m.filter(F.col("_pos") < F.size("_years"))
    year_str = F.get(F.col("_years"), F.col("_pos"))
    return m.select(
        "rating_id", "upload_id", "updated_at", "metric_name", *others,
        (F.col("_pos") + 1).cast("bigint").alias("year_idx"),
        leading_int(year_str).alias("metric_year"),
        year_str.alias("metric_year_str"),
        year_type(year_str).alias("metric_year_type"),
        safe_numeric(F.col("metric_val")).alias("metric_value_numeric"),
        F.col("metric_val").alias("metric_value_text"),
    )


def int_max_years(metrics: DataFrame) -> DataFrame:
    """T-3: latest 'Actual' year per rating."""
    return (metrics.filter(F.col("metric_year_type") == ACTUAL)
            .groupBy("upload_id", "rating_id")
            .agg(F.max("metric_year").alias("max_actual_year")))


def dim_ratings(ratings: DataFrame, max_years: DataFrame) -> DataFrame:
    """T-4: bitemporal dimension.

    System time: [updated_at, next updated_at of the company) (ties by id).
    Business time: ``max_actual_year``; per (company, business year) the
    highest file version wins (no version = 1), then the newest upload, then
    the highest id.
    """
    j = (ratings.drop("parsed_payload", "_years", "_metrics")
         .join(max_years.withColumnRenamed("rating_id", "id"), on=["upload_id", "id"], how="left")
         .withColumn("version_id", version_from_filename("filename"))
         .withColumn("sys_valid_from", F.col("updated_at")))
    j = lead_within_key(j, "company_name", "updated_at", "id", "sys_valid_to")
    rank = F.struct(F.coalesce(F.col("version_id"), F.lit(1)), F.col("updated_at"), F.col("id"))
    j = top1_by_group(j, ["company_name", "max_actual_year"], "id", rank,
                      "is_latest_version_for_business_year")
    j = j.withColumn("is_system_current", F.col("sys_valid_to").isNull())
    return j.select(*DIM_COLUMNS)


def fct_metrics(metrics: DataFrame, ratings: DataFrame) -> DataFrame:
    """T-5: metric facts with company and sector, values rounded to 4 places."""
    r = ratings.select(F.col("id").alias("rating_id"), "company_name", "corporate_sector")
    return (metrics.join(r, on="rating_id", how="inner")
            .withColumn("metric_value_numeric", round4("metric_value_numeric"))
            .select(*FCT_COLUMNS))


def company_details(dim: DataFrame, fct: DataFrame) -> DataFrame:
    """T-6: dimension row + nested metrics (empty array when none), metrics
    sorted by (year, name, ...) for a deterministic order."""
    nested = (fct.filter(F.col("metric_name").isNotNull())
              .groupBy("rating_id")
              .agg(F.sort_array(F.collect_list(F.struct(
                  F.col("metric_year").alias("year"), F.col("metric_name").alias("name"),
                  F.col("metric_value_numeric").alias("value"),
                  F.col("metric_value_text").alias("text_value"),
                  F.col("metric_year_type").alias("year_type")))).alias("_ms"))
              .select(F.col("rating_id").alias("id"),
                      F.transform("_ms", lambda m: F.struct(
                          m["name"].alias("name"), m["value"].alias("value"),
                          m["text_value"].alias("text_value"), m["year"].alias("year"),
                          m["year_type"].alias("year_type"))).alias("metrics")))
    return (dim.select(*DETAIL_COLUMNS)
            .join(nested, on="id", how="left")
            .withColumn("metrics", F.coalesce(F.col("metrics"), F.array().cast(f"array<{METRIC_STRUCT}>"))))


class DetailLookup:
    """The company detail view for questions about some of its rows: rows are
    chosen on the narrow dimension, their ids filter the fact, and only what
    is left of it is nested. ``facts_of`` gives the facts of a table of
    rating ids; ``fct`` filtered by them unless a shorter way is known."""

    def __init__(self, dim: DataFrame, fct: DataFrame | None, facts_of=None):
        self.rows = dim.select(*DETAIL_COLUMNS)
        self.facts_of = facts_of or (lambda ids: fct.join(ids, on="rating_id", how="left_semi"))

    def nest(self, rows: DataFrame) -> DataFrame:
        """``rows`` (a choice of ``self.rows``) with their metrics."""
        return company_details(rows, self.facts_of(rows.select(F.col("id").alias("rating_id"))))


def _business_rules():
    total = sum_as_numeric(list_field(WEIGHT_LABEL))
    return F.coalesce(F.abs(total - F.lit(1).cast("decimal(38,18)")) <= F.lit(0.00001).cast("decimal(38,18)"),
                      F.lit(False))


def upload_audits(raw: DataFrame) -> DataFrame:
    """T-7: every upload (passed or not) with both quality gates."""
    p = parse_payload(raw)
    return p.select(
        "upload_id", F.col("parsed_at").alias("updated_at"),
        meta_field("filename").alias("filename"),
        meta_field("parser_sha").alias("parser_sha"),
        meta_field("schema_sha").alias("schema_sha"),
        "data_quality_passed",
        _business_rules().alias("business_rules_passed"),
        F.col("_ok").alias("payload_well_formed"),
        "parsed_payload",
    )


class Warehouse:
    """The model graph over one raw table, built lazily; each attribute is a
    DataFrame. Models that need both staging models read them from a narrow
    table of parsed payloads, written once (``staged``). Use ``publish`` (plans.pipeline) to materialise in order."""

    def __init__(self, raw: DataFrame):
        self.raw = raw
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name, fn):
        if name not in self._cache:
            self._cache[name] = fn()
        return self._cache[name]

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        path = f"{checkpoint_dir(spark).rstrip('/')}/tessera/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    @property
    def staged(self):
        return self._get("staged", lambda: self._written("parsed", staged(self.raw)))

    @property
    def ratings(self):
        """The staging ratings without their payload text."""
        return self.staged.drop("_years", "_metrics")

    @property
    def stg_ratings(self):
        return self._get("stg_ratings", lambda: stg_ratings(self.raw))

    @property
    def stg_metrics(self):
        if "staged" in self._cache:
            return staged_metrics(self.staged)
        return self._get("stg_metrics", lambda: stg_metrics(self.raw))

    @property
    def int_max_years(self):
        return self._get("int_max_years", lambda: int_max_years(self.stg_metrics))

    @property
    def dim(self):
        return self._get("dim", lambda: dim_ratings(self.ratings, staged_max_years(self.staged)))

    @property
    def fct(self):
        return self._get("fct", lambda: staged_facts(self.staged))

    @property
    def details(self):
        return self._get("details", lambda: company_details(self.dim, self.fct))

    @property
    def lookup(self):
        """The dimension is written once, as rows are chosen in several
        passes; the ids chosen filter ratings before their metrics become
        rows."""
        def facts_of(ids: DataFrame) -> DataFrame:
            rows = self.staged.join(ids.select(F.col("rating_id").alias("id")), on="id", how="left_semi")
            return staged_facts(rows)
        return self._get("lookup", lambda: DetailLookup(self._written("dim", self.dim.select(*DETAIL_COLUMNS)), None, facts_of))

    @property
    def audits(self):
        return self._get("audits", lambda: upload_audits(self.raw))
