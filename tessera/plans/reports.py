"""Reports the reference's requirements ask for on top of the models:
quality report, range rules, run metrics, success rate, one big table,
change-only history, classification lists and the industry-risk fact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import template as tpl
from tessera.operators.windows import lead_within_key
from tessera.plans.payload import META_SECTION, meta_field, parse_payload

# Accepted industry risk scores (rating scale, best to worst).
RATING_SCALE = ["AAA", "AA+", "AA", "AA-", "A+", "A", "A-", "BBB+", "BBB", "BBB-",
                "BB+", "BB", "BB-", "B+", "B", "B-", "CCC+", "CCC", "CCC-", "CC", "C", "D"]

CHANGE_ATTRIBUTES = ["corporate_sector", "country_of_origin", "reporting_currency",
                     "business_risk_profile", "financial_risk_profile", "end_of_business_year",
                     "accounting_principles"]


def quality_report(raw: DataFrame, schema_type: str = tpl.DEFAULT_TYPE,
                   version: str = tpl.DEFAULT_VERSION) -> DataFrame:
    """Per template field, over all uploads: how many carry a non-empty
    value and the completeness rate. The per-field counts are conditional
    sums in one aggregate (one pass, map-side combined)."""
    t = tpl.get_template(schema_type, version)
    labels = t["sections"][META_SECTION]["key_value"]
    p = parse_payload(raw)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, label in enumerate(labels):
        v = F.col("_em")[label]
        aggs.append(F.sum(F.when(v.isNotNull() & (v != ""), 1).otherwise(0)).alias(f"_p{i}"))
    wide = p.agg(*aggs)
    stack = ", ".join(f"'{lab.replace(chr(39), chr(39) * 2)}', _p{i}" for i, lab in enumerate(labels))
    long = wide.selectExpr("_n", f"stack({len(labels)}, {stack}) as (field, n_present)")
    return long.select(
        F.lit(META_SECTION).alias("section"), "field", F.col("_n").alias("n_uploads"),
        F.col("n_present").cast("bigint").alias("n_present"),
        (F.col("_n") - F.col("n_present")).cast("bigint").alias("n_missing"),
        F.round(F.col("n_present") / F.col("_n"), 6).alias("completeness"))


def error_kinds(raw: DataFrame) -> DataFrame:
    """R1 (errors): validation messages per kind over all uploads."""
    p = parse_payload(raw)
    return error_kinds_of(p.select(F.from_json(meta_field("data_quality_errors"), "array<string>").alias("e")), "e")


def error_kinds_of(df: DataFrame, errors_col: str) -> DataFrame:
    """Messages per kind from an ARRAY<STRING> column of error lists."""
    errs = df.select(F.explode(errors_col).alias("e"))
    kind = (F.when(F.col("e").startswith("Unexpected data point"), "unexpected_cell")
            .when(F.col("e").startswith("Missing required field"), "missing_field")
            .when(F.col("e").startswith("Invalid spreadsheet"), "invalid_sheet")
            .otherwise("other"))
    return errs.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_errors"))


def range_rules(stg_ratings: DataFrame) -> DataFrame:
    """R2: weights outside [0, 1] (or not numeric) and scores outside the
    rating scale, one row per offending list element. One scan for both."""
    def items(col: str, rule: str) -> Column:
        return F.transform(F.coalesce(F.col(col), F.array().cast("array<string>")), lambda v, i: F.struct(
            F.lit(rule).alias("rule"), (i + 1).cast("int").alias("position"), v.alias("value")))
    weight, score = "industry_weight_in_0_1", "industry_risk_score_in_scale"
    rows = stg_ratings.select("id", F.explode(F.concat(items("industry_weight", weight), items("industry_risk_score", score))).alias("_i")).select("id", "_i.*")
    num = F.col("value").try_cast("decimal(38,18)")
    bad_w = (F.col("rule") == weight) & (num.isNull() | (num < 0) | (num > 1))
    bad_s = (F.col("rule") == score) & (F.col("value").isNull() | ~F.col("value").isin(RATING_SCALE))
    return rows.filter(bad_w | bad_s)


def run_metrics(raw: DataFrame, stg_metrics: DataFrame) -> DataFrame:
    """One row: uploads, passed, failed, validation errors, metric rows."""
    p = parse_payload(raw)
    a = p.agg(F.count(F.lit(1)).alias("uploads"),
              F.sum(F.when(F.col("data_quality_passed"), 1).otherwise(0)).cast("bigint").alias("passed"),
              F.sum(F.when(F.col("data_quality_passed"), 0).otherwise(1)).cast("bigint").alias("failed"),
              F.sum(F.size(F.coalesce(F.from_json(meta_field("data_quality_errors"), "array<string>"),
                                      F.array().cast("array<string>")))).cast("bigint").alias("errors"))
    metric_rows = stg_metrics.count()  # scalar, added as a literal
    return a.withColumn("metric_rows", F.lit(metric_rows).cast("bigint"))


def upload_success_rate(audits: DataFrame) -> DataFrame:
    """Uploads per day with the share that passed both gates."""
    ok = F.col("data_quality_passed") & F.col("business_rules_passed")
    return (audits.groupBy(F.to_date("updated_at").cast("string").alias("date"))
            .agg(F.count(F.lit(1)).alias("uploads"),
                 F.sum(F.when(F.col("data_quality_passed"), 1).otherwise(0)).cast("bigint").alias("dq_passed"),
                 F.sum(F.when(ok, 1).otherwise(0)).cast("bigint").alias("all_passed"))
            .withColumn("success_rate", F.round(F.col("all_passed") / F.col("uploads"), 6)))


def one_big_table(dim: DataFrame, fct: DataFrame) -> DataFrame:
    """Each metric fact with the dimension attributes of its version."""
    d = dim.select(F.col("id").alias("rating_id"), "version_id", "country_of_origin",
                   "reporting_currency", "business_risk_profile", "financial_risk_profile",
                   "sys_valid_from", "sys_valid_to", "is_system_current",
                   "is_latest_version_for_business_year", "max_actual_year")
    return fct.join(d, on="rating_id", how="inner")


def write_one_big_table(dim: DataFrame, fct: DataFrame, path: str) -> None:
    """R6 written as Parquet partitioned by ``metric_year``. Ranges of (year,
    rating) are even in rows, so a year that holds most of them is written by
    many tasks and a small one leaves one file, not one per task."""
    (one_big_table(dim, fct).repartitionByRange("metric_year", "rating_id").sortWithinPartitions("metric_year", "company_name")
     .write.mode("overwrite").partitionBy("metric_year").parquet(path))


def _attr_hash(cols: list[str]):
    # JSON of the attributes is unambiguous (NULL = key absent, "" kept)
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)


def change_only_history(dim: DataFrame, attributes: list[str] = CHANGE_ATTRIBUTES) -> DataFrame:
    """Per company keep a version only when its attributes differ from
    the previous version's; validity runs to the next kept version."""
    d = dim.select("id", "company_name", F.col("sys_valid_from").alias("changed_at"),
                   *attributes).withColumn("_h", _attr_hash(attributes))
    d = lead_within_key(d, "company_name", "changed_at", "id", "_prev_h", value_col="_h", descending=True)
    kept = d.filter(F.col("_prev_h").isNull() | (F.col("_prev_h") != F.col("_h"))).drop("_prev_h", "_h")
    kept = lead_within_key(kept, "company_name", "changed_at", "id", "valid_to")
    return kept.select("id", "company_name", F.col("changed_at").alias("valid_from"), "valid_to", *attributes)


CLASSIFICATIONS = {"company": "company_name", "sector": "corporate_sector",
                   "country": "country_of_origin", "currency": "reporting_currency"}


def _classified(dim: DataFrame) -> DataFrame:
    """(list_name, value) of every rating, in one scan of the dimension."""
    items = ", ".join(f"'{name}', {col}" for name, col in CLASSIFICATIONS.items())
    return dim.selectExpr(f"stack({len(CLASSIFICATIONS)}, {items}) as (list_name, value)").filter(F.col("value").isNotNull())


def classification_lists(dim: DataFrame) -> DataFrame:
    """Distinct companies, sectors, countries and currencies."""
    return _classified(dim).distinct()


def unknown_members(dim: DataFrame, members: DataFrame) -> DataFrame:
    """Values that are in no list of ``members`` (list_name, value), with
    the ratings that use them. A list may be as long as the dimension: values
    are counted before they meet it."""
    used = _classified(dim).groupBy("list_name", "value").agg(F.count(F.lit(1)).alias("ratings"))
    return used.join(members.select("list_name", "value"), ["list_name", "value"], "left_anti")


def industry_risk_fact(stg_ratings: DataFrame) -> DataFrame:
    """One row per (rating, industry position): industry, score, weight."""
    z = F.arrays_zip(F.col("industry_risk").alias("industry"),
                     F.col("industry_risk_score").alias("score"),
                     F.col("industry_weight").alias("weight"))
    return (stg_ratings.select("id", "company_name", F.posexplode(z).alias("pos", "z"))
            .select(F.col("id").alias("rating_id"), "company_name",
                    (F.col("pos") + 1).cast("bigint").alias("position"),
                    F.col("z.industry").alias("industry"), F.col("z.score").alias("score"),
                    F.col("z.weight").alias("weight_text"),
                    F.col("z.weight").try_cast("decimal(38,18)").alias("weight")))
