"""Parameterised read queries over the marts (the reference serves these
over HTTP; here each is a function returning a DataFrame).

Point lookups accept one value; the "per company" queries also accept a
list or a DataFrame of names (semi join, no driver-side list) or ``None``
for every company, in which case the top-1 choices run as aggregates
(``max_by``) so a company with many versions never lands in one task.

NULL order follows the reference's database: ``DESC`` puts NULLs first.
Ties the reference leaves open are broken by later keys (documented per
function) so results are deterministic.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import display_name, trunc_second, uri_bucket, uri_key
from tessera.operators.windows import ffill_within_key, top1_rows

SUMMARY_COLUMNS = ["company_name", "corporate_sector", "country_of_origin", "reporting_currency",
                   "business_risk_profile", "financial_risk_profile"]
DETAIL_API_COLUMNS = ["id", "version_id"] + SUMMARY_COLUMNS + ["end_of_business_year",
                                                                "accounting_principles"]


def _ts(v) -> Column:
    if isinstance(v, datetime):
        return F.lit(v).cast("timestamp_ntz")
    return F.lit(str(v)).cast("timestamp_ntz")


def _restrict(df: DataFrame, names, col: str = "company_name") -> DataFrame:
    """Keep rows whose ``col`` is in ``names`` (None = all)."""
    if names is None:
        return df
    if isinstance(names, DataFrame):
        return df.join(names.select(F.col(names.columns[0]).alias(col)).distinct(), on=col,
                       how="left_semi")
    if isinstance(names, str):
        names = [names]
    return df.filter(F.col(col).isin(list(names)))


def _rows_and_nest(details):
    """The rows a detail question chooses from, and what turns its choice
    into detail rows: a ``DetailLookup`` nests metrics last, a DataFrame of
    the view has them already."""
    if isinstance(details, DataFrame):
        return details, lambda rows: rows
    return details.rows, details.nest


def _winners(rows: DataFrame, rank: Column) -> DataFrame:
    """The greatest row per company by ``rank``; only ids and ranks are
    compared, the rows follow by a semi-join."""
    ids = top1_rows(rows.select("id", "company_name", rank.alias("_rank")), ["company_name"], F.col("_rank"))
    return rows.join(ids.select("id"), on="id", how="left_semi")


def snapshot_summary(dim: DataFrame) -> DataFrame:
    """13 columns of a version summary, times cut to seconds."""
    return dim.select(
        "id", "version_id", "company_name", "filename",
        trunc_second("sys_valid_from").alias("sys_valid_from"),
        trunc_second("sys_valid_to").alias("sys_valid_to"),
        "is_latest_version_for_business_year", "is_system_current", "max_actual_year",
        "end_of_business_year", "corporate_sector", "business_risk_profile", "financial_risk_profile")


def detail_view(details: DataFrame) -> DataFrame:
    """Q15: the 11 detail fields; metrics cut to name, value (double), year, year_type."""
    return details.select(*DETAIL_API_COLUMNS, F.transform("metrics", lambda m: F.struct(
        m["name"].alias("name"), m["value"].cast("string").cast("double").alias("value"),
        m["year"].alias("year"), m["year_type"].alias("year_type"))).alias("metrics"))


def flatten_details(view: DataFrame) -> DataFrame:
    """One row per metric (or one row with NULL metric fields): the flat
    form used to compare nested results."""
    return (view.select(*DETAIL_API_COLUMNS, F.explode_outer("metrics").alias("m"))
            .select(*DETAIL_API_COLUMNS,
                    F.col("m.name").alias("metric_name"), F.col("m.value").alias("metric_value"),
                    F.col("m.year").alias("metric_year"), F.col("m.year_type").alias("metric_year_type")))


# Q1
def companies(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_system_current")).select(*SUMMARY_COLUMNS).orderBy("company_name")


# Q2
def compare_as_of(details: DataFrame, company_ids, as_of) -> DataFrame:
    """Detail rows valid at system time ``as_of``: from <= t < to (open end)."""
    t = _ts(as_of)
    rows, nest = _rows_and_nest(details)
    valid = (F.col("sys_valid_from") <= t) & (F.col("sys_valid_to").isNull() | (F.col("sys_valid_to") > t))
    return detail_view(nest(_restrict(rows, company_ids).filter(valid)))


_LAST = 9223372036854775807  # probes sort after versions with the same time


def as_of_probes(dim: DataFrame, probes: DataFrame, key: str = "company_name",
                 at: str = "probe_at") -> DataFrame:
    """For many (company, time) probes at once, the dimension version
    valid at each probe's time (``sys_valid_from <= t < sys_valid_to``).

    Versions and probes are merged into one stream per company ordered by
    time and each probe takes the last version id before it (a skew-safe
    forward fill), so no company ever pairs all its versions with all its
    probes. Adds ``matched_id``, ``matched_version``, ``matched_valid_from``.
    Probes without a company match nothing (an equi join's rule)."""
    pcols = probes.columns
    blank = probes.filter(F.col(key).isNull())
    dim, probes = dim.filter(F.col("company_name").isNotNull()), probes.filter(F.col(key).isNotNull())
    v = dim.select(F.col("company_name").alias("_k"), F.col("sys_valid_from").alias("_t"),
                   F.col("id").alias("_tie"), F.col("id").alias("_vid"))
    p = probes.select(F.col(key).alias("_k"), F.col(at).alias("_t"),
                      F.lit(_LAST).cast("bigint").alias("_tie"), F.lit(None).cast("bigint").alias("_vid"),
                      F.struct(*[F.col(c) for c in pcols]).alias("_p"))
    merged = v.unionByName(p, allowMissingColumns=True)
    filled = ffill_within_key(merged, "_k", "_t", "_tie", "_vid", "matched_id")
    hits = filled.filter(F.col("_p").isNotNull()).select("_p.*", "matched_id")
    d = dim.select(F.col("id").alias("matched_id"), F.col("version_id").alias("matched_version"),
                   F.col("sys_valid_from").alias("matched_valid_from"))
    return hits.join(d, on="matched_id", how="left").select(
        *pcols, "matched_id", "matched_version", "matched_valid_from").unionByName(blank, allowMissingColumns=True)


def _latest_business_rank() -> Column:
    # max_actual_year DESC with NULLs first; id breaks ties.
    return F.struct(F.col("max_actual_year").isNull(), F.col("max_actual_year"), F.col("id"))


# Q3
def compare_business_year(details: DataFrame, company_ids, business_year: int) -> DataFrame:
    """Per company the latest-version row with the greatest business year
    (NULL year first, as the reference's DESC does); metrics kept when their
    year equals ``business_year`` or is NULL."""
    rows, nest = _rows_and_nest(details)
    d = _restrict(rows, company_ids).filter(F.col("is_latest_version_for_business_year"))
    return _filter_metric_year(detail_view(nest(_winners(d, _latest_business_rank()))), business_year)


def _filter_metric_year(view: DataFrame, business_year) -> DataFrame:
    if not business_year:
        return view
    y = F.lit(int(business_year))
    return view.withColumn("metrics", F.filter("metrics", lambda m: (m["year"] == y) | m["year"].isNull()))


def compare(details: DataFrame, company_ids, as_of_date=None, business_year=None) -> DataFrame:
    """One of the two is required (year 0 counts as missing); with both,
    ``as_of_date`` selects the rows and the year filters the metrics."""
    if not as_of_date and not business_year:
        raise ValueError("Must provide either as_of_date or business_year")
    if as_of_date:
        return _filter_metric_year(compare_as_of(details, company_ids, as_of_date), business_year)
    return compare_business_year(details, company_ids, business_year)


def _latest_row_rank() -> Column:
    # end_of_business_year DESC (NULLs first), then max_actual_year DESC
    # (NULLs last), sys_valid_from DESC, id DESC.
    return F.struct(F.col("end_of_business_year").isNull(), F.col("end_of_business_year"),
                    F.col("max_actual_year"), F.col("sys_valid_from"), F.col("id"))


# Q4
def company(details: DataFrame, name=None) -> DataFrame:
    """Top latest-version row per company (one company or all)."""
    rows, nest = _rows_and_nest(details)
    d = _restrict(rows, name).filter(F.col("is_latest_version_for_business_year"))
    return detail_view(nest(_winners(d, _latest_row_rank())))


# Q5
def company_versions(dim: DataFrame, name=None) -> DataFrame:
    return snapshot_summary(_restrict(dim, name)).orderBy(F.col("sys_valid_from").desc(),
                                                         F.col("id").desc())


# Q6
def company_history(dim: DataFrame, fct: DataFrame, name=None) -> DataFrame:
    """Metric time series of the single latest row per company. ``fct`` may
    be a ``DetailLookup``, which gives the facts of the chosen rows only."""
    d = _restrict(dim, name).filter(F.col("is_latest_version_for_business_year"))
    latest = top1_rows(d.select("id", "company_name", "end_of_business_year", "max_actual_year",
                                "sys_valid_from"), ["company_name"], _latest_row_rank())
    if not isinstance(fct, DataFrame):
        fct = fct.facts_of(latest.select(F.col("id").alias("rating_id")))
    f = fct.select(F.col("rating_id").alias("id"), "metric_name", "metric_value_numeric", "metric_year")
    return (latest.join(f, on="id", how="inner")
            .select("company_name", F.col("end_of_business_year").alias("evaluation_year"),
                    F.col("metric_name").alias("name"),
                    F.col("metric_value_numeric").alias("value"),
                    F.col("metric_year").alias("year"))
            .orderBy(F.col("company_name"), F.col("year").asc_nulls_last(), F.col("name")))


# Q7
def company_version(details: DataFrame, name, version_id: int) -> DataFrame:
    """Detail of one version per company; several rows with the same
    version (reprocessing) -> the newest."""
    rows, nest = _rows_and_nest(details)
    d = _restrict(rows, name).filter(F.col("version_id") == F.lit(int(version_id)))
    return detail_view(nest(_winners(d, F.struct(F.col("sys_valid_from"), F.col("id")))))


# Q8
def snapshots(dim: DataFrame, company_id=None, from_date=None, to_date=None, sector=None,
              country=None, currency=None) -> DataFrame:
    """Optional conjunctive filters on system time and attributes."""
    preds = []
    if company_id:
        preds.append(F.col("company_name") == company_id)
    if from_date:
        preds.append(F.col("sys_valid_from") >= _ts(from_date))
    if to_date:
        preds.append(F.col("sys_valid_from") <= _ts(to_date))
    if sector:
        preds.append(F.col("corporate_sector") == sector)
    if country:
        preds.append(F.col("country_of_origin") == country)
    if currency:
        preds.append(F.col("reporting_currency") == currency)
    d = dim
    for p in preds:
        d = d.filter(p)
    return snapshot_summary(d).orderBy(F.col("sys_valid_from").desc(), F.col("id").desc())


def snapshots_page(dim: DataFrame, page: int, page_size: int, **filters) -> DataFrame:
    """One page of ``snapshots`` (stable order: time desc, id desc)."""
    return snapshots(dim, **filters).offset(page * page_size).limit(page_size)


# Q9
def snapshots_latest(dim: DataFrame) -> DataFrame:
    return snapshot_summary(dim.filter(F.col("is_system_current"))).orderBy("company_name")


# Q10
def snapshot(details: DataFrame, snapshot_id) -> DataFrame:
    rows, nest = _rows_and_nest(details)
    return detail_view(nest(rows.filter(F.col("id") == F.lit(int(snapshot_id)))))


# Q11
def uploads(audits: DataFrame) -> DataFrame:
    return (audits.select(F.col("upload_id").cast("string").alias("upload_id"), "filename",
                          "updated_at", "data_quality_passed", "business_rules_passed",
                          "parser_sha", "schema_sha")
            .orderBy(F.col("updated_at").desc(), F.col("upload_id").desc()))


# Q12
def upload_stats(audits: DataFrame) -> DataFrame:
    """Uploads per day, newest first, with the overall total on every row.
    The total is a scalar summed from the per-day counts (one row per day)
    and added as a literal."""
    per_day = (audits.groupBy(F.to_date("updated_at").alias("day"))
               .agg(F.count(F.lit(1)).alias("count")))
    total = per_day.agg(F.sum("count")).first()[0] or 0
    return (per_day.select(F.col("day").cast("string").alias("date"), "count",
                           F.lit(total).cast("bigint").alias("total_uploads"))
            .orderBy(F.col("date").desc()))


# Q13
def upload(audits: DataFrame, upload_id: str) -> DataFrame:
    # the literal is cast, not the column, so the predicate reaches the scan;
    # texts that are no number match nothing
    number = int(upload_id) if str(upload_id).lstrip("-").isdigit() else None
    return (audits.filter(F.col("upload_id") == F.lit(number).cast("bigint"))
            .select(F.col("upload_id").cast("string").alias("upload_id"), "filename",
                    "updated_at", "data_quality_passed", "business_rules_passed",
                    "parser_sha", "schema_sha", "parsed_payload"))


# Q14
def file_locations(files_audit: DataFrame) -> DataFrame:
    key = uri_key("s3_path")
    return files_audit.select("id", "s3_path", uri_bucket("s3_path").alias("bucket"),
                              key.alias("key"), display_name(key).alias("original_name"))


def upload_file_location(files_audit: DataFrame, upload_id) -> DataFrame:
    return file_locations(files_audit.filter(F.col("id") == F.lit(int(upload_id))))
