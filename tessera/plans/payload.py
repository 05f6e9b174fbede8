"""Reading the JSON payload of raw ratings.

The payload is parsed once per row into string maps (one per section), and
every field or list is then taken from those maps. Parsing each section as
``map<string,string>`` keeps one malformed value from nulling a whole
section: lists are parsed field by field, and a list value that is present
but not an array is flagged (``payload_ok``) instead of silently vanishing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import template as tpl
from tessera.functions.columns import text_array

# Payload labels -> staging column names (the label text is
# the key written by the extraction, the column is the warehouse name).
METADATA_FIELDS = [
    ("Rated entity", "company_name"),
    ("CorporateSector", "corporate_sector"),
    ("Accounting principles", "accounting_principles"),
    ("End of business year", "end_of_business_year"),
    ("Reporting Currency/Units", "reporting_currency"),
    ("Country of origin", "country_of_origin"),
    ("Operating profitability", "operating_profitability"),
    ("Interest cover", "interest_cover"),
    ("Cash flow cover", "cash_flow_cover"),
    ("Business risk profile", "business_risk_profile"),
    ("Market share", "market_share"),
    ("Sector/company-specific factors (1)", "sector_company_specific_factors_1"),
    ("Sector/company-specific factors (2)", "sector_company_specific_factors_2"),
    ("Diversification", "diversification"),
    ("Leverage", "leverage"),
    ("Financial risk profile", "financial_risk_profile"),
    ("Segmentation criteria", "segmentation_criteria"),
    ("(Blended) Industry risk profile", "blended_industry_risk_profile"),
    ("Liquidity", "liquidity"),
    ("Competitive Positioning", "competitive_positioning"),
]
LIST_FIELDS = [
    ("Rating methodologies applied", "rating_methodologies_applied"),
    ("Industry risk", "industry_risk"),
    ("Industry risk score", "industry_risk_score"),
    ("Industry weight", "industry_weight"),
]
META_SECTION = "evaluations_metadata"
METRICS_SECTION = "credit_metrics"
WEIGHT_LABEL = "Industry weight"
SMAP = "map<string,string>"
TOP = "struct<evaluations_metadata:string,credit_metrics:string,unexpected_cells:string,_meta:string>"


def parse_payload(raw: DataFrame, payload_col: str = "parsed_payload") -> DataFrame:
    """Adds ``_em`` (metadata map), ``_cm`` (metrics map), ``_meta`` (map),
    ``_uc`` (unexpected cells map), ``data_quality_passed`` and ``_ok``
    (``payload_ok``). Frames that
    were already parsed are returned as they are, so one parse can feed
    several models."""
    if "_em" in raw.columns:
        return raw
    others = [F.col(f"`{c}`") for c in raw.columns]
    top = raw.select(*others, _once(F.from_json(F.col(payload_col), TOP).alias("_top"), "_p"))
    sections = _once(F.struct(F.from_json(F.col("_p._top.evaluations_metadata"), SMAP).alias("_em"),
                              F.from_json(F.col("_p._top.credit_metrics"), SMAP).alias("_cm"),
                              F.from_json(F.col("_p._top.unexpected_cells"), SMAP).alias("_uc"),
                              F.from_json(F.col("_p._top._meta"), SMAP).alias("_meta")).alias("_maps"), "_s")
    return (top.select(*others, sections).select(*others, *[F.col(f"_s._maps.{c}").alias(c) for c in ("_em", "_cm", "_uc", "_meta")])
            .withColumn("data_quality_passed", F.col("_meta")["data_quality_passed"].try_cast("boolean"))
            .withColumn("_ok", payload_ok()))


def _once(value: Column, name: str) -> Column:
    """``value`` as a generator's only row: expressions above it use the value,
    while filters pushed below a projection would parse the text again for
    each of their terms."""
    return F.explode(F.array(F.struct(value))).alias(name)


def meta_field(name: str) -> Column:
    return F.col("_meta")[name]


def list_field(label: str, section_map: str = "_em") -> Column:
    return text_array(F.col(section_map)[label])


def list_ok(label: str, section_map: str = "_em") -> Column:
    raw = F.col(section_map)[label]
    return raw.isNull() | F.from_json(raw, "array<string>").isNotNull()


def payload_ok() -> Column:
    """False when a configured list, a metric or the year header is present
    but is not a JSON array."""
    ok = F.lit(True)
    for label, _ in LIST_FIELDS:
        ok = ok & list_ok(label)
    metrics = F.map_values(F.col("_cm"))
    return ok & F.coalesce(F.forall(metrics, lambda v: v.isNull() | F.from_json(v, "array<string>").isNotNull()), F.lit(True))


def metric_lists() -> Column:
    """credit_metrics map -> ARRAY<STRUCT<key, value>> without the header."""
    return F.map_entries(F.map_filter(F.col("_cm"), lambda k, v: k != F.lit(tpl.YEAR_HEADER)))


def year_header() -> Column:
    return text_array(F.col("_cm")[tpl.YEAR_HEADER])
