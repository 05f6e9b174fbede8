"""DuckDB SQL that recomputes each registered query straight from the
relational driver tables (never through the JSON payloads), for the
side-by-side correctness check. Output conventions shared with
``tessera.registry``: decimals as DOUBLE parsed from their exact text,
arrays as JSON text, dates as ISO text.
"""

from __future__ import annotations

from tessera.sources import fixture_ratings as fx
from tessera.registry import PARAMS


def _list(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


def _dbl(x: str) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def _year_type(x: str) -> str:
    t = f"trim({x})"
    return (f"CASE WHEN regexp_matches({t}, '^[0-9]{{4}}$') OR {t} LIKE '%A' THEN 'Actual' "
            f"WHEN {t} LIKE '%E' THEN 'Estimate' WHEN {t} LIKE '%P' THEN 'Pro-forma' "
            f"WHEN {t} LIKE '%R' THEN 'Restated' WHEN {t} LIKE '%F' THEN 'Forecast' "
            f"ELSE 'Unknown' END")


NULL_TEXT_COLS = ["accounting_principles", "end_of_business_year", "reporting_currency",
                  "operating_profitability", "interest_cover", "cash_flow_cover", "market_share",
                  "sector_company_specific_factors_1", "sector_company_specific_factors_2",
                  "diversification", "leverage", "financial_risk_profile", "segmentation_criteria",
                  "blended_industry_risk_profile", "liquidity", "competitive_positioning"]


def base_ctes() -> str:
    suffixes = _list(fx.YEAR_SUFFIXES)
    nulls = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in NULL_TEXT_COLS)
    return f"""
raw AS (
  SELECT o.o_orderkey AS id, o.o_orderkey AS upload_id,
         o.o_orderdate + to_milliseconds(o.o_orderkey) AS updated_at,
         c.c_name AS company_name, c.c_mktsegment AS corporate_sector, n.n_name AS country_of_origin,
         o.o_orderpriority AS business_risk_profile, {nulls},
         o.o_orderstatus <> 'F' AS data_quality_passed,
         o.o_orderstatus AS o_orderstatus,
         CASE WHEN o.o_orderkey % 7 = 0 THEN 'corporates-' || CAST(o.o_custkey AS VARCHAR) || '.xlsm'
              ELSE 'corporates_' || CAST(o.o_custkey AS VARCHAR) || '_' || CAST(1 + o.o_orderkey % 5 AS VARCHAR) || '.xlsm'
         END AS filename,
         CAST([] AS VARCHAR[]) AS rating_methodologies_applied,
         CAST([] AS VARCHAR[]) AS industry_risk,
         CAST([] AS VARCHAR[]) AS industry_risk_score,
         CASE WHEN o.o_orderkey % 10 = 0 THEN {_list(fx.FAILED_WEIGHTS)}
              WHEN o.o_orderkey % 10 = 1 THEN CAST([] AS VARCHAR[])
              ELSE {_list(fx.GOOD_WEIGHTS)} END AS industry_weight,
         '{fx.fixture_parser_sha()}' AS parser_sha,
         '{fx.fixture_schema_sha()}' AS schema_sha
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
yrs AS (
  SELECT l_orderkey AS rating_id, CAST(year(l_shipdate) AS INTEGER) AS yr,
         sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty,
         max(CAST(l_extendedprice AS DECIMAL(18,2))) AS price
  FROM lineitem GROUP BY 1, 2
),
hdr AS (
  SELECT rating_id, yr, qty, price,
         row_number() OVER (PARTITION BY rating_id ORDER BY yr) AS year_idx,
         CAST(yr AS VARCHAR) || ({suffixes})[CAST((rating_id + yr) % 8 AS INTEGER) + 1] AS year_str
  FROM yrs
),
mvals AS (
  SELECT h.rating_id, h.year_idx, h.year_str, mn.metric_name,
         CASE WHEN mn.metric_name = '{fx.METRIC_QUANTITY}' THEN CAST(h.qty AS VARCHAR)
              WHEN h.rating_id % 11 = 0 THEN '{fx.NOT_AVAILABLE}'
              ELSE CAST(h.price AS VARCHAR) END AS metric_val
  FROM hdr h CROSS JOIN (VALUES ('{fx.METRIC_QUANTITY}'), ('{fx.METRIC_PRICE}')) mn(metric_name)
),
stg_metrics AS (
  SELECT m.rating_id, r.upload_id, r.updated_at, m.metric_name,
         CAST(m.year_idx AS BIGINT) AS year_idx,
         TRY_CAST(NULLIF(regexp_extract(m.year_str, '^[0-9]+'), '') AS INTEGER) AS metric_year,
         m.year_str AS metric_year_str,
         {_year_type('m.year_str')} AS metric_year_type,
         CASE WHEN regexp_matches(m.metric_val, '^-?[0-9]+(\\.[0-9]+)?$')
              THEN CAST(m.metric_val AS DECIMAL(38,18)) END AS metric_value_numeric,
         m.metric_val AS metric_value_text
  FROM mvals m JOIN raw r ON r.id = m.rating_id
  WHERE r.data_quality_passed
),
stg_ratings AS (SELECT * FROM raw WHERE data_quality_passed),
max_years AS (
  SELECT upload_id, rating_id, max(metric_year) AS max_actual_year
  FROM stg_metrics WHERE metric_year_type = 'Actual' GROUP BY 1, 2
),
dim0 AS (
  SELECT s.*, m.max_actual_year,
         TRY_CAST(NULLIF(regexp_extract(s.filename, '^.*_([0-9]+)\\.[a-zA-Z]+$', 1), '') AS INTEGER) AS version_id,
         s.updated_at AS sys_valid_from,
         LEAD(s.updated_at) OVER (PARTITION BY s.company_name ORDER BY s.updated_at, s.id) AS sys_valid_to
  FROM stg_ratings s LEFT JOIN max_years m ON s.upload_id = m.upload_id AND s.id = m.rating_id
),
dim AS (
  SELECT *, sys_valid_to IS NULL AS is_system_current,
         ROW_NUMBER() OVER (PARTITION BY company_name, max_actual_year
                            ORDER BY COALESCE(version_id, 1) DESC, updated_at DESC, id DESC) = 1
           AS is_latest_version_for_business_year
  FROM dim0
),
fct AS (
  SELECT m.rating_id, m.upload_id, r.company_name, r.corporate_sector, m.metric_name, m.metric_year,
         m.metric_year_str, m.metric_year_type, ROUND(m.metric_value_numeric, 4) AS metric_value_numeric,
         m.metric_value_text, m.updated_at
  FROM stg_metrics m JOIN stg_ratings r ON m.rating_id = r.id
),
details_flat AS (
  SELECT d.id, d.version_id, d.company_name, d.corporate_sector, d.country_of_origin,
         d.reporting_currency, d.business_risk_profile, d.financial_risk_profile,
         d.end_of_business_year, d.accounting_principles, d.sys_valid_from, d.sys_valid_to,
         d.is_system_current, d.is_latest_version_for_business_year, d.max_actual_year,
         f.metric_name, {_dbl('f.metric_value_numeric')} AS metric_value, f.metric_value_text,
         f.metric_year, f.metric_year_type
  FROM dim d LEFT JOIN fct f ON d.id = f.rating_id
),
audits AS (
  SELECT upload_id, updated_at, filename, parser_sha, schema_sha, data_quality_passed,
         COALESCE(ABS((SELECT COALESCE(SUM(CAST(w AS DECIMAL(38,18))), 0) FROM unnest(industry_weight) t(w)) - 1.0) <= 0.00001, false)
           AS business_rules_passed,
         true AS payload_well_formed
  FROM raw
)"""


SUMMARY13 = ("id, version_id, company_name, filename, date_trunc('second', sys_valid_from) AS sys_valid_from, "
             "date_trunc('second', sys_valid_to) AS sys_valid_to, is_latest_version_for_business_year, "
             "is_system_current, max_actual_year, end_of_business_year, corporate_sector, "
             "business_risk_profile, financial_risk_profile")
DETAIL_FLAT = ("id, version_id, company_name, corporate_sector, country_of_origin, reporting_currency, "
               "business_risk_profile, financial_risk_profile, end_of_business_year, accounting_principles, "
               "metric_name, metric_value, metric_year, metric_year_type")
LATEST_ROW_ORDER = ("end_of_business_year DESC NULLS FIRST, max_actual_year DESC NULLS LAST, "
                    "sys_valid_from DESC, id DESC")


def _with(body: str) -> str:
    return "WITH " + base_ctes().strip() + "\n" + body


def oracle_queries() -> dict[str, str]:
    p = PARAMS
    q: dict[str, str] = {}
    q["stg_ratings_typed"] = _with("""
SELECT id, upload_id, updated_at, company_name, corporate_sector, accounting_principles,
       end_of_business_year, reporting_currency, country_of_origin, operating_profitability,
       interest_cover, cash_flow_cover, business_risk_profile, market_share,
       sector_company_specific_factors_1, sector_company_specific_factors_2, diversification,
       leverage, financial_risk_profile, segmentation_criteria, blended_industry_risk_profile,
       liquidity, competitive_positioning,
       to_json(rating_methodologies_applied) AS rating_methodologies_applied,
       to_json(industry_risk) AS industry_risk, to_json(industry_risk_score) AS industry_risk_score,
       to_json(industry_weight) AS industry_weight, filename, parser_sha, schema_sha
FROM stg_ratings""")
    q["stg_metrics_long"] = _with(f"""
SELECT rating_id, upload_id, updated_at, metric_name, year_idx, metric_year, metric_year_str,
       metric_year_type, {_dbl('metric_value_numeric')} AS metric_value_numeric, metric_value_text
FROM stg_metrics""")
    q["max_actual_year"] = _with("SELECT upload_id, rating_id, max_actual_year FROM max_years")
    q["dim_bitemporal"] = _with("""
SELECT id, upload_id, company_name, corporate_sector, accounting_principles, end_of_business_year,
       reporting_currency, country_of_origin, operating_profitability, interest_cover, cash_flow_cover,
       business_risk_profile, market_share, sector_company_specific_factors_1,
       sector_company_specific_factors_2, diversification, leverage, financial_risk_profile,
       segmentation_criteria, blended_industry_risk_profile, liquidity, competitive_positioning,
       to_json(rating_methodologies_applied) AS rating_methodologies_applied,
       to_json(industry_risk) AS industry_risk, to_json(industry_risk_score) AS industry_risk_score,
       to_json(industry_weight) AS industry_weight, filename, parser_sha, schema_sha,
       sys_valid_from, sys_valid_to, is_system_current, is_latest_version_for_business_year,
       max_actual_year, version_id
FROM dim""")
    q["fct_metrics_rounded"] = _with(f"""
SELECT rating_id, upload_id, company_name, corporate_sector, metric_name, metric_year,
       metric_year_str, metric_year_type, {_dbl('metric_value_numeric')} AS metric_value_numeric,
       metric_value_text, updated_at
FROM fct""")
    q["company_details_nested"] = _with("""
SELECT id, version_id, company_name, corporate_sector, country_of_origin, reporting_currency,
       business_risk_profile, financial_risk_profile, end_of_business_year, accounting_principles,
       sys_valid_from, sys_valid_to, is_system_current, is_latest_version_for_business_year,
       max_actual_year, metric_name, metric_value, metric_value_text, metric_year, metric_year_type
FROM details_flat""")
    q["upload_audits"] = _with("""
SELECT upload_id, updated_at, filename, parser_sha, schema_sha, data_quality_passed, business_rules_passed,
       payload_well_formed
FROM audits""")
    q["companies_current"] = _with("""
SELECT company_name, corporate_sector, country_of_origin, reporting_currency, business_risk_profile,
       financial_risk_profile
FROM dim WHERE is_system_current""")
    q["compare_as_of"] = _with(f"""
SELECT {DETAIL_FLAT} FROM details_flat
WHERE sys_valid_from <= TIMESTAMP '{p['as_of']}'
  AND (sys_valid_to > TIMESTAMP '{p['as_of']}' OR sys_valid_to IS NULL)""")
    q["compare_business_year"] = _with(f"""
, best AS (
  SELECT id FROM (
    SELECT id, ROW_NUMBER() OVER (PARTITION BY company_name
                                  ORDER BY max_actual_year DESC NULLS FIRST, id DESC) AS rn
    FROM dim WHERE is_latest_version_for_business_year) x
  WHERE rn = 1),
kept AS (
  SELECT {DETAIL_FLAT} FROM details_flat
  WHERE id IN (SELECT id FROM best) AND metric_name IS NOT NULL
    AND (metric_year = {p['business_year']} OR metric_year IS NULL))
SELECT * FROM kept
UNION ALL
SELECT id, version_id, company_name, corporate_sector, country_of_origin, reporting_currency,
       business_risk_profile, financial_risk_profile, end_of_business_year, accounting_principles,
       CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR)
FROM dim WHERE id IN (SELECT id FROM best) AND id NOT IN (SELECT id FROM kept)""")
    q["company_latest"] = _with(f"""
SELECT {DETAIL_FLAT} FROM details_flat WHERE id IN (
  SELECT id FROM (
    SELECT id, ROW_NUMBER() OVER (PARTITION BY company_name ORDER BY {LATEST_ROW_ORDER}) AS rn
    FROM dim WHERE is_latest_version_for_business_year) x WHERE rn = 1)""")
    q["company_versions"] = _with(f"SELECT {SUMMARY13} FROM dim")
    q["company_history"] = _with(f"""
, latest AS (
  SELECT id, company_name, end_of_business_year FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY company_name ORDER BY {LATEST_ROW_ORDER}) AS rn
    FROM dim WHERE is_latest_version_for_business_year) x WHERE rn = 1)
SELECT d.company_name, d.end_of_business_year AS evaluation_year, f.metric_name AS name,
       {_dbl('f.metric_value_numeric')} AS value, f.metric_year AS year
FROM latest d JOIN fct f ON d.id = f.rating_id""")
    q["company_version_detail"] = _with(f"""
SELECT {DETAIL_FLAT} FROM details_flat WHERE id IN (
  SELECT id FROM (
    SELECT id, ROW_NUMBER() OVER (PARTITION BY company_name ORDER BY sys_valid_from DESC, id DESC) AS rn
    FROM dim WHERE version_id = {p['version_id']}) x WHERE rn = 1)""")
    q["snapshots_filtered"] = _with(f"""
SELECT {SUMMARY13} FROM dim
WHERE sys_valid_from >= TIMESTAMP '{p['from_date']}' AND sys_valid_from <= TIMESTAMP '{p['to_date']}'
  AND corporate_sector = '{p['sector']}'""")
    q["snapshots_latest"] = _with(f"SELECT {SUMMARY13} FROM dim WHERE is_system_current")
    q["as_of_probes"] = _with("""
SELECT r.upload_id, r.company_name, r.updated_at AS probe_at, d.id AS matched_id,
       d.version_id AS matched_version, d.sys_valid_from AS matched_valid_from
FROM raw r ASOF LEFT JOIN dim d ON r.company_name = d.company_name AND r.updated_at >= d.sys_valid_from""")
    q["snapshot_detail"] = _with(f"SELECT {DETAIL_FLAT} FROM details_flat WHERE id = {p['snapshot_id']}")
    q["uploads_list"] = _with("""
SELECT CAST(upload_id AS VARCHAR) AS upload_id, filename, updated_at, data_quality_passed,
       business_rules_passed, parser_sha, schema_sha
FROM audits""")
    q["upload_stats_by_day"] = _with("""
, per_day AS (SELECT CAST(CAST(updated_at AS DATE) AS VARCHAR) AS date, count(*) AS count FROM audits GROUP BY 1)
SELECT date, count, (SELECT count(*) FROM audits) AS total_uploads FROM per_day""")
    q["upload_detail"] = _with(f"""
SELECT CAST(upload_id AS VARCHAR) AS upload_id, filename, updated_at, data_quality_passed,
       business_rules_passed, parser_sha, schema_sha
FROM audits WHERE CAST(upload_id AS VARCHAR) = '{p['upload_id']}'""")
    q["upload_file_location"] = f"""
WITH files AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderkey % 7 = 0 THEN 'corporates-' || CAST(o_custkey AS VARCHAR) || '.xlsm'
              ELSE 'corporates_' || CAST(o_custkey AS VARCHAR) || '_' || CAST(1 + o_orderkey % 5 AS VARCHAR) || '.xlsm'
         END AS filename
  FROM orders),
hashed AS (SELECT id, filename, sha256(filename || ':' || CAST(id AS VARCHAR)) AS h FROM files)
SELECT id, 's3://archive/' || h || '_' || filename AS s3_path, 'archive' AS bucket,
       h || '_' || filename AS key, filename AS original_name
FROM hashed"""
    q.update(_quality_and_reports(p))
    q.update(_intake(p))
    q["landing_stream_available_now"] = q["dim_bitemporal"]
    q["replayed_batches"] = q["dim_bitemporal"]
    q.update(_cells())
    q["incremental_delta"] = _with(f"""
SELECT id, upload_id, updated_at, company_name, filename FROM stg_ratings
WHERE updated_at > (SELECT max(updated_at) FROM stg_ratings WHERE updated_at < TIMESTAMP '{p['cut_2']}')""")
    bad = f"(r.id % {p['blank_every']} = 3 AND r.id IN (SELECT rating_id FROM hdr))"
    q["publish_quarantine"] = _with(f"""SELECT r.id AS rating_id, 'published' AS state, CAST(NULL AS VARCHAR) AS test_name,
  (SELECT count(*) FROM stg_metrics m WHERE m.rating_id = r.id) AS n,
  LEAD(r.updated_at) OVER (PARTITION BY r.company_name ORDER BY r.updated_at, r.id) AS sys_valid_to
FROM stg_ratings r WHERE NOT {bad}
UNION ALL
SELECT r.id, 'quarantined', 'not_null_fct_metric_year', (SELECT count(*) FROM mvals m WHERE m.rating_id = r.id AND m.year_idx = 1),
  CAST(NULL AS TIMESTAMP) FROM stg_ratings r WHERE {bad}""")
    q["upsert_single_key"] = _with("SELECT id, upload_id, updated_at, company_name, filename FROM stg_ratings")
    q["upsert_composite_key"] = _with(
        "SELECT rating_id, metric_name, year_idx, metric_year_str, metric_value_text, updated_at FROM stg_metrics")
    return q


def _count_test(name: str, sql_count: str) -> str:
    return f"SELECT '{name}' AS test_name, CAST(({sql_count}) AS BIGINT) AS failures"


def _quality_and_reports(p) -> dict[str, str]:
    q: dict[str, str] = {}
    nn = lambda model, col: _count_test(f"not_null_{model}_{col}", f"SELECT count(*) FROM {model} WHERE {col} IS NULL")
    uq = lambda model, col: _count_test(
        f"unique_{model}_{col}",
        f"SELECT count(*) FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    parts = [uq("dim", "id"), nn("dim", "id"), nn("dim", "company_name")]
    parts += [nn("fct", c) for c in ["rating_id", "company_name", "metric_name", "metric_year", "metric_year_type"]]
    parts += [uq("stg", "id"), nn("stg", "id"), nn("stg", "company_name")]
    q["dq_unique_not_null"] = _with(", stg AS (SELECT * FROM stg_ratings)\n" + "\nUNION ALL\n".join(parts))
    types = ", ".join(f"'{t}'" for t in ["Actual", "Estimate", "Pro-forma", "Restated", "Forecast", "Unknown"])
    parts = [
        _count_test("accepted_values_fct_metric_year_type",
                    f"SELECT count(*) FROM fct WHERE metric_year_type IS NOT NULL AND metric_year_type NOT IN ({types})"),
        _count_test("accepted_values_stg_metrics_metric_year_type",
                    f"SELECT count(*) FROM stg_metrics WHERE metric_year_type IS NOT NULL AND metric_year_type NOT IN ({types})"),
        _count_test("relationships_fct_rating_id",
                    "SELECT count(*) FROM (SELECT DISTINCT rating_id FROM fct WHERE rating_id IS NOT NULL "
                    "AND rating_id NOT IN (SELECT id FROM dim))"),
        _count_test("relationships_stg_metrics_rating_id",
                    "SELECT count(*) FROM (SELECT rating_id FROM stg_metrics WHERE rating_id IS NOT NULL "
                    "AND rating_id NOT IN (SELECT id FROM stg_ratings))"),
    ]
    q["dq_domain_and_fk"] = _with("\n" + "\nUNION ALL\n".join(parts))
    q["dq_weights_sum"] = _with(f"""
SELECT id, {_dbl('sum(CAST(w AS DECIMAL(38,18)))')} AS total_weight
FROM stg_ratings, unnest(industry_weight) t(w)
GROUP BY id HAVING abs(sum(CAST(w AS DECIMAL(38,18))) - 1) > 0.00001""")
    mapped = {"Rated entity": "company_name", "CorporateSector": "corporate_sector",
              "Country of origin": "country_of_origin", "Business risk profile": "business_risk_profile"}
    from tessera import template as tpl
    labels = tpl.get_template()["sections"]["evaluations_metadata"]["key_value"]
    rows = []
    for lab in labels:
        col = mapped.get(lab)
        present = (f"(SELECT count(*) FROM raw WHERE {col} IS NOT NULL AND {col} <> '')" if col else "0")
        lab_sql = lab.replace("'", "''")
        rows.append(f"SELECT 'evaluations_metadata' AS section, '{lab_sql}' AS field, "
                    f"(SELECT count(*) FROM raw) AS n_uploads, CAST({present} AS BIGINT) AS n_present")
    q["quality_report"] = _with(", fields AS (" + "\nUNION ALL\n".join(rows) + """)
SELECT section, field, n_uploads, n_present, n_uploads - n_present AS n_missing,
       round(CAST(n_present AS DOUBLE) / n_uploads, 6) AS completeness FROM fields""")
    q["quality_error_kinds"] = _with("""
SELECT 'unexpected_cell' AS kind, count(*) AS n_errors FROM raw WHERE NOT data_quality_passed
HAVING count(*) > 0""")
    q["range_rules"] = _with("""
SELECT id, 'industry_weight_in_0_1' AS rule, CAST(pos AS INTEGER) AS position, industry_weight[pos] AS value
FROM stg_ratings, range(1, len(industry_weight) + 1) r(pos)
WHERE TRY_CAST(industry_weight[pos] AS DECIMAL(38,18)) IS NULL
   OR TRY_CAST(industry_weight[pos] AS DECIMAL(38,18)) < 0 OR TRY_CAST(industry_weight[pos] AS DECIMAL(38,18)) > 1""")
    weights = ", range(1, len(industry_weight) + 1) r(pos)"
    checked = """, checked(upload_id, filename, rule, field, position, value, verdict) AS (
SELECT upload_id, filename, 'company_given', 'Rated entity', 1, company_name, 'valid' FROM raw
UNION ALL SELECT upload_id, filename, 'currency_given', 'Reporting currency', 1, NULL, 'missing' FROM raw
UNION ALL SELECT upload_id, filename, 'sector_known', 'CorporateSector', 1, corporate_sector,
  CASE WHEN corporate_sector IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY') THEN 'valid' ELSE 'invalid' END FROM raw
UNION ALL SELECT upload_id, filename, 'risk_profile_form', 'Business risk profile', 1, business_risk_profile,
  CASE WHEN regexp_full_match(business_risk_profile, '[1-4]-[A-Z]+') THEN 'valid' ELSE 'invalid' END FROM raw
UNION ALL SELECT upload_id, filename, 'weight_range', 'Industry weight', CAST(pos AS INTEGER), industry_weight[pos],
  CASE WHEN CAST(industry_weight[pos] AS DECIMAL(18,6)) BETWEEN 0.2 AND 1 THEN 'valid' ELSE 'invalid' END FROM raw""" + weights + """
UNION ALL SELECT r.upload_id, r.filename, 'year_form', 'year', CAST(year_idx AS INTEGER), year_str,
  CASE WHEN year_str LIKE '%Q' THEN 'invalid' ELSE 'valid' END FROM hdr JOIN raw r ON r.id = rating_id
UNION ALL SELECT r.upload_id, r.filename, 'metric_number', metric_name, CAST(year_idx AS INTEGER), metric_val,
  CASE WHEN TRY_CAST(metric_val AS DECIMAL(38,18)) BETWEEN 0 AND 90000 THEN 'valid' ELSE 'invalid' END FROM mvals JOIN raw r ON r.id = rating_id)
"""
    q["rule_violations"] = _with(checked + "SELECT * FROM checked WHERE verdict <> 'valid'")
    q["file_quality_report"] = _with(checked + """
SELECT upload_id, filename, n_valid, n_invalid, n_missing, round(CAST(needed - n_missing AS DOUBLE) / needed, 6) AS completeness,
       round(CAST(n_valid AS DOUBLE) / (n_valid + n_invalid), 6) AS validity
FROM (SELECT upload_id, filename, count(*) FILTER (WHERE verdict = 'valid') AS n_valid, count(*) FILTER (WHERE verdict = 'invalid') AS n_invalid,
  count(*) FILTER (WHERE verdict = 'missing') AS n_missing,
  count(*) FILTER (WHERE rule IN ('company_given', 'currency_given', 'year_form')) AS needed FROM checked GROUP BY 1, 2)""")
    q["run_metrics"] = _with("""
SELECT count(*) AS uploads, count(*) FILTER (WHERE data_quality_passed) AS passed,
       count(*) FILTER (WHERE NOT data_quality_passed) AS failed,
       count(*) FILTER (WHERE NOT data_quality_passed) AS errors,
       (SELECT count(*) FROM stg_metrics) AS metric_rows
FROM raw""")
    q["upload_success_rate"] = _with("""
SELECT CAST(CAST(updated_at AS DATE) AS VARCHAR) AS date, count(*) AS uploads,
       count(*) FILTER (WHERE data_quality_passed) AS dq_passed,
       count(*) FILTER (WHERE data_quality_passed AND business_rules_passed) AS all_passed,
       round(CAST(count(*) FILTER (WHERE data_quality_passed AND business_rules_passed) AS DOUBLE) / count(*), 6) AS success_rate
FROM audits GROUP BY 1""")
    q["snapshots_page"] = _with(f"""
SELECT * FROM (SELECT {SUMMARY13} FROM dim)
ORDER BY sys_valid_from DESC, id DESC LIMIT {p['page_size']} OFFSET {p['page'] * p['page_size']}""")
    q["one_big_table"] = _with(f"""
SELECT f.rating_id, f.upload_id, f.company_name, f.corporate_sector, f.metric_name, f.metric_year,
       f.metric_year_str, f.metric_year_type, {_dbl('f.metric_value_numeric')} AS metric_value_numeric,
       f.metric_value_text, f.updated_at, d.version_id, d.country_of_origin, d.reporting_currency,
       d.business_risk_profile, d.financial_risk_profile, d.sys_valid_from, d.sys_valid_to,
       d.is_system_current, d.is_latest_version_for_business_year, d.max_actual_year
FROM fct f JOIN dim d ON f.rating_id = d.id""")
    q["one_big_table_year"] = q["one_big_table"] + f" WHERE f.metric_year = {p['business_year']}"
    attrs = ["corporate_sector", "country_of_origin", "reporting_currency", "business_risk_profile",
             "financial_risk_profile", "end_of_business_year", "accounting_principles"]
    lags = ", ".join(f"LAG({a}) OVER w AS prev_{a}" for a in attrs)
    changed = " OR ".join(f"{a} IS DISTINCT FROM prev_{a}" for a in attrs)
    q["scd_change_only"] = _with(f"""
, l AS (
  SELECT id, company_name, sys_valid_from AS changed_at, {", ".join(attrs)},
         ROW_NUMBER() OVER w AS rn, {lags}
  FROM dim WINDOW w AS (PARTITION BY company_name ORDER BY sys_valid_from, id)),
kept AS (SELECT * FROM l WHERE rn = 1 OR {changed})
SELECT id, company_name, changed_at AS valid_from,
       LEAD(changed_at) OVER (PARTITION BY company_name ORDER BY changed_at, id) AS valid_to,
       {", ".join(attrs)}
FROM kept""")
    q["classification_lists"] = _with("""
SELECT DISTINCT * FROM (
  SELECT 'company' AS list_name, company_name AS value FROM dim
  UNION ALL SELECT 'sector', corporate_sector FROM dim
  UNION ALL SELECT 'country', country_of_origin FROM dim
  UNION ALL SELECT 'currency', reporting_currency FROM dim) x
WHERE value IS NOT NULL""")
    q["unknown_members"] = _with(f"""
SELECT 'company' AS list_name, company_name AS value, count(*) AS ratings FROM dim
WHERE company_name NOT IN (SELECT c_name FROM customer WHERE c_custkey % 50 <> 7) GROUP BY 2
UNION ALL SELECT 'sector', corporate_sector, count(*) FROM dim
WHERE corporate_sector NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY') GROUP BY 2
UNION ALL SELECT 'country', country_of_origin, count(*) FROM dim
WHERE country_of_origin NOT IN (SELECT n_name FROM nation WHERE n_regionkey <> {p['unlisted_region']}) GROUP BY 2""")
    q["industry_risk_fact"] = _with(f"""
SELECT id AS rating_id, company_name, CAST(pos AS BIGINT) AS position,
       CAST(NULL AS VARCHAR) AS industry, CAST(NULL AS VARCHAR) AS score,
       industry_weight[pos] AS weight_text,
       {_dbl('TRY_CAST(industry_weight[pos] AS DECIMAL(38,18))')} AS weight
FROM stg_ratings, range(1, len(industry_weight) + 1) r(pos)""")
    return q


FILENAME_SQL = ("CASE WHEN o_orderkey % 7 = 0 THEN 'corporates-' || CAST(o_custkey AS VARCHAR) || '.xlsm' "
                "ELSE 'corporates_' || CAST(o_custkey AS VARCHAR) || '_' || CAST(1 + o_orderkey % 5 AS VARCHAR) "
                "|| '.xlsm' END")


def _intake(p) -> dict[str, str]:
    q: dict[str, str] = {}
    q["register_files_first_wins"] = f"""
WITH f AS (
  SELECT 'doc_' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.txt' AS filename, sha256(text) AS file_hash, lang
  FROM documents),
b1 AS (SELECT file_hash, min(filename) AS filename FROM f WHERE lang = '{p['first_batch_lang']}' GROUP BY 1),
a1 AS (SELECT ROW_NUMBER() OVER (ORDER BY filename, file_hash) AS id, filename, file_hash FROM b1),
b2 AS (SELECT file_hash, min(filename) AS filename FROM f GROUP BY 1),
n2 AS (SELECT * FROM b2 WHERE file_hash NOT IN (SELECT file_hash FROM a1)),
a2 AS (SELECT (SELECT max(id) FROM a1) + ROW_NUMBER() OVER (ORDER BY filename, file_hash) AS id,
              filename, file_hash FROM n2),
a AS (SELECT * FROM a1 UNION ALL SELECT * FROM a2)
SELECT CAST(id AS BIGINT) AS id, filename, file_hash, 's3://archive/' || file_hash || '_' || filename AS s3_path
FROM a"""
    todo = f"o_orderkey % {p['unparsed_every']} = 4 OR o_orderkey % {p['older_every']} = 5"
    q["idempotent_skip"] = f"""
WITH f AS (SELECT o_orderkey AS id, {FILENAME_SQL} AS filename, o_orderstatus, o_orderkey FROM orders)
SELECT id, filename,
       CASE WHEN {todo} THEN 'process' WHEN o_orderstatus <> 'F' THEN 'skipped' ELSE 'failed_before' END AS status,
       CASE WHEN o_orderstatus = 'F' AND NOT ({todo})
            THEN 'Validation previously failed for spreadsheet ' || chr(39) || filename || chr(39)
                 || ': Unexpected data point found in cell Z100: ' || chr(39) || o_orderstatus || chr(39) END
         AS message
FROM f"""
    q["reprocess_match"] = f"""
WITH f AS (SELECT o_orderkey AS id, {FILENAME_SQL} AS filename FROM orders),
h AS (SELECT id, filename, sha256(filename || ':' || CAST(id AS VARCHAR)) AS file_hash FROM f)
SELECT id, filename, 's3://archive/' || file_hash || '_' || filename AS s3_path
FROM h WHERE filename GLOB '{p['reprocess_pattern']}'"""
    q["run_summary"] = f"""
SELECT CASE WHEN {todo} THEN CASE WHEN o_orderstatus <> 'F' THEN 'passed' ELSE 'failed' END
            WHEN o_orderstatus <> 'F' THEN 'skipped' ELSE 'failed_before' END AS status, count(*) AS files
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""
    return q


def _cells() -> dict[str, str]:
    from tessera import template as tpl
    from tessera.sources import fixture_cells as fc
    meta = tpl.get_template()["sections"]["evaluations_metadata"]
    kv_labels = [lab for lab in meta["key_value"] if lab != fc.OPTIONAL_LEFT_OUT]
    esc = lambda v: v.replace("'", "''")
    values = {"Rated entity": "c_name", "CorporateSector": "c_mktsegment", "Country of origin": "n_name",
              "Business risk profile": "o_orderpriority",
              "Market share": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)",
              "Accounting principles": f"CASE WHEN id % 17 <> 0 THEN '{fc.CONSTANT_VALUES['Accounting principles']}' END"}
    whens = " ".join(
        f"WHEN '{esc(lab)}' THEN {values.get(lab, repr(fc.CONSTANT_VALUES.get(lab, fc.DEFAULT_VALUE)))}"
        for lab in kv_labels)
    label_values = ", ".join(f"('{esc(lab)}')" for lab in kv_labels)
    base = f"""
WITH o AS (
  SELECT o_orderkey AS id, {FILENAME_SQL} AS filename, o_orderstatus, o_totalprice, o_orderpriority,
         c_name, c_mktsegment, n_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
files AS (SELECT *, sha256(filename || ':' || CAST(id AS VARCHAR)) AS file_hash FROM o),
valid AS (SELECT * FROM files WHERE id % 101 <> 0),
yrs AS (
  SELECT l_orderkey AS rid, CAST(year(l_shipdate) AS INTEGER) AS yr,
         sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS price
  FROM lineitem GROUP BY 1, 2),
ylists AS (
  SELECT rid,
         list(CAST(yr AS VARCHAR) || ({_list(fx.YEAR_SUFFIXES)})[CAST((rid + yr) % 8 AS INTEGER) + 1] ORDER BY yr) AS header,
         list(CAST(qty AS VARCHAR) ORDER BY yr) AS qty,
         list(CASE WHEN rid % 11 = 0 THEN '{fx.NOT_AVAILABLE}' ELSE CAST(price AS VARCHAR) END ORDER BY yr) AS price
  FROM yrs GROUP BY 1)"""
    q = {}
    q["cells_key_value"] = base + f"""
SELECT file_hash, filename, 'evaluations_metadata' AS section, l.label,
       CASE l.label {whens} END AS value
FROM valid CROSS JOIN (VALUES {label_values}) l(label)"""
    empty = "CAST([] AS VARCHAR[])"
    q["cells_named_list"] = base + f"""
SELECT file_hash, filename, section, label, to_json(vals) AS "values" FROM (
  SELECT file_hash, filename, 'evaluations_metadata' AS section, 'Rating methodologies applied' AS label,
         ['{fc.METHODOLOGY}'] AS vals FROM valid
  UNION ALL
  SELECT file_hash, filename, 'evaluations_metadata', 'Industry risk',
         CASE WHEN id % 9 = 0 THEN [c_mktsegment, NULL, '{fc.SECOND_INDUSTRY}'] ELSE [c_mktsegment] END FROM valid
  UNION ALL
  SELECT file_hash, filename, 'evaluations_metadata', 'Industry risk score',
         CASE WHEN id % 9 = 0 THEN ['{fc.DEFAULT_VALUE}', NULL, '{fc.SECOND_SCORE}'] ELSE ['{fc.DEFAULT_VALUE}'] END
  FROM valid
  UNION ALL
  SELECT file_hash, filename, 'evaluations_metadata', 'Industry weight',
         CASE WHEN id % 10 = 0 THEN {_list(fx.FAILED_WEIGHTS)} WHEN id % 10 = 1 THEN {empty}
              ELSE {_list(fx.GOOD_WEIGHTS)} END FROM valid
  UNION ALL
  SELECT file_hash, filename, 'credit_metrics', '{tpl.YEAR_HEADER}', COALESCE(y.header, {empty})
  FROM valid v LEFT JOIN ylists y ON y.rid = v.id
  UNION ALL
  SELECT file_hash, filename, 'credit_metrics', '{fc.QTY_LABEL}', COALESCE(y.qty, {empty})
  FROM valid v LEFT JOIN ylists y ON y.rid = v.id
  UNION ALL
  SELECT file_hash, filename, 'credit_metrics', '{fc.PRICE_LABEL}', COALESCE(y.price, {empty})
  FROM valid v LEFT JOIN ylists y ON y.rid = v.id) x"""
    q["cells_unexpected"] = base + f"""
SELECT file_hash, filename, 100 AS "row", 26 AS col, 'Z100' AS coord, o_orderstatus AS display
FROM valid WHERE o_orderstatus = 'F'
UNION ALL
SELECT file_hash, filename, 5, 1, 'A5', '{fc.NOTE}' FROM valid WHERE id % 13 = 0"""
    q["cells_required_missing"] = base + """
SELECT file_hash, filename, 'evaluations_metadata' AS section, 'Accounting principles' AS label
FROM valid WHERE id % 17 = 0"""
    q["extraction_error_kinds"] = base + """
SELECT kind, n_errors FROM (
  SELECT 'unexpected_cell' AS kind,
         (SELECT count(*) FROM valid WHERE o_orderstatus = 'F') + (SELECT count(*) FROM valid WHERE id % 13 = 0)
           AS n_errors
  UNION ALL SELECT 'missing_field', (SELECT count(*) FROM valid WHERE id % 17 = 0)
  UNION ALL SELECT 'invalid_sheet', (SELECT count(*) FROM files WHERE id % 101 = 0)) x
WHERE n_errors > 0"""
    from tessera.operators.extract import code_fingerprint
    t = tpl.get_template()
    text = lambda v: f"to_json({v})::VARCHAR"
    kv = " || ',' || ".join(
        f"'\"{esc(lab)}\":' || coalesce({text(values.get(lab, repr(fc.CONSTANT_VALUES.get(lab, fc.DEFAULT_VALUE))))}, 'null')" for lab in kv_labels)
    lists = {"Rating methodologies applied": f"['{fc.METHODOLOGY}']",
             "Industry risk": f"CASE WHEN id % 9 = 0 THEN [c_mktsegment, NULL, '{fc.SECOND_INDUSTRY}'] ELSE [c_mktsegment] END",
             "Industry risk score": f"CASE WHEN id % 9 = 0 THEN ['{fc.DEFAULT_VALUE}', NULL, '{fc.SECOND_SCORE}'] ELSE ['{fc.DEFAULT_VALUE}'] END",
             "Industry weight": f"CASE WHEN id % 10 = 0 THEN {_list(fx.FAILED_WEIGHTS)} WHEN id % 10 = 1 THEN {empty} ELSE {_list(fx.GOOD_WEIGHTS)} END"}
    metrics = {tpl.YEAR_HEADER: "header", fc.QTY_LABEL: "qty", fc.PRICE_LABEL: "price"}
    nl = " || ',' || ".join(f"'\"{esc(lab)}\":' || {text(lists[lab])}" for lab in meta["named_list"])
    cm = " || ',' || ".join(f"'\"{esc(lab)}\":' || {text(f'coalesce({metrics[lab]}, {empty})')}"
                            for lab in t["sections"]["credit_metrics"]["named_list"] if lab in metrics)
    messages = ", ".join(f"CASE WHEN {cond} THEN '{esc(msg)}' END" for cond, msg in (
        ("id % 13 = 0", f"Unexpected data point found in cell A5: '{fc.NOTE}'"),
        ("o_orderstatus = 'F'", "Unexpected data point found in cell Z100: 'F'"),
        ("id % 17 = 0", "Missing required field: 'Accounting principles' in section 'evaluations_metadata'")))
    q["payload_assembled"] = base + f""",
judged AS (
  SELECT f.*, y.header, y.qty, y.price, list_filter([{messages}], lambda x: x IS NOT NULL) AS errors,
         list_filter([CASE WHEN id % 13 = 0 THEN '"A5":' || {text(f"'{fc.NOTE}'")} END,
                      CASE WHEN o_orderstatus = 'F' THEN '"Z100":"F"' END], lambda x: x IS NOT NULL) AS stray
  FROM files f LEFT JOIN ylists y ON y.rid = f.id)
SELECT file_hash, filename,
       CASE WHEN id % 101 = 0 THEN 'invalid_sheet' ELSE 'parsed' END AS status,
       id % 101 <> 0 AND len(errors) = 0 AS data_quality_passed,
       CAST(CASE WHEN id % 101 = 0 THEN 1 ELSE len(errors) END AS INTEGER) AS n_errors,
       CASE WHEN id % 101 <> 0 THEN '{{"evaluations_metadata":{{' || {kv} || ',' || {nl} || '}},"credit_metrics":{{' || {cm}
         || '}},"unexpected_cells":{{' || array_to_string(stray, ',') || '}},"_meta":{{"filename":' || {text('filename')}
         || ',"schema_type":"{tpl.DEFAULT_TYPE}","schema_version":"{tpl.DEFAULT_VERSION}","schema_sha":"{tpl.template_sha(t)}","parser_sha":"{code_fingerprint()}"'
         || ',"data_quality_passed":' || CASE WHEN len(errors) = 0 THEN 'true' ELSE 'false' END
         || ',"data_quality_errors":' || {text('errors')} || '}}}}' END AS parsed_payload
FROM judged"""
    q["workbook_cells"] = base + _workbook_cells(meta, kv_labels, whens)
    good = "o_orderstatus <> 'F' AND id % 13 <> 0 AND id % 17 <> 0 AND id % 101 <> 0"
    nothing = ", ".join(f"CAST(NULL AS {t})" for t in ["VARCHAR"] * 6 + ["INTEGER"] * 2)
    q["landing_workbooks_available_now"] = base + f""",
good AS (SELECT * FROM files WHERE {good}),
last AS (
  SELECT rid, count(*) AS n, max(yr) FILTER (WHERE ({_list(fx.YEAR_SUFFIXES)})[CAST((rid + yr) % 8 AS INTEGER) + 1] IN ('', 'A')) AS yr
  FROM yrs GROUP BY 1)
SELECT 'published' AS state, c_name AS company_name, c_mktsegment AS corporate_sector, n_name AS country_of_origin,
       o_orderpriority AS business_risk_profile, '{fc.CONSTANT_VALUES['Reporting Currency/Units']}' AS reporting_currency,
       {_float('o_totalprice')} AS market_share, CAST(id % 5 + 1 AS INTEGER) AS version_id, CAST(yr AS INTEGER) AS max_actual_year,
       CAST(2 * coalesce(n, 0) AS BIGINT) AS n, CAST(1 AS BIGINT) AS n_current
FROM good LEFT JOIN last ON rid = id
UNION ALL SELECT 'passed', {nothing}, count(*), NULL FROM good
UNION ALL SELECT 'failed', {nothing}, count(*), NULL FROM files WHERE NOT ({good})
UNION ALL SELECT 'skipped', {nothing}, count(*), NULL FROM good WHERE id % {PARAMS['copied_every']} = 7"""
    return q


def _float(x: str) -> str:
    """A number cell's text after reading: that of a double."""
    return f"CAST(CAST({x} AS DOUBLE) AS VARCHAR)"


def _workbook_cells(meta: dict, kv_labels: list[str], whens: str) -> str:
    """All cells of the grids and of the typed sheet, by their layout rules."""
    from tessera import template as tpl
    from tessera.sources import fixture_cells as fc
    esc = lambda v: v.replace("'", "''")
    kv = ", ".join(f"('{esc(lab)}', {fc.KV_FIRST_ROW + i})" for i, lab in enumerate(meta["key_value"]) if lab in kv_labels)
    rows = {lab: fc.LIST_FIRST_ROW + i for i, lab in enumerate(meta["named_list"])}
    labels = ", ".join(f"('{esc(lab)}', {r})" for lab, r in [
        *rows.items(), (tpl.YEAR_HEADER, fc.HEADER_ROW), (fc.QTY_LABEL, fc.HEADER_ROW + 1), (fc.PRICE_LABEL, fc.HEADER_ROW + 2)])
    risk, score, weight = (rows[x] for x in ("Industry risk", "Industry risk score", "Industry weight"))
    texts = [f"SELECT id, r, 2, 'string', label FROM files, (VALUES {labels}) l(label, r)",
             f"SELECT id, {rows['Rating methodologies applied']}, 3, 'string', '{fc.METHODOLOGY}' FROM files",
             f"SELECT id, {risk}, 3, 'string', c_mktsegment FROM files",
             f"SELECT id, {risk}, 5, 'string', '{fc.SECOND_INDUSTRY}' FROM files WHERE id % 9 = 0",
             f"SELECT id, {score}, 3, 'string', '{fc.DEFAULT_VALUE}' FROM files",
             f"SELECT id, {score}, 5, 'string', '{fc.SECOND_SCORE}' FROM files WHERE id % 9 = 0",
             f"SELECT id, r, {fc.LOCKED_COL}, 'string', '{fc.LOCKED}' FROM files, range({fc.HEADER_ROW}, {fc.HEADER_ROW + 7}) x(r)",
             "SELECT id, 100, 26, 'string', o_orderstatus FROM files WHERE o_orderstatus = 'F'",
             f"SELECT id, 5, 1, 'string', '{fc.NOTE}' FROM files WHERE id % 13 = 0"]
    for k, (bad, fine) in enumerate(zip(fx.FAILED_WEIGHTS, fx.GOOD_WEIGHTS)):
        texts.append(f"SELECT id, {weight}, {3 + k}, 'number', CASE WHEN id % 10 = 0 THEN '{bad}' ELSE '{fine}' END FROM files WHERE id % 10 <> 1")
    grid = "\n  UNION ALL ".join(texts)
    span = "(id * 997 % 400000)"
    clock = lambda s, pad: (f"{pad.format(f'CAST({s} // 3600 AS VARCHAR)')} || ':' || lpad(CAST({s} // 60 % 60 AS VARCHAR), 2, '0')"  # noqa: E731
                            f" || ':' || lpad(CAST({s} % 60 AS VARCHAR), 2, '0')")
    text = fc.TYPED_TEXT.replace("'", "''")
    typed = f"""SELECT id, 1, 1, 'bool', CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END, CASE WHEN o_orderstatus = 'O' THEN 'True' ELSE 'False' END FROM files
  UNION ALL SELECT o_orderkey, 1, 2, 'date', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ' 00:00:00' FROM orders
  UNION ALL SELECT id, 1, 3, 'string', {clock('(id % 86400)', "lpad({}, 2, '0')")}, NULL FROM files
  UNION ALL SELECT id, 1, 4, 'string', CASE {span} // 86400 WHEN 0 THEN '' WHEN 1 THEN '1 day, ' ELSE CAST({span} // 86400 AS VARCHAR) || ' days, ' END
    || {clock(f'({span} % 86400)', '{}')}, NULL FROM files
  UNION ALL SELECT id, 2, 1, 'string', 'b', NULL FROM files
  UNION ALL SELECT id, 2, 27, 'string', '{text}', NULL FROM files"""
    return f""",
years AS (
  SELECT rid, yr, qty, price, 2 + row_number() OVER (PARTITION BY rid ORDER BY yr) AS c,
         ({_list(fx.YEAR_SUFFIXES)})[CAST((rid + yr) % 8 AS INTEGER) + 1] AS suffix FROM yrs),
kv AS (SELECT id, l.label, l.r, CASE l.label {whens} END AS value FROM files, (VALUES {kv}) l(label, r)),
grid(id, r, c, t, v) AS (
  {grid}
  UNION ALL SELECT id, r, 2, 'string', label FROM kv
  UNION ALL SELECT id, r, 3, CASE WHEN label = 'Market share' THEN 'number' ELSE 'string' END,
    CASE WHEN label = 'Market share' THEN {_float('TRY_CAST(value AS DOUBLE)')} ELSE value END FROM kv WHERE value IS NOT NULL
  UNION ALL SELECT rid, {fc.HEADER_ROW}, c, CASE WHEN suffix = '' THEN 'number' ELSE 'string' END, CAST(yr AS VARCHAR) || suffix FROM years
  UNION ALL SELECT rid, {fc.HEADER_ROW + 1}, c, 'number', {_float('qty')} FROM years
  UNION ALL SELECT rid, {fc.HEADER_ROW + 2}, c, CASE WHEN rid % 11 = 0 THEN 'string' ELSE 'number' END,
    CASE WHEN rid % 11 = 0 THEN '{fx.NOT_AVAILABLE}' ELSE {_float('price')} END FROM years),
typed(id, r, c, t, v, d) AS ({typed}),
sheets AS (SELECT id, CASE WHEN id % 101 = 0 THEN '{fc.WRONG_SHEET}' ELSE '{tpl.get_template()["sheet_name"]}' END AS sheet FROM files),
cells AS (
  SELECT id, sheet, r, c, t, v, v AS d FROM grid JOIN sheets USING (id)
  UNION ALL SELECT id, '{fc.TYPED_SHEET}', r, c, t, v, coalesce(d, v) FROM typed
  UNION ALL SELECT id, sheet, NULL, NULL, 'sheet', NULL, NULL FROM sheets
  UNION ALL SELECT id, '{fc.TYPED_SHEET}', NULL, NULL, 'sheet', NULL, NULL FROM files)
SELECT file_hash, filename, sheet, CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col,
       CASE WHEN c > 26 THEN chr(CAST(64 + (c - 1) // 26 AS INTEGER)) ELSE '' END || chr(CAST(65 + (c - 1) % 26 AS INTEGER)) || CAST(r AS VARCHAR) AS coord,
       t AS value_type, v AS value, d AS display
FROM cells JOIN files USING (id)"""
