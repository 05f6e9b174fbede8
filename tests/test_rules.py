"""Data rules: every kind and source, empty and odd payloads."""

import json

import pytest

from tessera import template as tpl
from tessera.plans import rules as X
from tessera.plans.rules import Rule

RULES = [
    Rule("name", X.TEXT, "Rated entity", required=True),
    Rule("end", X.DATE, "End of business year", low="2020-01-01"),
    Rule("share", X.NUMBER, "Market share", low="0", high="1"),
    Rule("score", X.MEMBER, "Industry risk score", X.LIST, members=("A", "B")),
    Rule("year", X.PATTERN, "year", X.YEARS, required=True, pattern="[0-9]{4}"),
    Rule("metric", X.NUMBER, source=X.METRICS),
]


def payloads(spark, *pairs):
    rows = [(i, i, json.dumps({"evaluations_metadata": em, "credit_metrics": cm, "_meta": {"filename": f"f{i}"}}))
            for i, (em, cm) in enumerate(pairs, 1)]
    return spark.createDataFrame(rows, "id long, upload_id long, parsed_payload string")


def test_kinds_sources_and_counts(spark):
    raw = payloads(
        spark,
        ({"Rated entity": "A", "End of business year": "2024-12-31", "Market share": "0.5", "Industry risk score": ["A", "B"]},
         {tpl.YEAR_HEADER: ["2023", "2024"], "m": ["1", "-2.5"]}),
        ({"Rated entity": " ", "End of business year": "2019-12-31", "Market share": "1e99", "Industry risk score": ["A", "Z", None]},
         {tpl.YEAR_HEADER: ["2023\n", None], "m": ["n.a.", None]}),
        ({}, {}))
    bad = {(r.upload_id, r.rule, r.field, r.position, r.verdict) for r in X.violations(raw, RULES).collect()}
    assert bad == {(2, "name", "Rated entity", 1, "missing"), (2, "end", "End of business year", 1, "invalid"),
                   (2, "share", "Market share", 1, "invalid"), (2, "score", "Industry risk score", 2, "invalid"),
                   (2, "year", "year", 1, "invalid"), (2, "year", "year", 2, "missing"), (2, "metric", "m", 1, "invalid"),
                   (3, "name", "Rated entity", 1, "missing")}
    report = {r.upload_id: (r.n_valid, r.n_invalid, r.n_missing, r.completeness, r.validity) for r in X.file_report(raw, RULES).collect()}
    assert report == {1: (9, 0, 0, 1.0, 1.0), 2: (1, 5, 2, 0.333333, 0.166667), 3: (0, 0, 1, 0.0, None)}


def test_plan_has_no_shuffle_and_broken_rules_raise(spark):
    raw = payloads(spark, ({}, {}))
    plan = X.violations(raw, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert X.file_report(raw.filter("false"), RULES).count() == 0
    with pytest.raises(ValueError, match="unknown kind"):
        X.file_report(raw, [Rule("x", "shape", "Rated entity")])
