"""Column functions: year types, safe casts, version numbers, rounding."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import columns as C
from tessera import template as tpl


@pytest.mark.parametrize("text,typ,year", [
    ("2024", "Actual", 2024), ("2024A", "Actual", 2024), (" 2024 ", "Actual", None),
    ("N/A", "Actual", None), ("2025E", "Estimate", 2025), ("2025P", "Pro-forma", 2025),
    ("2023R", "Restated", 2023), ("2024PF", "Forecast", 2024), ("2026F", "Forecast", 2026),
    ("2024Q", "Unknown", 2024), ("2024.0", "Unknown", 2024), ("2024\n", "Unknown", 2024), (None, "Unknown", None),
])
def test_year_type(spark, text, typ, year):
    r = spark.createDataFrame([(text,)], "t string").select(
        C.year_type("t").alias("y"), C.leading_int("t").alias("n")).first()
    assert r.y == typ and r.n == year


@pytest.mark.parametrize("text,ok", [("1.5", True), ("-2", True), ("n.a.", False), ("+5", False),
                                     (".5", False), ("", False), ("1.", False), ("3\n", False)])
def test_safe_numeric(spark, text, ok):
    v = spark.createDataFrame([(text,)], "t string").select(C.safe_numeric("t").alias("v")).first().v
    assert (v is not None) == ok


@pytest.mark.parametrize("name,v", [("corporates_A_2.xlsm", 2), ("corporates-7.xlsm", None),
                                    ("x_2024.xlsm", 2024), ("a_99999999999.xlsm", None), ("a_1.b.xlsm", None)])
def test_version_from_filename(spark, name, v):
    r = spark.createDataFrame([(name,)], "f string").select(C.version_from_filename("f").alias("v")).first()
    assert r.v == v


def test_round_half_away_from_zero(spark):
    rows = spark.createDataFrame([("1.00005",), ("-1.00005",)], "t string").select(
        C.round4(C.safe_numeric("t")).cast("string").alias("r")).collect()
    assert [r.r for r in rows] == ["1.0001", "-1.0001"]


def test_uri_parts(spark):
    r = spark.createDataFrame([("s3://archive/abc_corporates_A_1.xlsm",)], "p string").select(
        C.uri_bucket("p").alias("b"), C.uri_key("p").alias("k"), C.display_name(C.uri_key("p")).alias("n")).first()
    assert (r.b, r.k, r.n) == ("archive", "abc_corporates_A_1.xlsm", "corporates_A_1.xlsm")


def test_template_lint():
    assert tpl.lint_template(tpl.get_template()) == []
    bad = {"sheet_name": "", "sections": {"s": {"range": "Z9:A1", "key_value": [""], "optional_keys": ["q"]}}}
    problems = tpl.lint_template(bad)
    assert len(problems) >= 3
    assert tpl.range_bounds("C1:I34") == (3, 1, 9, 34)
    assert tpl.range_bounds("M35:M41") == (13, 35, 13, 41)
    assert tpl.range_bounds("C:D") == (3, None, 4, None)
    assert len(tpl.template_sha(tpl.get_template())) == 64


@pytest.mark.parametrize("col,row,coord", [(1, 1, "A1"), (26, 100, "Z100"), (27, 5, "AA5"), (702, 2, "ZZ2"),
                                           (703, 3, "AAA3"), (16384, 7, "XFD7")])
def test_a1_coord(spark, col, row, coord):
    r = spark.createDataFrame([(col, row)], "c int, r int").select(C.a1_coord("c", "r").alias("a")).first()
    assert r.a == coord
