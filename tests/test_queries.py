"""Query semantics: argument rule, AS OF, business year, point lookups."""

import pytest
from pyspark.sql import functions as F

from tessera.plans import queries as Q
from tessera.registry import warehouse
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse(spark, SF_SMALL)


def test_compare_needs_a_point(wh):
    with pytest.raises(ValueError):
        Q.compare(wh.details, ["x"])
    with pytest.raises(ValueError):
        Q.compare(wh.details, ["x"], business_year=0)


def test_as_of_returns_at_most_one_row_per_company(wh):
    names = [r.company_name for r in wh.dim.select("company_name").distinct().limit(5).collect()]
    res = Q.compare(wh.details, names, as_of_date="1998-01-01 00:00:00")
    assert res.groupBy("company_name").count().filter("count > 1").count() == 0
    assert set(r.company_name for r in res.collect()) <= set(names)


def test_business_year_filters_metrics(wh):
    res = Q.compare(wh.details, None, business_year=1996)
    bad = res.select(F.explode("metrics").alias("m")).filter("m.year IS NOT NULL AND m.year <> 1996")
    assert bad.count() == 0
    assert res.groupBy("company_name").count().filter("count > 1").count() == 0


def test_point_lookups(spark, wh):
    name = wh.dim.select("company_name").orderBy("company_name").first().company_name
    assert Q.company(wh.details, name).count() == 1
    versions = Q.company_versions(wh.dim, name).collect()
    assert versions == sorted(versions, key=lambda r: (r.sys_valid_from, r.id), reverse=True)
    assert Q.snapshot(wh.details, versions[0].id).count() == 1
    assert Q.upload(wh.audits, str(versions[0].id)).count() == 1
    page = Q.snapshots_page(wh.dim, 0, 10).collect()
    assert len(page) == 10
