"""Physical-plan properties that matter at scale: filters and column
pruning reach the Parquet scan; no nested-loop or cartesian joins."""

import pytest

from tessera.plans import pipeline, queries as Q, reports as R
from tessera.sources.fixture_ratings import raw_ratings
from conftest import SF_SMALL


def _plan(df) -> str:
    # scan metadata (PushedFilters, ReadSchema) is cut at 100 chars by default
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pub(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="tessera-plan-")
    raw_ratings(spark, SF_SMALL).write.parquet(f"{root}/raw")
    pipeline.run(spark, spark.read.parquet(f"{root}/raw"), f"{root}/wh")
    return pipeline.Published(spark, f"{root}/wh")


def test_snapshot_filters_reach_the_scan(pub):
    plan = _plan(Q.snapshots(pub.dim, from_date="1996-01-01", to_date="1998-12-31", sector="AUTOMOBILE"))
    assert "EqualTo(corporate_sector,AUTOMOBILE)" in plan
    assert "GreaterThanOrEqual(sys_valid_from" in plan and "LessThanOrEqual(sys_valid_from" in plan


def test_upload_list_does_not_read_payload(pub):
    plan = _plan(Q.uploads(pub.audits))
    assert "parsed_payload" not in plan


def test_no_cartesian_or_nested_loop_joins(pub):
    for df in [Q.compare(pub.details, None, business_year=1996), Q.company(pub.details, None),
               Q.company_history(pub.dim, pub.fct, None), Q.upload_stats(pub.audits),
               R.one_big_table(pub.dim, pub.fct)]:
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_detail_questions_filter_the_fact_before_nesting(pub):
    """Winner ids reach the fact below collect_list, and the answer is that
    of the nested view."""
    name = pub.dim.select("company_name").first()[0]
    for ask in (lambda d: Q.company(d, name), lambda d: Q.compare(d, [name], business_year=1996),
                lambda d: Q.compare(d, [name], as_of_date="1997-01-01 00:00:00"), lambda d: Q.company_version(d, name, 2)):
        lookup = ask(pub.lookup)
        lines = lookup._jdf.queryExecution().optimizedPlan().toString().splitlines()
        at = next(i for i, x in enumerate(lines) if "collect_list" in x)
        assert any("LeftSemi" in x for x in lines[at + 1:at + 4])
        assert sorted(map(str, lookup.collect())) == sorted(map(str, ask(pub.details).collect()))


def test_one_big_table_reads_one_partition(spark, tmp_root):
    from tessera.plans import reports as R
    from tessera.registry import warehouse
    w = warehouse(spark, SF_SMALL)
    R.write_one_big_table(w.dim, w.fct, f"{tmp_root}/obt")
    one = spark.read.parquet(f"{tmp_root}/obt").filter("metric_year = 1996")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "metric_year" in plan.split("PartitionFilters: [")[1].split("]")[0] and len(one.inputFiles()) >= 1
    assert one.count() == w.fct.filter("metric_year = 1996").count() > 0


def test_models_of_both_stagings_read_parsed_payloads(spark):
    """The dimension and the facts parse each payload once: they read a table
    of parsed payloads, not the raw rows."""
    from tessera.plans.marts import Warehouse
    w = Warehouse(raw_ratings(spark, SF_SMALL))
    plan = _plan(w.fct)
    assert "parsed-" in plan and "to_json" not in plan


def test_rules_on_payloads_do_not_parse_again(spark):
    """No filter holds a parse of the whole payload."""
    from tessera.plans.marts import stg_ratings
    plan = _plan(stg_ratings(spark.createDataFrame([(1, 1, "{}", None)], "id long, upload_id long, parsed_payload string, parsed_at timestamp_ntz")))
    filters = [line for line in plan.split("\n") if "Filter" in line]
    assert filters and not any("parsed_payload" in line for line in filters)


def test_chosen_rows_are_read_from_a_written_dimension(spark):
    """Detail questions choose from a table of the dimension and filter
    ratings before their metrics become rows; the narrow staging table gives
    the models that the payloads give."""
    from tessera.plans import marts
    from tessera.plans import queries as Q
    from tessera.plans.marts import Warehouse
    raw = raw_ratings(spark, SF_SMALL)
    raw = raw.unionByName(raw.filter("id % 5 = 0"))  # repeated keys
    w = Warehouse(raw)
    ask = w.lookup
    assert "dim-" in _plan(ask.rows) and "Window" not in _plan(ask.rows)
    plan = _plan(Q.compare(ask, None, business_year=1996))
    assert "Window" not in plan and "to_json" not in plan
    assert "parsed_payload" not in w.staged.columns
    metrics = marts.stg_metrics(raw)
    assert metrics.exceptAll(w.stg_metrics).isEmpty() and w.stg_metrics.exceptAll(metrics).isEmpty()
    years = marts.int_max_years(metrics).filter("max_actual_year IS NOT NULL")
    assert sorted(map(tuple, years.collect())) == sorted(map(tuple, marts.staged_max_years(w.staged).collect()))
    fct = marts.fct_metrics(metrics, marts.stg_ratings(raw))
    assert fct.exceptAll(w.fct).isEmpty() and w.fct.exceptAll(fct).isEmpty()
