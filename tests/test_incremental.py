"""Versioned tables, upserts, watermark loads, layered publish."""

from pyspark.sql import functions as F

from tessera.operators import incremental
from tessera.operators.incremental import VersionedTable, after_watermark, dedupe_newest
from tessera.plans import pipeline
from tessera.sources.fixture_ratings import raw_ratings
from conftest import SF_SMALL


def test_upsert_replaces_by_key_and_dedupes_batch(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t")
    assert t.read() is None and t.current_version() is None
    t.publish(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, ts int"))
    batch = spark.createDataFrame([(2, "b2", 2), (2, "b3", 3), (3, "c", 1)], "k int, v string, ts int")
    t.upsert(batch, ["k"], ["ts"])
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "a", 1), (2, "b3", 3), (3, "c", 1)]
    assert t.current_version() == 2
    # an uncommitted write stays invisible
    v = t.write(spark.createDataFrame([(9, "x", 9)], "k int, v string, ts int"))
    assert t.current_version() == 2 and t.read().count() == 3
    t.commit(v)
    assert t.read().count() == 1
    # adding new keys only appends one part
    assert t.upsert(spark.createDataFrame([(10, "y", 1)], "k int, v string, ts int"), ["k"], ["ts"]) == "append"
    assert len(t.parts()) == 2 and t.read().count() == 2


def test_compaction(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/c", max_parts=3)
    for i in range(5):
        t.append(spark.createDataFrame([(i,)], "k int"))
    assert len(t.parts()) <= 3 and sorted(r.k for r in t.read().collect()) == list(range(5))


def test_merging_by_levels_reads_no_row_more_than_once_a_level(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/c", max_parts=2)
    sizes = []
    new_part = t._new_part

    def counted(df, v, by, level=0):
        name = new_part(df, v, by, level)
        sizes.append((level, spark.read.parquet(f"{t.path}/{name}").count()))
        return name
    t._new_part = counted
    for i in range(14):
        t.append(spark.createDataFrame([(i,)], "k int"))
    assert sorted(r.k for r in t.read().collect()) == list(range(14))
    for level in {lv for lv, _ in sizes}:
        assert sum(n for lv, n in sizes if lv == level) <= 14
    assert max(lv for lv, _ in sizes) == 2  # 3 parts make one, 9 rows one of the next level


def test_upsert_of_neighbouring_keys_rewrites_few_files(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/u")
    rows = spark.range(200_000).select("id", F.lit("first").alias("v"), F.lit(1).alias("ts"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for lo in range(0, 200_000, 50_000):
            assert t.upsert(rows.filter(F.col("id").between(lo, lo + 49_999)), ["id"], ["ts"]) == "append"
        before = set(t.read().inputFiles())
        assert len(before) >= 32
        new = spark.range(60_000, 62_000).select("id", F.lit("second").alias("v"), F.lit(2).alias("ts"))
        assert t.upsert(new, ["id"], ["ts"]) == "rewrite"
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(t.rewritten) <= 0.1 * len(before)
    assert len(before & set(t.read().inputFiles())) == len(before) - len(t.rewritten)
    got = t.read().groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b"))
    assert sorted(map(tuple, got.collect())) == [("first", 198_000, 0, 199_999), ("second", 2_000, 60_000, 61_999)]
    # the version before is still there as it was
    assert t.read_version(t.current_version() - 1).filter("v = 'second'").count() == 0


def test_search_for_replaced_keys_is_pushed_to_the_scan(spark, tmp_root, capsys):
    t = VersionedTable(spark, f"{tmp_root}/p")
    t.upsert(spark.createDataFrame([(i, "a", 1) for i in range(50)], "k int, g string, ts int"), ["k", "g"], ["ts"])
    seen = []
    DataFrame = type(t.read())
    plain = DataFrame.distinct
    DataFrame.distinct = lambda self: (seen.append(self), plain(self))[1]
    try:
        t.upsert(spark.createDataFrame([(7, "a", 2), (9, "a", 2)], "k int, g string, ts int"), ["k", "g"], ["ts"])
    finally:
        DataFrame.distinct = plain
    seen[0].explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(k,7)" in plan and "LessThanOrEqual(k,9)" in plan


def test_upserts_in_any_order_equal_a_dictionary(spark, tmp_root):
    import random
    rnd = random.Random(5)
    t = VersionedTable(spark, f"{tmp_root}/r", max_parts=2)
    want, nulls = {}, 0
    for step in range(9):
        batch = [(rnd.randrange(40), rnd.choice(["x", "y"]), step, rnd.randrange(3)) for _ in range(rnd.choice([0, 3, 25]))]
        if step % 4 == 1:  # keys with a NULL are never replaced
            batch.append((None, "x", step, 0))
            nulls += 1
        t.upsert(spark.createDataFrame(batch, "k int, g string, step int, ts int"), ["k", "g"], ["ts"])
        top = {}
        for k, g, s, ts in batch:
            if k is not None:
                top[(k, g)] = max(ts, top.get((k, g), ts))
        want.update({key: (step, ts) for key, ts in top.items()})
    got = t.read().collect()
    assert {(r.k, r.g): (r.step, r.ts) for r in got if r.k is not None} == want
    assert len(got) == len(want) + nulls


def test_watermark_is_strict(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-02 00:00:00",)], "ts string").select(
        F.col("ts").cast("timestamp_ntz").alias("ts"))
    import datetime as dt
    assert after_watermark(df, "ts", dt.datetime(2024, 1, 1)).count() == 1


def test_pipeline_incremental_equals_full_and_rerun_is_noop(spark, tmp_root):
    raw = raw_ratings(spark, SF_SMALL)
    raw.write.parquet(f"{tmp_root}/raw")
    raw = spark.read.parquet(f"{tmp_root}/raw")
    assert not pipeline.run(spark, raw.filter("parsed_at < '1997-06-01'"), f"{tmp_root}/inc")["incremental"]
    assert pipeline.run(spark, raw, f"{tmp_root}/inc")["incremental"]
    assert pipeline.run(spark, raw, f"{tmp_root}/inc")["incremental"]
    pipeline.run(spark, raw, f"{tmp_root}/full")
    inc, full = pipeline.Published(spark, f"{tmp_root}/inc"), pipeline.Published(spark, f"{tmp_root}/full")
    for name in ["dim", "fct", "stg_metrics", "audits"]:
        a, b = getattr(inc, name), getattr(full, name)
        b = b.select(*a.columns)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, name
    assert inc.tables["dim"].current_version() == 2  # the re-run changed nothing


def test_dim_properties(spark):
    from tessera.registry import warehouse
    dim = warehouse(spark, SF_SMALL).dim
    # exactly one open interval per company, intervals never overlap
    assert dim.groupBy("company_name").agg(F.sum(F.col("is_system_current").cast("int")).alias("n")) \
        .filter("n <> 1").count() == 0
    assert dim.filter("sys_valid_to IS NOT NULL AND sys_valid_to < sys_valid_from").count() == 0
    # one latest flag per (company, business year)
    assert dim.filter("is_latest_version_for_business_year").groupBy("company_name", "max_actual_year") \
        .count().filter("count <> 1").count() == 0


def test_dim_with_companies_over_many_ranges_equals_one_range(spark, monkeypatch):
    """LEAD/LAG/forward fill over one range and over 60 (companies span
    several): the models built on them do not change."""
    from tessera.operators import windows
    from tessera.plans import queries as Q, reports as R
    from tessera.registry import warehouse
    from tessera.plans.payload import parse_payload
    def build():
        w = warehouse(spark, SF_SMALL)
        probes = parse_payload(w.raw).select("upload_id", F.col("_em")["Rated entity"].alias("company_name"),
                                             F.col("parsed_at").alias("probe_at"))
        return (w.dim.select("id", "sys_valid_to", "is_system_current").collect(),
                R.change_only_history(w.dim).collect(), Q.as_of_probes(w.dim, probes).collect())
    ranged = windows._ranged
    monkeypatch.setattr(windows, "_ranged", lambda df, key, order, n: ranged(df, key, order, 1))
    plain = build()
    monkeypatch.setattr(windows, "_ranged", lambda df, key, order, n: ranged(df, key, order, 60))
    sliced = build()
    for a, b in zip(plain, sliced):
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_safe_watermark_keeps_rows_sharing_the_last_timestamp(spark):
    from tessera.operators.incremental import at_or_after_watermark
    import datetime as dt
    loaded = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "id int, ts string").select(
        "id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    batch = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:00"),
                                   (3, "2023-12-31 00:00:00")], "id int, ts string").select(
        "id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    wm = dt.datetime(2024, 1, 1)
    assert after_watermark(batch, "ts", wm).count() == 0  # the reference's strict '>' skips id 2
    assert [r.id for r in at_or_after_watermark(batch, "ts", wm, loaded, ["id"]).collect()] == [2]


def test_malformed_list_is_quarantined(spark):
    import json
    from tessera.plans import marts as M
    good = {"evaluations_metadata": {"Rated entity": "A", "Industry weight": ["0.5", "0.5"]},
            "credit_metrics": {}, "_meta": {"data_quality_passed": True, "filename": "a_1.xlsm"}}
    bad = json.loads(json.dumps(good))
    bad["evaluations_metadata"]["Industry weight"] = "0.5"
    raw = spark.createDataFrame([(1, 1, json.dumps(good), "2024-01-01 00:00:00"),
                                 (2, 2, json.dumps(bad), "2024-01-02 00:00:00")],
                                "id long, upload_id long, parsed_payload string, parsed_at string").withColumn(
        "parsed_at", F.col("parsed_at").cast("timestamp_ntz"))
    assert [r.id for r in M.stg_ratings(raw).collect()] == [1]
    flags = {r.upload_id: r.payload_well_formed for r in M.upload_audits(raw).collect()}
    assert flags == {1: True, 2: False}


def test_upsert_evaluates_its_batch_once(spark, tmp_root):
    """Clustering by key reads the batch for its ranges and for its rows; the
    batch itself runs once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf
    batch = spark.range(1000).repartition(4).mapInPandas(count, "id long")
    VersionedTable(spark, f"{tmp_root}/once").upsert(batch, ["id"], ["id"])
    assert seen.value == 1000


def test_upsert_looks_for_the_newest_row_only_if_a_key_is_repeated(spark, tmp_root, monkeypatch):
    calls = []
    monkeypatch.setattr(incremental, "dedupe_newest", lambda *a: calls.append(1) or dedupe_newest(*a))
    t, schema = VersionedTable(spark, f"{tmp_root}/once"), "k int, j string, v string, ts int"
    keys = ["k", "j"]
    t.upsert(spark.createDataFrame([(1, "a", "x", 1), (1, "b", "y", 1), (None, "a", "z", 1)], schema), keys, ["ts"])
    t.upsert(spark.createDataFrame([(1, "b", "y2", 2), (2, None, "w", 1)], schema), keys, ["ts"])
    assert not calls
    t.upsert(spark.createDataFrame([(2, "a", "old", 1), (2, "a", "new", 2), (3, None, "old", 1), (3, None, "new", 2)], schema), keys, ["ts"])
    assert calls == [1]
    assert sorted(map(str, t.read().collect())) == sorted(map(str, spark.createDataFrame(
        [(1, "a", "x", 1), (1, "b", "y2", 2), (None, "a", "z", 1), (2, None, "w", 1), (2, "a", "new", 2), (3, None, "new", 2)], schema).collect()))
    names = [x.getPath().getName() for x in t._fs.listStatus(t._Path(t.path))]
    assert not [n for n in names if n.startswith("_batch")]
