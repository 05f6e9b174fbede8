"""Benchmark: builds the warehouse from the driver tables at $BENCH_SF_DIR
on local[$BENCH_CPUS] and times the headline queries over the published
marts. Prints one JSON line.

The suite runs twice on fresh folders: ``queries`` holds the warm run
(``value`` is its total), ``first_run`` the cold one (JVM and Python
workers starting, code generation). Stages timed: raw payload build (written), layered publish of the rows
parsed before DAILY_CUT (staging upserts, intermediate, marts,
assertions), the remaining rows as one incremental daily batch (appends,
dimension recomputed for touched companies), deriving the sheet cell grids
from the tables (stand-in for decoded workbooks), template extraction from the
derived sheet grids, then each query over the published tables (executed
fully with the ``noop`` sink; nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.session import checkpoint_dir, local_session  # noqa: E402


DAILY_CUT = "2001-01-01 00:00:00"  # rows parsed later form the increment (~12%)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="tessera-bench")
    from tessera.session import size_shuffle_partitions
    from tessera.sources.tables import TABLES, table_path
    size_shuffle_partitions(spark, [table_path(sf_dir, t) for t in TABLES], minimum=int(cpus) * 2)
    import uuid
    # scratch tables under the session's shared checkpoint folder
    root = f"{checkpoint_dir(spark).rstrip('/')}/tessera-bench-{uuid.uuid4().hex}"

    from pyspark.sql import functions as F
    from tessera.operators.extract import Extraction
    from tessera.plans import pipeline, quality, queries as Q, reports as R
    from tessera.registry import PARAMS
    from tessera.sources.fixture_cells import cell_grid
    from tessera.sources.fixture_ratings import raw_ratings

    def suite(root: str) -> dict[str, float]:
        times: dict[str, float] = {}

        def timed(name, fn):
            t0 = time.time()
            fn()
            times[name] = round(time.time() - t0, 3)

        def run(df):
            df.write.format("noop").mode("overwrite").save()

        timed("build_raw_payloads", lambda: raw_ratings(spark, sf_dir).write.parquet(f"{root}/raw"))
        raw = spark.read.parquet(f"{root}/raw")
        # initial load up to the cut, then the rest as one daily increment
        cut = F.col("parsed_at") < F.lit(DAILY_CUT).cast("timestamp_ntz")
        timed("publish_warehouse", lambda: pipeline.run(spark, raw.filter(cut), f"{root}/wh"))
        timed("publish_daily_increment", lambda: pipeline.run(spark, raw, f"{root}/wh"))
        wh = pipeline.Published(spark, f"{root}/wh")
        # the sheet grids derived from the tables stand in for decoded workbooks
        timed("derive_cell_grid", lambda: cell_grid(spark, sf_dir).write.parquet(f"{root}/cells"))
        timed("extract_payloads", lambda: run(Extraction(spark.read.parquet(f"{root}/cells")).payloads()))
        details = wh.details
        qs = {
            "snapshots_latest": lambda: Q.snapshots_latest(wh.dim),
            "companies_current": lambda: Q.companies(wh.dim),
            "compare_as_of": lambda: Q.compare(details, None, as_of_date=PARAMS["as_of"]),
            "compare_business_year": lambda: Q.compare(details, None, business_year=PARAMS["business_year"]),
            "company_latest": lambda: Q.company(details, None),
            "company_history": lambda: Q.company_history(wh.dim, wh.fct, None),
            "company_versions": lambda: Q.company_versions(wh.dim, None),
            "snapshots_filtered": lambda: Q.snapshots(wh.dim, from_date=PARAMS["from_date"],
                                                      to_date=PARAMS["to_date"], sector=PARAMS["sector"]),
            "company_details": lambda: details,
            "upload_stats_by_day": lambda: Q.upload_stats(wh.audits),
            "dq_configured": lambda: quality.summary(quality.configured_tests(wh)),
            "scd_change_only": lambda: R.change_only_history(wh.dim),
            "one_big_table": lambda: R.one_big_table(wh.dim, wh.fct),
        }
        for name, build in qs.items():
            timed(name, lambda b=build: run(b()))
        return times

    first = suite(f"{root}/cold")
    times = suite(f"{root}/warm")
    wh = pipeline.Published(spark, f"{root}/warm/wh")
    raw = spark.read.parquet(f"{root}/warm/raw")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "first_run": {"total": round(sum(first.values()), 3), "queries": first},
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": int(cpus),
                      "rows": {"raw": raw.count(), "dim": wh.dim.count(), "fct": wh.fct.count()}}))
    spark.stop()


if __name__ == "__main__":
    main()
