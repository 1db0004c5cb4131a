"""Benchmark: the daily warehouse build plus the dashboard metrics.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs bronze -> silver (written) -> skills (written) -> gold tables (written) -> metrics,
plus the landing ingest and page cleaning, and prints ONE JSON line. With
BENCH_DUCKDB=1 the same oracle SQL is also timed on DuckDB (single node) as the
reference point (``reference_duckdb``).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def main() -> None:
    from pyspark.sql import functions as F

    from hirelake import catalog
    from hirelake.operators import metrics as J
    from hirelake.plans import gold as G
    from hirelake.plans.postings import bronze_from_documents
    from hirelake.plans.silver import silver_job_skills, silver_jobs
    from hirelake.session import build_session, drop_scratch, scratch_path
    from hirelake.sources.bronze import materialize
    from hirelake.sources.tables import read_table
    from hirelake.sources.taxonomy import read_taxonomy

    extra = {"spark.driver.memory": "16g"}
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="hl-bench-")
    spark = build_session(f"local[{CPUS}]", app="hirelake-bench",
                          shuffle_partitions=max(8, CPUS * 2), extra=extra)
    spark.sparkContext.setLogLevel("ERROR")

    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    # Warm-up (reported as warmup_sec, not part of value): one pass of silver and skills
    # over the smallest test tables, so the timed steps measure throughput rather than
    # JVM class loading and the first compilation of the wide classifier stage.
    t0 = time.time()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        warm = silver_jobs(bronze_from_documents(read_table(spark, warm_dir, "documents")))
        run(warm)
        run(silver_job_skills(catalog.Star(spark, warm_dir).silver, read_taxonomy(spark)))
    else:
        run(read_table(spark, SF_DIR, "region"))
    warmup = round(time.time() - t0, 3)

    star = catalog.Star(spark, SF_DIR)  # the layers as the registered queries build them
    silver = timed("silver_jobs", lambda: star.silver)
    skills = timed("silver_job_skills", lambda: star.skills)

    def gold():
        return {
            "fact": materialize(G.fct_job_postings(silver), scratch_path(spark, "fact")),
            "companies": materialize(G.dim_companies(silver), scratch_path(spark, "companies")),
            "dim_skills": materialize(G.dim_skills(skills), scratch_path(spark, "dim_skills")),
            "bridge": materialize(G.bridge_job_skills(skills), scratch_path(spark, "bridge")),
        }
    g = timed("gold_tables", gold)
    timed("skill_demand", lambda: run(J.skill_demand(g["bridge"], g["dim_skills"], 10)))
    timed("median_salary_by_role", lambda: run(J.median_salary_by_role(g["fact"])))
    timed("remote_share", lambda: run(J.remote_share(g["fact"], ["search_role", "platform_name"])))
    timed("highest_paying_skills",
          lambda: run(J.highest_paying_skills(g["fact"], g["bridge"], g["dim_skills"])))
    timed("star_query", lambda: run(
        G.star_query(g["fact"], g["companies"], G.dim_date(spark), g["bridge"], g["dim_skills"])
        .groupBy("search_role", "year", "skill_name").agg(F.countDistinct("job_id"))))
    from hirelake.operators.dedup import cross_source_dedup
    timed("cross_source_dedup", lambda: run(cross_source_dedup(silver)))
    for name in ("html_clean", "first_seen_dedup", "landing_roundtrip", "latest_posting",
                 "landing_rejects", "insert_only_merge", "collection_counters", "envelope_wrap"):
        timed(name, lambda n=name: run(catalog.QUERIES[n](spark, SF_DIR)))

    result = {"metric": "warehouse_build_and_metrics", "value": round(sum(times.values()), 3),
              "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")),
              "cpus": CPUS, "warmup_sec": warmup}

    if os.environ.get("BENCH_DUCKDB") == "1":
        import duckdb
        from hirelake.sources.tables import TABLES
        con = duckdb.connect()
        con.execute(f"SET threads = {CPUS}")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
        ref = {}
        for name in ("silver_jobs", "skill_match", "fct_job_postings", "skill_demand",
                     "median_salary_by_role", "html_clean", "first_seen_dedup"):
            t = time.time()
            # a full materialization: a count(*) would let DuckDB skip the projections
            con.execute(f"CREATE OR REPLACE TEMP TABLE _ref AS {catalog.ORACLE[name]}")
            ref[name] = round(time.time() - t, 3)
        result["reference_duckdb"] = ref
    drop_scratch(spark)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
