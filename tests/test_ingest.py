"""Landing lake, natural keys, insert-only merge."""

import json
import os

from pyspark.sql import functions as F

from hirelake.operators.merge import insert_only_merge, load_audit, new_rows
from hirelake.sources.landing import landing_rows, read_landing, split_corrupt, write_landing


def _envelope_lake(root):
    day = os.path.join(root, "adzuna", "austria", "2026", "04", "01")
    os.makedirs(day)
    env = {"extracted_at": "2026-04-01T06:00:00.123456", "source": "adzuna", "country": "austria",
           "keyword": "Backend", "total_records": 5,
           "jobs": [{"id": "a1", "title": "t"}, {"id": 0, "slug": "s0"}, {"id": "", "title": "no id"},
                    {"id": False}, {"id": "0"}]}
    with open(os.path.join(day, "backend_jobs.json"), "w") as fh:
        json.dump(env, fh, indent=4)
    with open(os.path.join(day, "cloud_jobs.json"), "w") as fh:
        fh.write("{ not json")
    other = os.path.join(root, "jooble", "austria", "2026", "04", "02")
    os.makedirs(other)
    with open(os.path.join(other, "cloud_jobs.json"), "w") as fh:
        json.dump({**env, "source": "jooble"}, fh, indent=4)


def test_envelope_files(spark, tmpdir_path):
    _envelope_lake(tmpdir_path)
    good, bad = split_corrupt(read_landing(spark, tmpdir_path, "2026-04-01", layout="plain"))
    assert bad.count() == 1 and good.count() == 1
    rows = landing_rows(spark, tmpdir_path, "2026-04-01", layout="plain")
    got = sorted(r["job_id"] for r in rows.collect())
    assert got == ["0", "a1", "s0"]     # "" / false / 0 fall through to slug; the string "0" is kept


def test_write_read_and_overwrite(spark, tmpdir_path):
    jobs = spark.createDataFrame([("adzuna", "austria", "Backend", '{"id":"1"}'),
                                  ("adzuna", "austria", "Cloud", '{"id":"2"}')],
                                 "source string, country string, keyword string, js string") \
        .withColumn("raw_data", F.parse_json("js")).drop("js")
    ts = F.lit("2026-04-01 06:00:00").cast("timestamp")
    write_landing(jobs, tmpdir_path, extracted_at=ts)
    assert landing_rows(spark, tmpdir_path, "2026-04-01").count() == 2
    # rerun of the same day and keyword replaces only that keyword's files
    again = jobs.filter(F.col("keyword") == "Backend").withColumn("raw_data", F.parse_json(F.lit('{"id":"9"}')))
    write_landing(again, tmpdir_path, extracted_at=ts)
    got = sorted(r["job_id"] for r in landing_rows(spark, tmpdir_path, "2026-04-01").collect())
    assert got == ["2", "9"]


def test_insert_only_merge_idempotent(spark, tmpdir_path):
    batch = spark.createDataFrame([("1", "s", "f", 0), ("1", "s", "f", 1), ("2", "s", "f", 2)],
                                  "job_id string, source string, _source_file string, _source_pos long")
    target = os.path.join(tmpdir_path, "bronze")
    assert insert_only_merge(target, batch).count() == 2
    assert insert_only_merge(target, batch).count() == 2       # second load adds nothing
    kept = spark.read.parquet(target).filter(F.col("job_id") == "1").first()
    assert kept["_source_pos"] == 0                            # first duplicate wins
    audit = load_audit(batch, new_rows(spark.read.parquet(target), batch)).first()
    assert (audit["batch_records"], audit["new_records"], audit["skipped_records"]) == (3, 0, 3)


def test_stream_ingest_available_now(spark, tmpdir_path):
    from hirelake.streaming.ingest import ingest_available
    jobs = spark.createDataFrame([("adzuna", "austria", "Backend", '{"id":"1"}'),
                                  ("jooble", "austria", "Cloud", '{"id":7}'),
                                  ("jooble", "austria", "Cloud", '{"id":0}')],
                                 "source string, country string, keyword string, js string") \
        .withColumn("raw_data", F.parse_json("js")).drop("js")
    land = f"{tmpdir_path}/landing"
    write_landing(jobs, land, extracted_at=F.lit("2026-04-01 06:00:00").cast("timestamp"))
    bronze = ingest_available(spark, land, f"{tmpdir_path}/bronze", f"{tmpdir_path}/ckpt")
    assert sorted((r["job_id"], r["source"]) for r in bronze.collect()) == [("1", "adzuna"), ("7", "jooble")]
    # a new day: only the new file is read; an already loaded key is not inserted again
    more = jobs.filter(F.col("source") == "adzuna").unionByName(
        spark.createDataFrame([("arbeitnow", "austria", "DevOps")], "source string, country string, keyword string")
        .withColumn("raw_data", F.parse_json(F.lit('{"slug":"x-1"}'))))
    write_landing(more, land, extracted_at=F.lit("2026-04-02 06:00:00").cast("timestamp"))
    bronze = ingest_available(spark, land, f"{tmpdir_path}/bronze", f"{tmpdir_path}/ckpt")
    assert bronze.count() == 3
    # replaying with a fresh checkpoint (all files again) adds nothing
    bronze = ingest_available(spark, land, f"{tmpdir_path}/bronze", f"{tmpdir_path}/ckpt2")
    assert bronze.count() == 3


def test_faulty_records_are_reported(spark, tmpdir_path):
    """Cut off, repeated key, no source, bad date, no key: all reported or loaded, none lost."""
    from hirelake.sources.landing import judged_rows
    day = os.path.join(tmpdir_path, "adzuna", "austria", "2026", "04", "01")
    os.makedirs(day)
    env = {"extracted_at": "2026-04-01T06:00:00", "source": "adzuna", "country": "austria", "keyword": "Backend",
           "total_records": 2, "jobs": [{"id": "a1", "title": "t"}, {"id": "a2", "title": "u"}]}
    whole = json.dumps(env, indent=1)

    def put(name, text):
        with open(os.path.join(day, name), "w") as fh:
            fh.write(text)
    put("good.json", whole)
    put("cut.json", whole[:-30])
    put("twice.json", whole.replace('"title": "t"', '"title": "t", "title": "last"').replace("a1", "b1").replace("a2", "b2"))
    put("nosource.json", json.dumps({**env, "source": None}))
    put("baddate.json", json.dumps({**env, "extracted_at": "yesterday"}))
    put("nokey.json", json.dumps({**env, "jobs": [{"title": "x"}, None]}))
    put("wrongtype.json", json.dumps({**env, "total_records": "many", "jobs": [{"id": "c1"}, {"id": "c2"}]}))
    put("junk.json", "{ not json")
    judged = judged_rows(read_landing(spark, tmpdir_path, layout="plain")).withColumn(
        "title", F.try_variant_get("raw_data", "$.title", "string")).collect()
    reasons = {}
    for r in judged:
        name = os.path.basename(r["_source_file"])
        reasons.setdefault(name, []).append(r["reject_reason"])
    assert {n: sorted(x, key=str) for n, x in reasons.items()} == {
        "good.json": [None, None], "cut.json": ["corrupt"], "twice.json": [None, None],
        "nosource.json": ["no_source"] * 2, "baddate.json": ["bad_timestamp"] * 2,
        "nokey.json": ["no_key", "no_key"], "wrongtype.json": [None, None], "junk.json": ["corrupt"]}
    assert {r["title"] for r in judged if r["job_id"] == "b1"} == {"last"}
    assert all(r["raw_text"] for r in judged if r["reject_reason"] == "corrupt")


def test_stream_writes_rejects(spark, tmpdir_path):
    from hirelake.streaming.ingest import ingest_available
    _envelope_lake(f"{tmpdir_path}/lake")
    bronze = ingest_available(spark, f"{tmpdir_path}/lake", f"{tmpdir_path}/bronze", f"{tmpdir_path}/ckpt", layout="plain")
    rejects = spark.read.parquet(f"{tmpdir_path}/bronze_rejects")
    assert bronze.count() == 6
    assert sorted(r["reject_reason"] for r in rejects.collect()) == ["corrupt"] + ["no_key"] * 4


def test_merge_raises_on_unreadable_target(spark, tmpdir_path):
    import pytest
    batch = spark.createDataFrame([("1", "s", "f", 0)], "job_id string, source string, _source_file string, _source_pos long")
    target = os.path.join(tmpdir_path, "bronze")
    insert_only_merge(target, batch)
    with open(os.path.join(target, "part-00000-broken.snappy.parquet"), "w") as fh:
        fh.write("no parquet")
    before = sorted(os.listdir(target))
    with pytest.raises(Exception):  # noqa: B017 - whatever Spark says of the broken file
        insert_only_merge(target, batch).count()
    assert [f for f in sorted(os.listdir(target)) if f.endswith(".parquet") and f.startswith("part")] == [
        f for f in before if f.endswith(".parquet")]
