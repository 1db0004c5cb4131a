"""Keyed table, envelope files, rejected casts, sketch medians."""

import json
import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.sources.envelope import write_envelopes
from hirelake.sources.keyed_table import KeyedTable
from hirelake.sources.landing import landing_rows

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("job_id", "source", "_source_file")]
                      + [T.StructField("_source_pos", T.LongType()), T.StructField("v", T.StringType())])


def _batch(spark, ids, v="x"):
    return spark.createDataFrame([(str(i), "s", "f", k, v) for k, i in enumerate(ids)], SCHEMA)


def test_keyed_table_inserts_once_and_keeps_its_audit(spark, tmpdir_path):
    table = KeyedTable(spark, f"{tmpdir_path}/t", SCHEMA, buckets=8)
    assert table.read().count() == 0
    assert table.merge(_batch(spark, [1, 2, 2, 3], "a"))["new_records"] == 3
    assert table.merge(_batch(spark, [1, 2, 2, 3], "b"))["new_records"] == 0
    assert table.merge(_batch(spark, [3, 4], "c"))["skipped_records"] == 1
    assert table.merge(_batch(spark, []))["batch_records"] == 0
    assert sorted((r.job_id, r.v, r._source_pos) for r in table.read().collect()) == [
        ("1", "a", 0), ("2", "a", 1), ("3", "a", 3), ("4", "c", 1)]
    assert [tuple(r)[2:] for r in table.loads().collect()] == [(4, 3, 1), (4, 0, 4), (2, 1, 1), (0, 0, 0)]


def test_keyed_table_reads_hit_buckets_and_keys_only(spark, tmpdir_path):
    table = KeyedTable(spark, f"{tmpdir_path}/t", SCHEMA, buckets=32)
    table.merge(_batch(spark, range(500)))
    rows = table._read(table.manifest().loads).where("job_id IN ('7', '8')")
    plan = table._without(rows, table.manifest().loads)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan parquet" in x and "v:" not in x.split("ReadSchema")[1])
    assert "PartitionFilters: [isnotnull(_bucket" in scan or "_bucket" in scan.split("PartitionFilters:")[1].split("]")[0]
    assert "job_id:string,source:string>" in scan


def test_two_loads_at_once_insert_once(spark, tmpdir_path):
    """All start from the same version; those that commit later take off what the others brought."""
    for run in range(2):
        root = f"{tmpdir_path}/t{run}"
        batches = [_batch(spark, range(0, 60), "a"), _batch(spark, range(30, 90), "b"), _batch(spark, range(0, 60), "c")]
        with ThreadPoolExecutor(3) as pool:
            list(pool.map(lambda b: KeyedTable(spark, root, SCHEMA, buckets=4).merge(b), batches))
        table = KeyedTable(spark, root, SCHEMA, buckets=4)
        ids = [r.job_id for r in table.read().collect()]
        assert len(ids) == len(set(ids)) == 90
        assert table.loads().agg(F.sum("new_records")).first()[0] == 90 and table.manifest().version == 3


def test_conflicting_commit_is_redone(spark, tmpdir_path):
    """Another load commits between this one's reading and its commit."""
    table = KeyedTable(spark, f"{tmpdir_path}/t", SCHEMA, buckets=4)
    publish, other = table._publish, KeyedTable(spark, f"{tmpdir_path}/t", SCHEMA, buckets=4)

    def late(version, loads):
        if version == 1:
            other.merge(_batch(spark, [1, 2], "other"))
        return publish(version, loads)
    table._publish = late
    assert table.merge(_batch(spark, [2, 3], "mine"))["new_records"] == 1
    assert sorted((r.job_id, r.v) for r in table.read().collect()) == [("1", "other"), ("2", "other"), ("3", "mine")]


def test_failed_load_changes_nothing(spark, tmpdir_path):
    table = KeyedTable(spark, f"{tmpdir_path}/t", SCHEMA, buckets=4)
    table.merge(_batch(spark, [1, 2]))
    bad = _batch(spark, [3, 4]).withColumn("v", F.when(F.col("job_id") == "4", F.raise_error(F.lit("broken"))).otherwise("x"))
    with pytest.raises(Exception, match="broken"):
        table.merge(bad.withColumn("v", F.col("v").cast("string")))
    assert table.read().count() == 2 and table.manifest().version == 1


def _jobs(spark, rows):
    frame = spark.createDataFrame(rows, "source string, country string, keyword string, fetch_seq long, js string")
    return frame.withColumn("raw_data", F.parse_json("js")).drop("js")


def _write(jobs, root):
    write_envelopes(jobs, root, F.lit("2026-04-01 06:00:00").cast("timestamp"))


def test_envelope_files_round_trip(spark, tmpdir_path):
    rows = [("adzuna", "austria", "Data Engineer", k, json.dumps({"id": f"a{k}", "title": 'say "hi" ü\n'})) for k in range(300)]
    rows += [("adzuna", "austria", "Cloud", k, json.dumps({"id": f"c{k}"})) for k in range(3)]
    rows += [("jooble", "austria", "Cloud", 1, '{"id": 0, "slug": "s"}'), ("jooble", None, "Cloud", 2, '{"id": 9}')]
    random.Random(1).shuffle(rows)
    _write(_jobs(spark, rows), tmpdir_path)
    day = os.path.join(tmpdir_path, "adzuna", "austria", "2026", "04", "01")
    assert sorted(os.listdir(day)) == ["cloud_jobs.json", "data_engineer_jobs.json"]
    with open(os.path.join(day, "data_engineer_jobs.json")) as fh:
        envelope = json.load(fh)
    assert envelope["total_records"] == 300 and envelope["keyword"] == "Data Engineer"
    assert [j["id"] for j in envelope["jobs"]] == [f"a{k}" for k in range(300)]
    got = sorted(r.job_id for r in landing_rows(spark, tmpdir_path, "2026-04-01", layout="plain").collect())
    assert got == sorted([f"a{k}" for k in range(300)] + ["c0", "c1", "c2", "s"])
    # a rerun of one keyword replaces its file only, and nothing is left aside
    _write(_jobs(spark, [("adzuna", "austria", "Cloud", 0, '{"id": "new"}')]), tmpdir_path)
    again = {r.job_id for r in landing_rows(spark, tmpdir_path, "2026-04-01", layout="plain").collect()}
    assert again == {f"a{k}" for k in range(300)} | {"new", "s"}
    assert sorted(os.listdir(tmpdir_path)) == ["adzuna", "jooble"]


def test_failed_envelope_write_leaves_the_lake(spark, tmpdir_path):
    _write(_jobs(spark, [("adzuna", "austria", "Cloud", 0, '{"id": "old"}')]), tmpdir_path)
    jobs = _jobs(spark, [("adzuna", "austria", "Cloud", k, '{"id": "n"}') for k in range(50)])
    bad = jobs.withColumn("keyword", F.when(F.col("fetch_seq") == 49, F.raise_error(F.lit("broken"))).otherwise(F.col("keyword")))
    with pytest.raises(Exception, match="broken"):
        _write(bad.withColumn("keyword", F.col("keyword").cast("string")), tmpdir_path)
    assert [r.job_id for r in landing_rows(spark, tmpdir_path, "2026-04-01", layout="plain").collect()] == ["old"]


def test_natural_key_truthiness(spark):
    from hirelake.sources.landing import with_natural_key
    values = ["null", "false", '""', "[]", "{}", "0", "0.0", "-0.0", "0e5", "0.00", '"0"', "true", "1", '" "', "[0]", '{"a":0}', "10", "0.01", '"null"']
    frame = spark.createDataFrame([(v, json.dumps({"slug": "s"})[:-1] + f', "id": {v}}}') for v in values], "v string, js string")
    got = {r.v: r.job_id for r in with_natural_key(frame.withColumn("raw_data", F.parse_json("js"))).collect()}
    assert {v for v, k in got.items() if k == "s"} == {v for v in values if not json.loads(v)}


def test_rejected_casts_are_counted(spark, tmpdir_path):
    from hirelake.plans.silver import cast_rejects, observe_casts
    rows = [("adzuna", '{"salary_min": "x", "created": "2026-01-01", "remote": "no"}'), ("adzuna", '{"salary_min": 5, "created": "?"}'),
            ("arbeitnow", '{"created_at": 1700000000, "remote": true}'), ("arbeitnow", '{"created_at": "today", "salary_max": []}'),
            ("jooble", '{"updated": null, "created": "?"}')]
    bronze = spark.createDataFrame(rows, "source string, js string").select("source", F.parse_json("js").alias("raw_data"))
    seen = Observation("t")
    observe_casts(bronze, seen).write.parquet(f"{tmpdir_path}/b")
    assert {tuple(r) for r in cast_rejects(spark, seen).collect()} == {
        ("salary_min", 2, 1), ("salary_max", 1, 1), ("remote", 2, 0), ("job_posted_at", 4, 2)}


def test_sketch_median_is_within_its_bound(spark):
    from hirelake.operators.metrics import median_salary_by_role, rank_error
    fact = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("search_role"),
        F.when(F.col("id") % 10 > 0, F.col("id") * 7919 % 40_009).alias("salary_midpoint_yearly"))
    values = {}
    for r in fact.where("salary_midpoint_yearly IS NOT NULL").collect():
        values.setdefault(r.search_role, []).append(r.salary_midpoint_yearly)
    for r in median_salary_by_role(fact, exact=False).collect():
        rank = sum(v <= r.median_salary for v in values[r.search_role]) / len(values[r.search_role])
        assert r.n_postings == len(values[r.search_role]) and abs(rank - 0.5) <= rank_error()
    exact = {r.search_role: r.median_salary for r in median_salary_by_role(fact).collect()}
    assert set(exact) == {"a", "b"}


def test_refresh_that_readers_survive(spark, tmpdir_path):
    from hirelake.plans.warehouse import Warehouse
    house = Warehouse(spark, tmpdir_path, prefix="t_refresh_")
    reader = house.refresh("gold", "t", spark.range(3))
    with pytest.raises(Exception, match="broken"):
        house.refresh("gold", "t", spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long")))
    assert house.table("gold", "t").count() == 3
    house.refresh("gold", "t", spark.range(5))
    assert reader.count() == 3 and house.table("gold", "t").count() == 5
    assert house.drop_versions("gold", "t") == 2 and house.table("gold", "t").count() == 5


def test_known_rows_are_neither_ordered_nor_moved(spark, tmpdir_path, monkeypatch):
    """A load told twice: keys alone tell that all is there, payloads are not shuffled again."""
    from hirelake.sources import keyed_table
    sizes, plain = [], keyed_table.first_per_key
    monkeypatch.setattr(keyed_table, "first_per_key", lambda rows, keys: sizes.append(rows.count()) or plain(rows, keys))
    table = KeyedTable(spark, f"{tmpdir_path}/t", SCHEMA, buckets=4)
    for ids in ([1, 2, 2], [1, 2, 2], [2, 3]):
        table.merge(_batch(spark, ids))
    assert sizes == [3, 0, 1]


def test_a_load_parses_its_files_once(spark, tmpdir_path, monkeypatch):
    from hirelake.plans import warehouse
    seen, plain = [], warehouse.accepted_rows
    monkeypatch.setattr(warehouse, "accepted_rows", lambda rows: seen.append(rows) or plain(rows))
    folder = f"{tmpdir_path}/lake/board/austria/2026/04/01"
    os.makedirs(folder)
    with open(f"{folder}/cloud_jobs.json", "w") as out:
        json.dump({"extracted_at": "2026-04-01T06:00:00", "source": "board", "country": "austria", "keyword": "Cloud",
                   "jobs": [{"id": "1"}, {"id": "2"}, {"title": "none"}]}, out)
    house = warehouse.Warehouse(spark, f"{tmpdir_path}/house", buckets=2)
    assert dict(x[1:] for x in house.load(f"{tmpdir_path}/lake", "2026-04-01")) == {
        "batch_records": 2, "new_records": 2, "skipped_records": 0, "no_key": 1}
    assert not any(f.endswith(".json") for f in seen[0].inputFiles())
