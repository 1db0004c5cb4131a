"""Envelope files read in parts."""

import json
import os
import random

from hirelake.sources import split_envelope as se
from hirelake.sources.landing import judged_rows, landing_rows, read_landing

DAY = "2026-04-01"


def _envelope(root, name, jobs, indent=4, **fields):
    folder = f"{root}/board/austria/2026/04/01"
    os.makedirs(folder, exist_ok=True)
    head = {"extracted_at": f"{DAY}T06:00:00", "source": "board", "country": "austria", "keyword": name} | fields
    with open(f"{folder}/{name}_jobs.json", "w") as out:
        json.dump(head | {"jobs": jobs, "total_records": len(jobs)}, out, indent=indent, ensure_ascii=False)
    return f"{folder}/{name}_jobs.json"


def _awkward_jobs(n, seed=1):
    draw = random.Random(seed)
    texts = ['plain', 'quote " and \\ slash', 'brackets ]}{[ , :', 'line\nbreak ü €', '', '"jobs": [']
    return [{"id": k + 1, "title": draw.choice(texts), "jobs": [draw.choice(texts)] * draw.randint(0, 3),
             "deep": {"jobs": [{"source": "inner"}], "country": draw.choice(texts)}} for k in range(n)]


def _rows(df):
    return sorted((r.job_id, r.source, r.keyword, r.country, str(r.extracted_at), r.raw_data.toJson())
                  for r in df.collect())


def test_every_cut_gives_the_same_jobs(tmpdir_path):
    """Plain Python, parts of every size down to a few bytes: each job once, in order."""
    jobs = _awkward_jobs(12)
    for indent in (4, 0, None):
        path = _envelope(tmpdir_path, f"x{indent}", jobs, indent)
        size = os.path.getsize(path)
        for step in (7, 16, 61, 200, 1000, size, size * 2):
            parts = [(path, s, min(s + step, size)) for s in range(0, size, step)]
            import pyarrow as pa
            table = pa.Table.from_batches(se._summaries(iter([pa.RecordBatch.from_pylist(
                [dict(zip(("path", "start", "stop"), p)) for p in parts])])))
            states = se._states(table).to_pylist()
            assert len(states) == len(parts) and not states[0]["broken"]
            assert states[0]["keyword"] == f"x{indent}" and states[0]["total_records"] == "12"
            found = [j for s in states for j in se._jobs(s["path"], s["start"], s["stop"], s["depth"], s["in_jobs"])]
            assert [json.loads(j) for _, j in found] == jobs
            assert [o for o, _ in found] == sorted({o for o, _ in found})


def test_split_read_equals_whole_read(spark, tmpdir_path):
    _envelope(tmpdir_path, "large", _awkward_jobs(400))
    _envelope(tmpdir_path, "oneline", _awkward_jobs(300, 2), None)
    _envelope(tmpdir_path, "small", _awkward_jobs(3, 3))
    _envelope(tmpdir_path, "empty", [])
    whole = landing_rows(spark, tmpdir_path, DAY, layout="plain")
    split = landing_rows(spark, tmpdir_path, DAY, layout="plain", split_bytes=4096)
    assert _rows(split) == _rows(whole) and len(_rows(whole)) == 703

    def order(df):
        found = {}
        for r in df.orderBy("_source_pos").collect():
            found.setdefault(r._source_file, []).append(r.job_id)
        return found

    assert order(split) == order(whole)
    parts = se.large_files(spark, f"{tmpdir_path}/*/*/*/*/*/*.json", 4096).groupBy("path").count().collect()
    assert len(parts) == 2 and min(p["count"] for p in parts) > 10


def test_broken_and_odd_files(spark, tmpdir_path):
    path = _envelope(tmpdir_path, "cut", _awkward_jobs(200))
    with open(path, "r+") as out:
        out.truncate(os.path.getsize(path) - 300)
    _envelope(tmpdir_path, "mixed", [None, 5, "text", {"id": 7}, {"title": "none"}] * 300)
    _envelope(tmpdir_path, "nothing", None or [], note="x" * 3000)
    judged = judged_rows(read_landing(spark, tmpdir_path, DAY, "plain", split_bytes=1000))
    got = {(r.keyword, r.reject_reason): r["count"] for r in judged.groupBy("keyword", "reject_reason").count().collect()}
    assert got[(None, "corrupt")] == 1 and got[("mixed", None)] == 300
    whole = judged_rows(read_landing(spark, tmpdir_path, DAY, "plain"))
    assert got == {(r.keyword, r.reject_reason): r["count"] for r in whole.groupBy("keyword", "reject_reason").count().collect()}


def test_small_parts_share_tasks(spark, tmpdir_path):
    """Tasks grow with the bytes, not with the parts."""
    _envelope(tmpdir_path, "large", _awkward_jobs(400))
    glob = f"{tmpdir_path}/*/*/*/*/*/*.json"
    parts = se.large_files(spark, glob, 500)
    rows = se.read_split_envelopes(spark, glob, 500)
    assert parts.count() > 100 and rows.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
    assert rows.count() == 400
