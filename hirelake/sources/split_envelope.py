"""Large envelope files, read by many tasks.

An envelope is one JSON object, so Spark reads it whole in one task. A line break never stands
inside a JSON string, so a file can be cut behind lines that end in ``,``, ``[`` or ``{`` and each
part be scanned on its own. The first pass sums up each part: how many brackets it closes that
were open before it, which it leaves open, and the envelope's fields that it may hold. One small
group per file adds these up in order, which tells for every part how deep it starts and whether
in the ``jobs`` list. The second pass then takes the jobs that start in a part and reads on until
the last one ends. A file without line breaks stays one part.
"""

from __future__ import annotations

import io
import json
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.session import scratch_path

SPLIT_BYTES = 64 << 20
FIELDS = ("extracted_at", "source", "country", "keyword", "total_records")
_TOKEN = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*"|[{}\[\]:,]|[^\s"{}\[\]:,]+|"')
_CUT = (b",", b"[", b"{")
_BATCH_BYTES = 8 << 20
# A task reads about this many bytes, in as many parts as that takes.
TASK_BYTES = 16 << 20


def _open(path: str) -> pa.NativeFile:
    store, place = pafs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:", path) else (pafs.LocalFileSystem(), path)
    return store.open_input_file(place)


def _lines(path: str, start: int, stop: int) -> Iterator[tuple[int, bytes, bool]]:
    """(offset, line, whether it belongs to the part) of the part of bytes ``start`` to ``stop``,
    then of all lines behind it."""
    def ends() -> bool:
        """The next part starts behind this line: its bytes from the stop on end in a cut."""
        return at + len(line) > stop and line[max(0, stop - at):].rstrip().endswith(_CUT)

    with _open(path) as raw:
        raw.seek(start)
        file = io.BufferedReader(raw, min(1 << 20, max(1 << 16, stop - start)))
        at, own = start, True
        if start:
            while line := file.readline():
                cut, own = line.rstrip().endswith(_CUT), own and not ends()
                at += len(line)
                if cut:
                    break
        while line := file.readline():
            yield at, line, own
            own = own and not ends()
            at += len(line)


def _summary(path: str, start: int, stop: int) -> tuple[int, list[str], dict[int, dict[str, str]], bool]:
    """Brackets closed that were open before the part; those left open, with their keys; fields
    met after so many of these were closed; whether something cannot be JSON."""
    closes, opened, fields = 0, [], {}
    key = text = None
    broken, first = False, start == 0
    for _, line, own in _lines(path, start, stop):
        if not own:
            break
        for found in _TOKEN.finditer(line):
            token = found[0]
            if first:
                broken, first = token != b"{", False
            elif token in b"{[":
                opened.append(f"{token.decode()}{key or ''}")
                key = text = None
            elif token in b"}]":
                if opened:
                    broken |= opened.pop()[0] != ("{" if token == b"}" else "[")
                else:
                    closes += 1
                key = text = None
            elif token == b":":
                key = json.loads(text) if text else None
            elif token == b",":
                key = text = None
            elif token == b'"':
                broken = True
            elif key is None:
                text = token if token[:1] == b'"' else None
            elif not opened and key in FIELDS:
                fields.setdefault(closes, {})[key] = token.decode()
    return closes, opened, fields, broken


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(*part, *_summary(*part)) for part in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()),
             pa.array([json.dumps(r[4]) for r in rows]), pa.array([json.dumps(r[5]) for r in rows]),
             pa.array([r[6] for r in rows], pa.bool_())],
            names=["path", "start", "stop", "closes", "opened", "fields", "broken"])


def _field(raw: str | None) -> str | None:
    value = json.loads(raw) if raw else None
    return value if value is None or isinstance(value, str) else raw


def _states(group: pa.Table) -> pa.Table:
    """Depth and list at the start of every part of a file; one row if the file is broken."""
    parts = sorted(group.to_pylist(), key=lambda p: p["start"])
    stack, fields, broken = ["{"], {}, False
    rows = []
    for p in parts:
        rows.append((p["path"], p["start"], p["stop"], len(stack), stack[1:2] == ["[jobs"]))
        broken |= p["broken"] or p["closes"] > len(stack)
        fields |= json.loads(p["fields"]).get(str(len(stack) - 1), {})
        stack = stack[:max(0, len(stack) - p["closes"])]
        stack += json.loads(p["opened"])
    broken |= bool(stack)
    if broken:
        rows = rows[:1]
    try:
        values = {f: _field(fields.get(f)) for f in FIELDS}
    except ValueError:
        values, rows, broken = dict.fromkeys(FIELDS), rows[:1], True
    columns = [*zip(*rows, strict=True)]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    return pa.Table.from_arrays(
        [*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), pa.array([broken] * len(rows)),
         *(pa.array([values[f]] * len(rows), pa.string()) for f in FIELDS)],
        names=["path", "start", "stop", "depth", "in_jobs", "broken", *FIELDS])


def _jobs(path: str, start: int, stop: int, depth: int, in_jobs: bool) -> Iterator[tuple[int, bytes]]:
    """(offset, JSON text) of the jobs that start in a part."""
    key = text = None
    first = start == 0
    begin, pieces = -1, []
    for at, line, own in _lines(path, start, stop):
        if not own and begin < 0:
            return
        since = 0
        for found in _TOKEN.finditer(line):
            token = found[0]
            if first:
                first = False
                continue
            opens, closes = token in b"{[", token in b"}]"
            if in_jobs and depth == 2 and not closes and token not in b":,":
                if not own:
                    return
                begin, since = at + found.start(), found.start()
            if depth == 1 and token == b"[" and key == "jobs":
                in_jobs = True
            depth += opens - closes
            if begin >= 0 and depth == 2:
                yield begin, b"".join([*pieces, line[since:found.end()]])
                begin, pieces = -1, []
            if in_jobs and depth < 2:
                in_jobs = False
            if depth == 1 or (depth == 2 and opens):
                if token == b":":
                    key = json.loads(text) if text else None
                elif opens or closes or token == b",":
                    key = text = None
                elif key is None:
                    text = token if token[:1] == b'"' else None
        if begin >= 0:
            pieces.append(line[since:])


def _job_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the jobs of all parts; a batch holds those of many small parts."""
    names = ["path", *FIELDS, "offset", "job", "broken"]
    kinds = [*[pa.string()] * (1 + len(FIELDS)), pa.int64(), pa.string(), pa.bool_()]
    rows, size = [], 0

    def batch_of() -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for part in batch.to_pylist():
            head = tuple(part[c] for c in ("path", *FIELDS))
            if part["broken"]:
                rows.append((*head, 0, None, True))
                continue
            for offset, job in _jobs(*(part[c] for c in ("path", "start", "stop", "depth", "in_jobs"))):
                rows.append((*head, offset, job.decode("utf-8", "replace"), False))
                size += len(job)
                if size > _BATCH_BYTES:
                    yield batch_of()
                    rows, size = [], 0
    yield batch_of()


def task_count(spark: SparkSession, parts: DataFrame) -> int:
    """Tasks that read the parts: one a part while parts are large, else each about ``TASK_BYTES``."""
    found = parts.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("stop") - F.col("start")).alias("size")).first()
    return max(1, min(found["n"], max(2 * spark.sparkContext.defaultParallelism, (found["size"] or 0) // TASK_BYTES)))


def large_files(spark: SparkSession, glob: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``path, start, stop``: the parts of all files above ``split_bytes``. Only names and sizes are read."""
    files = spark.read.format("binaryFile").load(glob).where(F.col("length") > split_bytes)
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")))
    return files.select("path", "length", start.alias("start")).select(
        "path", "start", F.least(F.col("start") + split_bytes, "length").alias("stop"))


def read_split_envelopes(spark: SparkSession, glob: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per job of the envelope files above ``split_bytes``, read in parts of that size, small
    ones by the dozen in a task: the envelope's fields, ``job``, ``_source_file`` and ``_source_offset`` (the byte
    at which the job starts, in the order of the list). An envelope's field that is an object or
    list counts as null; of a repeated field the last value counts, of a repeated ``jobs`` list all
    jobs. A job that does not parse has a null ``job``. A file whose brackets or strings do not
    close gives one row with ``_corrupt_record`` and no job; it is never gathered in one record.
    """
    path = scratch_path(spark, "envelope-parts")
    large_files(spark, glob, split_bytes).write.parquet(path)
    parts = spark.read.parquet(path)
    tasks = task_count(spark, parts)
    summaries = parts.repartition(tasks).mapInArrow(
        _summaries, "path string, start bigint, stop bigint, closes bigint, opened string, fields string, broken boolean")
    fields = ", ".join(f"{f} string" for f in FIELDS)
    states = summaries.groupBy("path").applyInArrow(
        _states, f"path string, start bigint, stop bigint, depth bigint, in_jobs boolean, broken boolean, {fields}")
    path = scratch_path(spark, "envelope-states")
    states.write.parquet(path)
    jobs = spark.read.schema(states.schema).parquet(path).repartition(tasks).mapInArrow(
        _job_rows, f"path string, {fields}, offset bigint, job string, broken boolean")
    return jobs.select(
        "extracted_at", "source", "country", "keyword", F.col("total_records").try_cast("long").alias("total_records"),
        F.try_parse_json("job").alias("job"),
        F.when(F.col("broken"), "envelope does not close").alias("_corrupt_record"),
        F.col("path").alias("_source_file"), F.col("offset").alias("_source_offset"))


# tasks get these functions by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
