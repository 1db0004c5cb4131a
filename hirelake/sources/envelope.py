"""Envelope files, as job-board collectors write them: one pretty-printed JSON object per
source, country, day and keyword, ``<root>/<source>/<country>/YYYY/MM/DD/<keyword>_jobs.json``.

A Python data source writer. Spark gathers and orders the rows of each file; a task streams
them to a file aside, row by row, so memory does not grow with the file. The driver gives all
files their names when every task has succeeded: a failed write leaves the lake as it was, and a
rerun of one keyword replaces that keyword's file only.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from hirelake.sources.landing import keyword_slug

FORMAT = "landing_envelope"
INDENT = " " * 4
PLACE = ["source", "country", "day", "slug"]


@dataclass
class StagedFiles(WriterCommitMessage):
    """(path aside, final path) of the files of a task."""
    files: list[tuple[str, str]]


def _field(name: str, value: object) -> str:
    return f"{INDENT}{json.dumps(name)}: {json.dumps(value, ensure_ascii=False)}"


class EnvelopeWriter(DataSourceWriter):
    """Rows come sorted by file: ``source, country, day, slug, extracted_at, keyword, job``."""

    def __init__(self, root: str) -> None:
        self.root, self.aside = root.rstrip("/"), f"_staged-{uuid.uuid4().hex}"

    def _place(self) -> tuple[pafs.FileSystem, str]:
        if "://" in self.root or self.root.startswith("file:"):
            return pafs.FileSystem.from_uri(self.root)
        return pafs.LocalFileSystem(), self.root

    def write(self, iterator: Iterator[Row]) -> StagedFiles:
        store, root = self._place()
        task = TaskContext.get()
        folder = f"{root}/{self.aside}/{task.partitionId()}-{task.attemptNumber()}-{uuid.uuid4().hex[:8]}"
        store.create_dir(folder, recursive=True)
        files: list[tuple[str, str]] = []
        out, now, count = None, None, 0

        def close() -> None:
            if out is not None:
                out.write(f"\n{INDENT}],\n{_field('total_records', count)}\n}}\n".encode())
                out.close()

        for row in iterator:
            if (place := tuple(row[c] for c in PLACE)) != now:
                close()
                source, country, day, slug = now = place
                final = "/".join([root, source, country, *day.split("-"), f"{slug}_jobs.json"])
                files.append((f"{folder}/{len(files)}.json", final))
                out, count = store.open_output_stream(files[-1][0]), 0
                head = ",\n".join(_field(c, row[c]) for c in ("extracted_at", "source", "country", "keyword"))
                out.write(f'{{\n{head},\n{INDENT}"jobs": ['.encode())
            out.write(f"{',' if count else ''}\n{INDENT * 2}{row['job']}".encode())
            count += 1
        close()
        return StagedFiles(files)

    def commit(self, messages: list[StagedFiles | None]) -> None:
        store, root = self._place()
        for aside, final in (f for m in messages if m for f in m.files):
            store.create_dir(final.rpartition("/")[0], recursive=True)
            store.move(aside, final)
        self.abort(messages)

    def abort(self, messages: list[StagedFiles | None]) -> None:
        """Drop what was written aside."""
        store, root = self._place()
        if store.get_file_info(f"{root}/{self.aside}").type != pafs.FileType.NotFound:
            store.delete_dir(f"{root}/{self.aside}")


class EnvelopeDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> EnvelopeWriter:
        return EnvelopeWriter(self.options["path"])


def write_envelopes(jobs: DataFrame, root: str, extracted_at: Column | None = None,
                    order: tuple[str, ...] = ("fetch_seq",)) -> None:
    """Write job rows (``source, country, keyword, raw_data``, ordered by ``order``) as envelope
    files. Rows without source, country, keyword or payload name no file and are left out.
    The layout asks for one file per keyword, which one task streams."""
    stamp = extracted_at if extracted_at is not None else F.current_timestamp()
    rows = jobs.dropna(subset=["source", "country", "keyword", "raw_data"]).select(
        "source", "country", F.date_format(stamp, "yyyy-MM-dd").alias("day"),
        keyword_slug(F.col("keyword")).alias("slug"),
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("extracted_at"), "keyword",
        F.to_json("raw_data").alias("job"), *[F.col(c).alias(f"_order_{c}") for c in order])
    jobs.sparkSession.dataSource.register(EnvelopeDataSource)
    (rows.repartition(*PLACE).sortWithinPartitions(*PLACE, *[f"_order_{c}" for c in order])
     .write.format(FORMAT).mode("append").option("path", root).save())


# tasks get the writer by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
