"""Insert-only table keyed by columns, with atomic loads.

Rows lie in buckets by a hash of the key; a load writes its files beside the others and becomes
part of the table with one manifest that is created only if nobody else created the same
version. So readers see whole loads or nothing of them, a load that fails leaves the table as it
was, and of two loads at once the second notices, drops the keys the first one brought, and
commits after it.

``root/loads/load=<load>/_bucket=<k>/*.parquet``, ``root/manifests/<version>.json``.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.operators.dedup import written
from hirelake.operators.merge import KEY, first_per_key

BUCKETS = 64
AUDIT_SCHEMA = "load_run int, load_id string, batch_records long, new_records long, skipped_records long"


class Manifest(NamedTuple):
    version: int
    loads: list[dict]


class KeyedTable:
    """The table under ``root`` with columns ``schema`` and a unique key."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str] = KEY,
                 buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.buckets = list(keys), buckets

    # ------------------------------------------------------------------ files

    def _path(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _publish(self, version: int, loads: list[dict]) -> bool:
        """Create the manifest of ``version``; False if it is there already. The text is
        written aside and gets its name in one step, which fails on an existing name."""
        jvm = self.spark.sparkContext._jvm
        name = f"{self.root}/manifests/{version:010d}.json"
        aside, fs = self._path(f"{self.root}/staged/{uuid.uuid4().hex}")
        target, _ = self._path(name)
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps({"loads": loads}).encode()))
        out.close()
        fs.mkdirs(target.getParent())
        if fs.getScheme() != "file":
            return not fs.exists(target) and fs.rename(aside, target)
        local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, aside)]
        try:  # a local rename would replace the other manifest, a link does not
            jvm.java.nio.file.Files.createLink(*local)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
                return False
            raise
        return True

    def manifest(self) -> Manifest:
        folder, fs = self._path(f"{self.root}/manifests")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        names = sorted(n for n in names if n.endswith(".json") and not n.startswith((".", "_")))
        if not names:
            return Manifest(0, [])
        text = self.spark.read.text(f"{self.root}/manifests/{names[-1]}", wholetext=True).first().value
        return Manifest(int(names[-1][:-5]), json.loads(text)["loads"])

    # ------------------------------------------------------------------ rows

    def _read(self, loads: list[dict]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("_bucket", T.IntegerType())])
        paths = [f"{self.root}/loads/load={x['load_id']}" for x in loads if x["new_records"]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", f"{self.root}/loads").parquet(*paths)
        return found.select(*schema.names)

    def read(self) -> DataFrame:
        """The rows of all committed loads."""
        return self._read(self.manifest().loads).select(*self.schema.names)

    def _without(self, rows: DataFrame, loads: list[dict], batch_keys: DataFrame | None = None) -> DataFrame:
        """``rows`` (with ``_bucket``) whose key no load has. Only the buckets that hold rows of
        the batch are read, and of them the keys: the filter prunes folders. ``batch_keys`` are
        the buckets and keys of ``rows``, if they lie ready."""
        batch_keys = rows if batch_keys is None else batch_keys
        hit = [r._bucket for r in batch_keys.select("_bucket").distinct().collect()]  # at most ``buckets``
        there = self._read(loads).where(F.col("_bucket").isin(hit)).select("_bucket", *self.keys)
        names = ["_bucket", *self.keys]
        # first the keys of the table that are in the batch, so the table is not shuffled for a small batch
        known = there.join(batch_keys.select(*names), names, "left_semi")
        return rows.join(known, names, "left_anti")

    def _write(self, rows: DataFrame) -> tuple[str, int]:
        load = uuid.uuid4().hex
        path = f"{self.root}/loads/load={load}"
        rows.repartition("_bucket").write.partitionBy("_bucket").parquet(path)  # one file a bucket
        return load, self._read([{"load_id": load, "new_records": 1}]).count() if self._has_rows(path) else 0

    def _has_rows(self, path: str) -> bool:
        place, fs = self._path(path)
        return any(f.getPath().getName().startswith("_bucket=") for f in fs.listStatus(place))

    def merge(self, batch: DataFrame) -> dict:
        """Insert the rows of ``batch`` whose key is new, of equal keys in the batch the first
        (file, then position); existing rows never change. Returns the load's audit, which is
        also kept with the table: ``batch_records, new_records, skipped_records``."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        rows, seen = batch.withColumn("_bucket", bucket), self.manifest()
        if seen.loads:
            # keys alone tell which rows are known; only the others are put in order and moved
            batch_keys = written(rows.select("_bucket", *self.keys), "batch-keys")
            total, rows = batch_keys.count(), self._without(rows, seen.loads, batch_keys)
        else:
            total = batch.count()
        load, new = self._write(first_per_key(rows, self.keys).select(*self.schema.names, "_bucket"))
        while True:
            audit = {"load_id": load, "batch_records": total, "new_records": new, "skipped_records": total - new}
            if self._publish(seen.version + 1, [*seen.loads, audit]):
                return audit
            # somebody else committed: only what their loads brought is to be taken off
            now = self.manifest()
            added = now.loads[len(seen.loads):]
            if new and any(x["new_records"] for x in added):
                load, new = self._write(self._without(self._read([audit]), added))
            seen = now

    def loads(self) -> DataFrame:
        """The audit of every load, in order: one row each."""
        rows = [(k, x["load_id"], x["batch_records"], x["new_records"], x["skipped_records"])
                for k, x in enumerate(self.manifest().loads, 1)]
        return self.spark.createDataFrame(rows, AUDIT_SCHEMA)
