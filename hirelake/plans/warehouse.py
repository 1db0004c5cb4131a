"""The daily run: landed files to bronze, silver, gold and checks, in one call.

Bronze is an insert-only :class:`KeyedTable`. The layers above are refreshed whole, each into a
folder of its own, and a view of the layer's namespace is switched to it when it is complete:
a reader sees the old rows until then, and a refresh that fails changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hirelake.operators.dedup import written
from hirelake.operators.quality import run_checks
from hirelake.plans import gold as G
from hirelake.plans.silver import cast_rejects, silver_job_skills, silver_jobs
from hirelake.sources.bronze import BRONZE_SCHEMA, LAYERS, bronze_rows
from hirelake.sources.keyed_table import KeyedTable
from hirelake.sources.landing import accepted_rows, judged_rows, read_landing, rejected_rows
from hirelake.sources.split_envelope import SPLIT_BYTES

REPORT = "step string, name string, n long"


class Warehouse:
    """Layers under ``root`` with views ``<prefix><layer>.<name>``."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", buckets: int = 64) -> None:
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix
        self.bronze = KeyedTable(spark, f"{self.root}/bronze/raw_jobs", BRONZE_SCHEMA, buckets=buckets)

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(f"{self.prefix}{layer}.{name}")

    def refresh(self, layer: str, name: str, rows: DataFrame) -> DataFrame:
        """Write a new version of a table, then switch its view to it; older versions stay for
        their readers until :meth:`drop_versions`."""
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        path = f"{self.root}/{layer}/{name}/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.prefix}{layer}.{name} AS SELECT * FROM parquet.`{path}`")
        return self.table(layer, name)

    def drop_versions(self, layer: str, name: str) -> int:
        """Delete the versions of a table that its view does not show; returns their number.
        Only when nobody reads them any more."""
        current = {f.rsplit("/", 2)[1] for f in self.table(layer, name).inputFiles()}
        if not current:  # the current version cannot be told
            return 0
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{layer}/{name}")
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        old = [f.getPath() for f in fs.listStatus(place) if f.getPath().getName() not in current]
        return sum(bool(fs.delete(p, True)) for p in old)

    def load(self, landing_root: str, day: str, layout: str = "plain") -> list[tuple[str, str, int]]:
        """Load one day's files; rejects are written beside bronze with their reason."""
        # written, as it is looked at four times: files are read and parsed once
        judged = written(judged_rows(read_landing(self.spark, landing_root, day, layout, SPLIT_BYTES)), "judged")
        rejects = f"{self.root}/bronze/rejects/{uuid.uuid4().hex}"
        rejected_rows(judged).withColumn("raw_data", F.col("raw_data").cast("string")).write.parquet(rejects)
        audit = self.bronze.merge(bronze_rows(accepted_rows(judged)))
        reasons = self.spark.read.schema("reject_reason string").parquet(rejects).groupBy("reject_reason").count()
        return ([("load", c, audit[c]) for c in ("batch_records", "new_records", "skipped_records")]
                + [("rejected", r["reject_reason"], r["count"]) for r in reasons.collect()])

    def build(self, taxonomy: DataFrame) -> list[tuple[str, str, int]]:
        """Refresh silver and gold from bronze; returns rows per table, rejected casts, checks."""
        casts = Observation("casts")
        silver = self.refresh("silver", "silver_jobs", silver_jobs(self.bronze.read(), casts))
        skills = self.refresh("silver", "silver_job_skills", silver_job_skills(silver, taxonomy))
        gold = {name: self.refresh("gold", name, rows) for name, rows in (
            ("fct_job_postings", G.fct_job_postings(silver)), ("dim_companies", G.dim_companies(silver)),
            ("dim_skills", G.dim_skills(skills)), ("dim_date", G.dim_date(self.spark)),
            ("bridge_job_skills", G.bridge_job_skills(skills)))}
        tables = {"silver_jobs": silver, "silver_job_skills": skills, **gold}
        checks = run_checks(gold["fct_job_postings"], gold["dim_companies"], gold["dim_skills"]).collect()
        return ([("rows", name, t.count()) for name, t in tables.items()]
                + [("rejected_cast", r.column_name, r.n_rejected) for r in cast_rejects(self.spark, casts).collect()]
                + [("check", f"{r.table_name}.{r.column_name} {r.check_name}", r.failures) for r in checks])

    def daily_run(self, landing_root: str, day: str, taxonomy: DataFrame, layout: str = "plain") -> DataFrame:
        """Load one day and rebuild the layers; returns the run's report (step, name, n)."""
        report = self.load(landing_root, day, layout) + self.build(taxonomy)
        return self.spark.createDataFrame(report, REPORT)
