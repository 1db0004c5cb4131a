"""The driver's parquet test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_scan(scan: DataFrame, per_core: int = 2) -> DataFrame:
    """A plain scan of fewer files than the session has cores, dealt evenly over all of them:
    a file of one row group is one task, whatever the work after it. Scans of more files,
    every table of a size that matters among them, stay as they are: no shuffle."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if len(scan.inputFiles()) >= cores else scan.repartition(per_core * cores)


def deal_evenly(scan: DataFrame, per_core: int = 4) -> DataFrame:
    """A scan of fewer tasks than ``per_core`` for each core, dealt into so many of equal size: a
    few tasks more than cores make a second round in which most cores wait, and so do the files
    written from them. A scan of more tasks, as any large table is, stays as it is: no shuffle."""
    tasks = per_core * scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= tasks else scan.repartition(tasks)
