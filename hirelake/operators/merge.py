"""Insert-only merge into bronze: new keys are appended, existing rows never change."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.operators.dedup import keep_first

KEY = ["job_id", "source"]


def first_per_key(batch: DataFrame, keys=KEY) -> DataFrame:
    """Within one batch the first row of a key (file, then position) wins."""
    return keep_first(batch, keys, [F.col("_source_file").asc_nulls_last(),
                                    F.col("_source_pos").asc_nulls_last()])


def new_rows(target: DataFrame, batch: DataFrame, keys=KEY) -> DataFrame:
    """Batch rows whose key is not in the target (``ON CONFLICT DO NOTHING``).

    Written as two steps so the large side is never shuffled for a small batch: the
    keys of the target that occur in the batch (a semi join whose build side is the
    batch, which AQE broadcasts when its measured size is small; otherwise both sides
    shuffle), then the batch minus those keys (both sides batch-sized)."""
    fresh = first_per_key(batch, keys)
    batch_keys = fresh.select(*keys)
    existing = target.select(*keys).join(batch_keys, list(keys), "left_semi")
    return fresh.join(existing, list(keys), "left_anti")


def load_audit(batch: DataFrame, new: DataFrame) -> DataFrame:
    """One row: batch size, rows inserted, rows skipped (already present or repeated)."""
    tagged = (batch.select(F.lit(1).alias("_b"), F.lit(0).alias("_n"))
              .unionByName(new.select(F.lit(0).alias("_b"), F.lit(1).alias("_n"))))
    return (tagged.agg(F.sum("_b").cast("long").alias("batch_records"),
                       F.sum("_n").cast("long").alias("new_records"))
            .withColumn("skipped_records", F.col("batch_records") - F.col("new_records")))


def insert_only_merge(target_path: str, batch: DataFrame, keys=KEY) -> DataFrame:
    """Append the new rows of ``batch`` to the parquet table at ``target_path``; returns
    the table. Re-running with the same batch appends nothing. Only a path that does not
    exist is an empty target; any other failure to read it is raised before writing."""
    spark = batch.sparkSession
    try:
        target = spark.read.schema(batch.schema).parquet(target_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        target = None
    new = first_per_key(batch, keys) if target is None else new_rows(target, batch, keys)
    new.write.mode("append").parquet(target_path)
    return spark.read.schema(batch.schema).parquet(target_path)
