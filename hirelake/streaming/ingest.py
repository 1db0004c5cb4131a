"""Incremental bronze load: landing files as a file stream, merged per micro-batch.

``trigger(availableNow=True)`` processes every landing file not yet seen (the stream's
checkpoint remembers which) and stops: the daily "load today's files" run. Old files are
not read again; they are listed, unless ``day`` names the one day to look at. Each
micro-batch goes through the same steps as the batch load (corrupt split, explode, natural
key) and an insert-only merge into the bronze table; what is left out is written, with
its reason, beside it. A replayed micro-batch (after a failure) inserts nothing twice, because
the merge only appends keys the table does not have yet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.operators.merge import insert_only_merge
from hirelake.sources.bronze import bronze_rows
from hirelake.session import apply_sql_defaults
from hirelake.sources.landing import ENVELOPE_SCHEMA, accepted_rows, day_glob, judged_rows, rejected_rows


def landing_stream(spark: SparkSession, landing_root: str, layout: str = "spark",
                   max_files_per_trigger: int | None = None, day: str | None = None) -> DataFrame:
    apply_sql_defaults(spark)
    reader = (spark.readStream.schema(ENVELOPE_SCHEMA)
              .option("multiLine", layout == "plain").option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "_corrupt_record"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(day_glob(landing_root, day, layout=layout)) \
        .withColumn("_source_file", F.col("_metadata.file_path"))


def merge_batch(bronze_path: str, rejects_path: str):
    def _merge(batch: DataFrame, epoch_id: int) -> None:
        judged = judged_rows(batch)
        rejected_rows(judged).withColumn("raw_data", F.col("raw_data").cast("string")) \
            .write.mode("overwrite").parquet(f"{rejects_path}/batch={epoch_id}")
        insert_only_merge(bronze_path, bronze_rows(accepted_rows(judged)))
    return _merge


def ingest_available(spark: SparkSession, landing_root: str, bronze_path: str,
                     checkpoint_path: str, layout: str = "spark", day: str | None = None,
                     rejects_path: str | None = None) -> DataFrame:
    """Load every new landing file into bronze, then stop; returns the bronze table. Rejects
    go to ``rejects_path``, by default the bronze path with ``_rejects`` appended."""
    rejects_path = rejects_path or bronze_path.rstrip("/") + "_rejects"
    q = (landing_stream(spark, landing_root, layout, day=day).writeStream
         .foreachBatch(merge_batch(bronze_path, rejects_path))
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(bronze_path)
