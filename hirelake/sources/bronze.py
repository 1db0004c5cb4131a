"""Bronze table: one row per (job_id, source), the payload kept as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BRONZE_KEY = ("job_id", "source")
BRONZE_COLUMNS = ("job_id", "source", "keyword", "country", "extracted_at", "raw_data",
                  "ingested_at", "_source_file", "_source_pos")

BRONZE_SCHEMA = T.StructType([
    T.StructField("job_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("keyword", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("extracted_at", T.TimestampType(), True),
    T.StructField("raw_data", T.VariantType(), False),
    T.StructField("ingested_at", T.TimestampType(), True),
    # lineage of the landing row: deterministic tie-break for duplicate keys
    T.StructField("_source_file", T.StringType(), True),
    T.StructField("_source_pos", T.LongType(), True),
])


def bronze_rows(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Project to the bronze schema: ``ingested_at`` defaults to now. Rows without key or
    payload break its NOT NULL constraints; the load reports them before
    (``landing.rejected_rows``), here they are kept out."""
    out = df.select(
        F.col("job_id").cast("string").alias("job_id"),
        F.col("source").cast("string").alias("source"),
        F.col("keyword").cast("string").alias("keyword"),
        F.col("country").cast("string").alias("country"),
        F.col("extracted_at").cast("timestamp").alias("extracted_at"),
        F.col("raw_data"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("ingested_at"),
        F.col("_source_file").cast("string").alias("_source_file"),
        F.col("_source_pos").cast("long").alias("_source_pos"),
    )
    return out.filter(F.col("job_id").isNotNull() & F.col("source").isNotNull()
                      & F.col("raw_data").isNotNull())


def materialize(df: DataFrame, path: str, as_view: str | None = None,
                partition_by: list[str] | None = None) -> DataFrame:
    """Full-refresh a layer table at ``path`` (parquet) and read it back, which cuts
    the lineage; optionally register a temp view of the written table."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    out = df.sparkSession.read.parquet(path)
    if as_view:
        out.createOrReplaceTempView(as_view)
    return out


LAYERS = ("bronze", "silver", "gold")


def save_layer_table(df: DataFrame, layer: str, name: str, as_view: bool = False) -> DataFrame:
    """Full refresh of ``<layer>.<name>`` in the session catalog (the warehouse keeps
    bronze, silver and gold in separate namespaces). ``as_view`` registers a temporary
    view ``<layer>_<name>`` instead of writing (a layer left as a view)."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    spark = df.sparkSession
    if as_view:
        df.createOrReplaceTempView(f"{layer}_{name}")
        return spark.table(f"{layer}_{name}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    df.write.mode("overwrite").format("parquet").saveAsTable(f"{layer}.{name}")
    return spark.table(f"{layer}.{name}")
