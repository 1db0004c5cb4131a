"""Landing lake: JSON files under ``<root>/<source>/<country>/YYYY/MM/DD/``.

Two file layouts are read with one schema:

* envelope files (one pretty-printed object per file: ``extracted_at, source,
  country, keyword, total_records, jobs[]``), as job-board collectors write them;
* job-per-line files written by ``write_landing``: the envelope fields repeated on
  every job row, so writing never gathers a whole (source, keyword) group into one
  record.

Payloads are VARIANT: sources disagree on field types (an object here, a string
there), which one inferred struct cannot hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions.json_paths import json_text
from hirelake.session import apply_sql_defaults
from hirelake.sources.split_envelope import read_split_envelopes

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("extracted_at", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("keyword", T.StringType()),
    T.StructField("total_records", T.LongType()),
    T.StructField("jobs", T.ArrayType(T.VariantType())),
    T.StructField("job", T.VariantType()),
    T.StructField("_corrupt_record", T.StringType()),
])

# Folder levels written by ``write_landing`` (Spark writes key=value folders; the
# envelope fields stay in the rows as well).
PARTITION_COLUMNS = ["p_source", "p_country", "year", "month", "day", "keyword_slug"]


# Tasks that may write into one folder.
FOLDER_WRITERS = 16


def day_glob(root: str, day: str | None = None, source: str = "*", country: str = "*",
             layout: str = "spark") -> str:
    """Path glob of one day's files (``day`` as YYYY-MM-DD) under any source/country.
    Listing is pruned by the glob itself. ``layout="plain"`` is the collector layout
    ``source/country/YYYY/MM/DD/<keyword>_jobs.json``."""
    r = root.rstrip("/")
    y, m, d = day.split("-") if day else ("*", "*", "*")
    if layout == "plain":
        return f"{r}/{source}/{country}/{y}/{m}/{d}/*.json"
    return (f"{r}/p_source={source}/p_country={country}/year={y}/month={m}/day={d}/"
            f"keyword_slug=*/*")


def read_landing(spark: SparkSession, root: str, day: str | None = None,
                 layout: str = "spark", split_bytes: int | None = None) -> DataFrame:
    """Raw landing rows with their file path; unparsable files are kept as
    ``_corrupt_record`` rows (see ``split_corrupt``). Envelope files are one JSON
    document each (multi-line); job-per-line files are JSON lines. Of a key that a
    payload repeats the last value counts (``apply_sql_defaults``). With ``split_bytes``
    envelope files above that size are read in parts by many tasks, as one row per job
    with its place in the file (``split_envelope``)."""
    apply_sql_defaults(spark)
    glob = day_glob(root, day, layout=layout)
    rows = (spark.read.schema(ENVELOPE_SCHEMA)
            .option("multiLine", layout == "plain").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(glob))
    if split_bytes is None or layout != "plain":
        return rows.withColumn("_source_file", F.col("_metadata.file_path"))
    small = rows.where(F.col("_metadata.file_size") <= split_bytes).withColumn(
        "_source_file", F.col("_metadata.file_path"))
    return small.unionByName(read_split_envelopes(spark, glob, split_bytes), allowMissingColumns=True)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, corrupt rows): a bad file is reported, the others still load.
    A record that did not parse to its end is corrupt unless its jobs are there whole
    (only a field beside them was of the wrong type)."""
    bad = F.col("_corrupt_record").isNotNull() & F.col("jobs").isNull() & F.col("job").isNull()
    if "_source_offset" in df.columns:
        # a job of a split file that does not parse is a job without payload
        df = df.withColumn("jobs", F.when(F.col("_source_offset").isNotNull() & ~bad, F.array("job")).otherwise(F.col("jobs")))
    return (df.filter(~bad).drop("_corrupt_record"),
            df.filter(bad).select("_source_file", "_corrupt_record"))


def explode_jobs(df: DataFrame) -> DataFrame:
    """One row per job: envelope ``jobs`` elements (missing list = no rows) or the
    ``job`` of a job-per-line row; envelope fields repeated; position kept."""
    jobs = F.coalesce(F.col("jobs"), F.when(F.col("job").isNotNull(), F.array(F.col("job"))))
    if "_source_offset" in df.columns:
        return df.select("source", "country", "keyword", "extracted_at", "_source_file", "_source_offset",
                         F.posexplode(jobs).alias("_pos", "raw_data")).withColumn(
            "_source_pos", F.coalesce("_source_offset", "_pos")).drop("_source_offset", "_pos")
    return df.select("source", "country", "keyword", "extracted_at", "_source_file",
                     F.posexplode(jobs).alias("_source_pos", "raw_data"))


# JSON texts of the values that Python treats as false.
FALSY = r'^(null|false|""|\[\]|\{\}|-?0+(\.0+)?([eE][+-]?[0-9]+)?)$'


def _truthy_text(raw: Column, path: str) -> Column:
    """Text of a field when Python would treat the value as true (not null, "", 0,
    false, empty list/object); else NULL. The string "0" is true: its JSON text has quotes."""
    value = F.to_json(F.try_variant_get(raw, path, "variant"))
    return F.when(~value.rlike(FALSY), json_text(raw, path))


def with_natural_key(df: DataFrame) -> DataFrame:
    """``job_id = str(id or slug)``; NULL where a row has neither."""
    raw = F.col("raw_data")
    key = F.coalesce(_truthy_text(raw, "$.id"), _truthy_text(raw, "$.slug"))
    return df.withColumn("job_id", key)


def natural_key(df: DataFrame) -> DataFrame:
    """``job_id = str(id or slug)``; rows with neither are dropped."""
    return with_natural_key(df).filter(F.col("job_id").isNotNull())


def keyword_slug(keyword: Column) -> Column:
    return F.replace(F.lower(keyword), F.lit(" "), F.lit("_"))


def write_landing(jobs: DataFrame, root: str, extracted_at: Column | None = None) -> None:
    """Write job rows (``source, country, keyword, raw_data``) as one JSON line per job
    under ``source/country/YYYY/MM/DD/keyword_slug``. Dynamic partition overwrite: a
    rerun of the same day and keyword replaces those files, others stay."""
    ts = extracted_at if extracted_at is not None else F.current_timestamp()
    out = jobs.select(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("extracted_at"),
        "source", "country", "keyword",
        F.col("raw_data").alias("job"),
        F.col("source").alias("p_source"), F.col("country").alias("p_country"),
        F.date_format(ts, "yyyy").alias("year"), F.date_format(ts, "MM").alias("month"),
        F.date_format(ts, "dd").alias("day"), keyword_slug(F.col("keyword")).alias("keyword_slug"))
    # a folder's rows are gathered by a hash of folder and payload: few files per folder,
    # and a folder with most of the rows is still written by many tasks
    salt = F.pmod(F.xxhash64(F.col("job").cast("string")), F.lit(FOLDER_WRITERS))
    (out.repartition(*PARTITION_COLUMNS, salt).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION_COLUMNS).json(root))


REJECT_REASONS = ("corrupt", "no_payload", "no_source", "no_key", "bad_timestamp")


def judged_rows(raw: DataFrame) -> DataFrame:
    """Every job of the landing rows, and every corrupt record, with ``reject_reason``: NULL
    for a row that a bronze load receives, else the first reason that holds. ``raw_text`` is
    the text of a corrupt record."""
    good, bad = split_corrupt(raw)
    rows = with_natural_key(explode_jobs(good))
    stamp = F.col("extracted_at").try_cast("timestamp")
    reason = (F.when(F.col("raw_data").isNull(), "no_payload")
              .when(F.col("source").isNull(), "no_source")
              .when(F.col("job_id").isNull(), "no_key")
              .when(F.col("extracted_at").isNotNull() & stamp.isNull(), "bad_timestamp"))
    judged = rows.select("job_id", "source", "keyword", "country", stamp.alias("extracted_at"), "raw_data",
                         "_source_file", F.col("_source_pos").cast("long").alias("_source_pos"),
                         F.lit(None).cast("string").alias("raw_text"), reason.alias("reject_reason"))
    none = {c: F.lit(None).cast(judged.schema[c].dataType).alias(c) for c in judged.columns}
    none |= {"_source_file": F.col("_source_file"), "raw_text": F.col("_corrupt_record").alias("raw_text"),
             "reject_reason": F.lit("corrupt").alias("reject_reason")}
    return judged.unionByName(bad.select(*[none[c] for c in judged.columns]))


def accepted_rows(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reject_reason").isNull()).drop("reject_reason", "raw_text")


def rejected_rows(judged: DataFrame) -> DataFrame:
    """The report of what a load leaves out."""
    return judged.filter(F.col("reject_reason").isNotNull())


def landing_rows(spark: SparkSession, root: str, day: str | None = None,
                 layout: str = "spark", split_bytes: int | None = None) -> DataFrame:
    """Read, explode and key: the rows a bronze load receives. What is left out is what
    ``rejected_rows(judged_rows(...))`` reports."""
    return accepted_rows(judged_rows(read_landing(spark, root, day, layout, split_bytes)))
