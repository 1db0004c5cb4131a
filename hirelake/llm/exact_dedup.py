"""Exact deduplication with a stateful stream.

Rows arrive as (digest, stable id, content locator). A streaming aggregation keeps, per
digest, the largest id seen, where that row's content lies, and how many rows came; its
state lives on disk (RocksDB) under the stream's checkpoint and never expires, so a later
run over new rows with the same ``state_dir`` continues it. Rows whose digest was hit more
than once are then compared by their full bytes: where one digest covers several texts,
each text gets its own group.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import staged, table
from hirelake.session import checkpoint_root, scratch_path

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
INDEX = "digest binary, keeper struct<doc_id: bigint, file: string, row: bigint>, n bigint"
CARRIED_CONF = ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone")


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame, columns: list[Column], from_files: bool) -> DataFrame:
    """``columns`` with a content locator (file, row): a row's file and its position there.
    Unless ``docs`` is a plain read of files, it is written to the shared folder first."""
    if not from_files:
        docs = staged(docs, "located")
    return docs.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own, so the state store settings do not touch the caller's."""
    own = spark.newSession()
    for key in CARRIED_CONF:
        value = spark.conf.get(key, None)
        if value is not None:
            own.conf.set(key, value)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    # many small stores: none stays open after its task, no space is set aside in advance
    own.conf.set("spark.sql.streaming.stateStore.unloadOnCommit", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB", "16")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "256")
    return own


def run_state(arrivals: DataFrame, state_dir: str) -> DataFrame:
    """Add the rows (digest, doc_id, file, row) to the stateful stream at ``state_dir`` and
    return its index: digest, keeper (doc_id, file, row), n, over all rows ever added.

    Every micro-batch writes the groups it changed under its own number, so a batch that is
    replayed after a failure overwrites itself; the newest state of a group has the largest n.
    """
    own = _stream_session(arrivals.sparkSession)
    arrivals.write.parquet(f"{state_dir}/arrivals/run-{uuid.uuid4().hex[:12]}")
    index_dir = f"{state_dir}/index"
    changed = (own.readStream.schema(arrivals.schema).parquet(f"{state_dir}/arrivals/*")
               .groupBy("digest")
               .agg(F.max(F.struct("doc_id", "file", "row")).alias("keeper"), F.count(F.lit(1)).alias("n")))
    query = (changed.writeStream.outputMode("update").trigger(availableNow=True)
             .option("checkpointLocation", f"{state_dir}/state")
             .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{index_dir}/batch={number}"))
             .start())
    query.awaitTermination()
    index = arrivals.sparkSession.read.schema(INDEX).parquet(index_dir)
    return index.groupBy("digest").agg(F.max(F.struct("n", "keeper")).alias("_newest")).select(
        "digest", F.col("_newest.keeper").alias("keeper"), F.col("_newest.n").alias("n"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha256_digest,
                 state_dir: str | None = None, from_files: bool = False) -> DataFrame:
    """Groups of equal texts, one row per input row: ``doc_id, digest, file, row, keep_id,
    group_size, kept``.

    Of equal texts the row with the largest id is kept. A null text counts as empty; a null
    id is smaller than any other; of rows that repeat id and text the last place (file, row)
    is kept and the others go. Texts are equal when identical: nothing is normalised. An
    empty table gives no rows; other columns of the input are not looked at. With the
    ``state_dir`` of an earlier run its rows count too (their bytes were compared then).
    ``from_files``: ``docs`` is a plain read of files, whose places serve as locators.
    """
    spark = docs.sparkSession
    state_dir = state_dir or scratch_path(spark, "exact-state")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = located(docs, [F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                          digest(text).alias("digest")], from_files)
    arrivals = staged(rows.select("digest", "doc_id", "file", "row"), "arrivals")
    index = staged(run_state(arrivals, state_dir), "exact-index")
    # full bytes on hits: equal copies fold together before the shuffle
    hits = index.where("n > 1").select("digest")
    texts = rows.join(hits, "digest", "left_semi").groupBy("digest", "text").count()
    shared = staged(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("_texts"))
                    .where("_texts > 1").select("digest"), "shared-digests")
    grouped = arrivals.join(index, "digest")
    if not shared.isEmpty():
        clash = rows.join(shared, "digest", "left_semi")
        by_text = clash.groupBy("digest", "text").agg(
            F.max(F.struct("doc_id", "file", "row")).alias("keeper"), F.count(F.lit(1)).alias("n"))
        apart = clash.join(by_text, ["digest", "text"]).select(*grouped.columns)
        grouped = grouped.join(shared, "digest", "left_anti").unionByName(apart)
    is_keeper = (F.col("file") == F.col("keeper.file")) & (F.col("row") == F.col("keeper.row"))
    return grouped.select("doc_id", "digest", "file", "row", F.col("keeper.doc_id").alias("keep_id"),
                          F.col("n").alias("group_size"), is_keeper.alias("kept"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                from_files: bool = False) -> DataFrame:
    """The kept rows with all their columns: the places of dropped rows are removed."""
    if not from_files:
        docs = staged(docs, "located")
    dropped = exact_groups(docs, id_col, text_col, from_files=True).where("NOT kept").select(
        F.col("file").alias("_file"), F.col("row").alias("_row"))
    whole = located(docs, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")], from_files=True)
    return whole.withColumnsRenamed({"file": "_file", "row": "_row"}).join(
        dropped, ["_file", "_row"], "left_anti").select("_doc.*")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_root(spark)
    groups = exact_groups(table(spark, sf_dir, "documents"), from_files=True)
    return groups.select("doc_id", "keep_id", "group_size", "kept",
                         F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE_SQL = f"""SELECT doc_id, _keep_id AS keep_id, _group_size AS group_size, _kept AS kept,
  _sha AS text_sha256 FROM (
  SELECT *, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS _keep_id,
         count(*) OVER (PARTITION BY coalesce(text, '')) AS _group_size,
         row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS _kept,
         sha256(coalesce(text, '')) AS _sha FROM documents) d"""
