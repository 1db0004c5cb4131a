"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies (target words over the
source's words). The expected copies are prefix-summed along a fixed order inside the
source, one offset per source is added, and a document is emitted once per integer
boundary its interval crosses.

The prefix sum is built in two levels, so no source is ever ordered in one task: documents
are dealt by a digest of their id into runs of about ``rows_per_run`` rows, each run is
ordered by size on its own, and only the row counts of the runs are accumulated per source.
Ordering by size inside a run spreads the copies evenly over short and long documents,
which keeps a source's taken words near its target.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelake.llm.common import table, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
ROWS_PER_RUN = 20_000
SEED = "mix-1"
_HASH_RANGE = 1 << 32


def _hash32(value: Column, seed: str) -> Column:
    """First 32 bits of an MD5 digest, as a long: the same in every engine."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(value.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Targets per source from (_skey, _total): shares of all words by weight, none above
    ``max_repeat`` times the source, the excess shared out again by weight.

    With sources in ascending order of limit per weight, the limited ones are a prefix:
    a source is limited when the level reached by all sources from it on is above its own
    limit per weight. The rest share one level. One row per source is all that is windowed.
    """
    by_name = Window.orderBy("_skey")
    by_ratio = Window.orderBy("_ratio", "_skey")
    everything = Window.partitionBy(F.lit(1)).orderBy("_ratio", "_skey").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    limit = (F.col("_total") * max_repeat).cast("double")
    ranked = (sizes.withColumn("_w", weight).withColumn("_limit", limit)
              .withColumn("_ratio", F.col("_limit") / F.col("_w")))
    level = ((F.sum("_total").over(everything) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
             / F.sum("_w").over(after))
    leveled = ranked.withColumn("_level", level)
    free = F.col("_level") <= F.col("_ratio")
    common = F.first(F.when(free, F.col("_level")), ignorenulls=True).over(everything)
    return (leveled.withColumn("_common", common)
            .withColumn("_target", F.when(free, F.col("_common") * F.col("_w")).otherwise(F.col("_limit")))
            .withColumn("_rate", F.when(F.col("_total") > 0, F.col("_target") / F.greatest(
                F.col("_total"), F.lit(1))).otherwise(F.lit(0.0)))
            .select("_skey", "_total", "_target", "_rate"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED,
        rows_per_run: int = ROWS_PER_RUN, carry_rows: bool = False) -> DataFrame:
    """Number of copies the mix takes of every document.

    Returns one row per input row: ``doc_id, size, source_size, target, copies, taken``, and
    with ``carry_rows`` the input row as struct ``row`` (so that names in the input never
    clash). A null or blank text has size 0 and takes 0 words whatever its copies; a null
    source is a source of its own, last in order; a null id is dealt like an empty one; an
    empty table gives no rows; repeated rows are separate documents.
    """
    n_runs = max(1, math.ceil(docs.count() / rows_per_run))
    skey = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col)))
    keep = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")] if carry_rows else []
    rows = docs.select(F.col(id_col).alias("_id"), word_count(F.col(text_col)).alias("_size"),
                       skey.alias("_skey"),
                       (_hash32(F.col(id_col), seed) % n_runs).alias("_run"), *keep)
    runs = rows.groupBy("_skey", "_run").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_words"))
    targets = source_targets(runs.groupBy("_skey").agg(F.sum("_words").alias("_total")), weights, max_repeat)
    earlier = Window.partitionBy("_skey").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("_skey", "_run", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    starts = starts.join(targets, "_skey")
    # the join repeats the window's keys: the documents are shuffled once
    order = Window.partitionBy("_skey", "_run").orderBy("_size", "_id")
    placed = rows.withColumn("_rank", F.row_number().over(order)).join(starts, ["_skey", "_run"])
    offset = (_hash32(F.col("_skey"), seed) + 0.5) / float(_HASH_RANGE)
    position = F.col("_start") + F.col("_rank")
    copies = (F.floor(offset + position * F.col("_rate"))
              - F.floor(offset + (position - 1) * F.col("_rate"))).cast("long")
    return placed.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"),
                         F.col("_total").alias("source_size"), F.col("_target").alias("target"),
                         copies.alias("copies"), (F.col("_size") * copies).alias("taken"),
                         *([F.col("_row").alias("row")] if carry_rows else []))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every input row as often as :func:`mix` takes it, columns unchanged."""
    taken = mix(docs, carry_rows=True, **options).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op6_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


def mix_sql(docs: str, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED,
            rows_per_run: int = ROWS_PER_RUN) -> str:
    """DuckDB form of :func:`mix` over the relation ``docs``; keeps that relation's columns."""
    def hash32(value: str) -> str:
        return f"('0x' || substr(md5('{seed}:' || coalesce({value}, '')), 1, 8))::BIGINT"
    weight = " ".join(f"WHEN {i} THEN {float(w)}::DOUBLE" for i, w in enumerate(weights))
    return f"""
WITH sized AS (
  SELECT *, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS _size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS _skey,
         {hash32('doc_id::VARCHAR')} % greatest(1, ceil((SELECT count(*) FROM {docs}) / {rows_per_run}.0))::BIGINT AS _run
  FROM {docs}),
totals AS (SELECT _skey, sum(_size)::BIGINT AS _total FROM sized GROUP BY 1),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY _skey) - 1) % {len(weights)} {weight} END AS _w,
         (_total * {max_repeat})::DOUBLE AS _limit FROM totals),
ratioed AS (SELECT *, _limit / _w AS _ratio FROM weighted),
leveled AS (
  SELECT *, ((SELECT sum(_total) FROM totals)::DOUBLE - coalesce(sum(_limit) OVER (
               ORDER BY _ratio, _skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(_w) OVER (ORDER BY _ratio, _skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS _level
  FROM ratioed),
targets AS (
  SELECT _skey, _total, CASE WHEN _level <= _ratio THEN _w * (
           SELECT arg_min(_level, (_ratio, _skey)) FROM leveled WHERE _level <= _ratio) ELSE _limit END AS _target
  FROM leveled),
placed AS (
  SELECT s.*, t._total, t._target, CASE WHEN t._total > 0 THEN t._target / t._total ELSE 0 END AS _rate,
         row_number() OVER (PARTITION BY s._skey ORDER BY s._run, s._size, s.doc_id NULLS FIRST) AS _pos,
         ({hash32('s._skey')} + 0.5) / {float(_HASH_RANGE)} AS _offset
  FROM sized s JOIN targets t USING (_skey))
SELECT *, (floor(_offset + _pos * _rate) - floor(_offset + (_pos - 1) * _rate))::BIGINT AS _copies FROM placed"""


ORACLE_SQL = f"""SELECT doc_id, _size AS size, _total AS source_size, _target AS target,
  (_size * _copies)::BIGINT AS taken, _copies AS copies FROM ({mix_sql('documents')}) m"""
