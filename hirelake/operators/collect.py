"""Collection-time operators over fetched job rows, as table operations:
keyword bucketing, envelopes, and collection counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.operators.dedup import later_rows, same_row, written

# Search keywords in collection order, landing country.
JOB_KEYWORDS = ["Data Engineer", "Data Analyst", "Backend", "Cloud", "DevOps"]
TARGET_COUNTRY = "austria"
ENVELOPE_CHUNK = 200  # consecutive fetch positions per envelope (bounds its size)


def bucket_keyword(title: Column, keywords: list[str] = JOB_KEYWORDS) -> Column:
    """First keyword, in list order, contained in the lower-cased title; else NULL."""
    t = F.lower(title)
    return F.coalesce(*[F.when(t.contains(k.lower()), F.lit(k)) for k in keywords])


def _fetch_order(boardless: str) -> list[Column]:
    """Keyword order, page, position; the board without keyword search has no keyword order."""
    rank = F.when(F.col("source") == boardless, F.lit(0)).otherwise(F.col("keyword_rank"))
    return [part for c in (rank, F.col("page"), F.col("position"), F.col("fetch_seq")) for part in (c.isNull(), c)]


def first_sights(log: DataFrame, columns: list[str], boardless: str = "arbeitnow") -> DataFrame:
    """The first sight of each id within its source: ``source, job_key`` and ``columns``. One
    mergeable minimum per id, so an id that is fetched again and again (rows without an id all
    share one) costs a row per task."""
    first = F.min(F.struct(*_fetch_order(boardless), F.struct(*columns).alias("_kept")))
    return log.groupBy("source", "job_key").agg(first.alias("_first")).select("source", "job_key", "_first._kept.*")


def tag_first_seen(log: DataFrame, boardless: str = "arbeitnow") -> DataFrame:
    """Fetched rows with ``is_first`` (first sight of an id within its source over keyword
    order, page, position) and ``title_keyword``. ``fetch_seq`` tells the rows of an id apart.
    The repeats are found on narrow rows and written; payloads stay in the task that read them."""
    keys = ["source", "job_key"]
    again = written(later_rows(log, keys, _fetch_order(boardless), ["fetch_seq"]), "repeats")
    names = [*keys, "fetch_seq"]
    again = again.select(*[F.col(c).alias(f"_again_{c}") for c in names], F.lit(True).alias("_again"))
    tagged = log.join(again, same_row(names, [f"_again_{c}" for c in names]), "left")
    return tagged.select(*log.columns, F.col("_again").isNull().alias("is_first"),
                         bucket_keyword(F.col("title")).alias("title_keyword"))


def own_keyword(rows: DataFrame, boardless: str = "arbeitnow") -> DataFrame:
    """Of the board without keyword search only rows under the keyword that their title
    contains; other boards' rows keep the keyword they were searched with."""
    own = F.col("source") == boardless
    found = rows.filter(~own | F.col("title_keyword").isNotNull())
    return found.withColumn("keyword", F.when(own, F.col("title_keyword")).otherwise(F.col("keyword")))


def kept_rows(tagged: DataFrame, boardless: str = "arbeitnow") -> DataFrame:
    """First sights, as :func:`own_keyword` keeps them."""
    return own_keyword(tagged.filter("is_first"), boardless)


def wrap_envelope(jobs: DataFrame, chunk_col: str = "fetch_seq",
                  chunk: int = ENVELOPE_CHUNK) -> DataFrame:
    """Envelopes ``(source, country, keyword, part, total_records, jobs)``: jobs of a
    (source, keyword) in parts of consecutive fetch positions, so no envelope outgrows
    ``chunk`` jobs; ``total_records`` is that of the whole (source, keyword) on every part.
    Empty groups produce nothing."""
    keys = ["source", "country", "keyword"]
    part = F.floor(F.col(chunk_col) / F.lit(chunk)).cast("long")
    parts = (jobs.withColumn("part", part).groupBy(*keys, "part")
             .agg(F.count(F.lit(1)).alias("_n"),
                  F.array_sort(F.collect_list(F.struct(F.col(chunk_col).alias("seq"),
                                                       F.col("raw_data").alias("raw"))),
                               lambda a, b: F.when(a["seq"] < b["seq"], -1)
                               .when(a["seq"] > b["seq"], 1).otherwise(0)).alias("_jobs")))
    # the totals are joined back: a window over the parts would move all jobs of a keyword to one task
    totals = jobs.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_records"))
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    return parts.alias("p").join(totals.alias("t"), same).select(
        *[F.col(f"p.{k}") for k in keys], "part", "total_records",
        F.transform("_jobs", lambda s: s["raw"]).alias("jobs"))


def collection_counters(tagged: DataFrame, boardless: str = "arbeitnow") -> DataFrame:
    """Per (source, searched keyword, page): fetched rows, first sights kept, repeated ids and
    first sights whose title has no keyword (these three add up to the fetched rows), the kept
    rows so far over the pages, and the unique ids of the source. The board without keyword
    search has NULL as keyword."""
    own = F.col("source") == boardless
    first = F.col("is_first")
    unmatched = first & own & F.col("title_keyword").isNull()
    counted = (tagged.withColumn("keyword", F.when(~own, F.col("keyword")))
               .groupBy("source", "keyword", "page")
               .agg(F.count(F.lit(1)).alias("n_fetched"),
                    F.count_if(first & ~unmatched).alias("n_kept"),
                    F.count_if(~first).alias("n_duplicate"),
                    F.count_if(unmatched).alias("n_unmatched"),
                    F.count_if(first).alias("_n_first")))
    pages = (Window.partitionBy("source", "keyword").orderBy("page")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (counted.withColumn("running_total", F.sum("n_kept").over(pages))
            .withColumn("n_unique_ids", F.sum("_n_first").over(Window.partitionBy("source")))
            .drop("_n_first"))
