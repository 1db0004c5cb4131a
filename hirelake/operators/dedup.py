"""Keep-one-row-per-key operators (latest posting, first-seen id, cross-source).

Two forms. ``keep_first`` is ``row_number() == 1`` over a window; Spark plans that as a window
group limit that already drops all but the first row per key inside each input partition
before the shuffle. ``later_rows`` finds the rows that are not the first of their key without
moving payloads or sorting a key's rows anywhere: the first order of each key is a mergeable
minimum, and rows are compared with it by key and order, so a hot key spreads over all tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.session import scratch_path


def keep_first(df: DataFrame, keys: list[Column | str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def nulls_last(*cols: str) -> list[Column]:
    """Ascending order with nulls last, as parts of an order struct (where null is smallest)."""
    return [part for c in cols for part in (F.col(c).isNull(), F.col(c))]


def written(df: DataFrame, name: str) -> DataFrame:
    """Written and read back, so that its size is known when it is joined."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def same_row(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def later_rows(df: DataFrame, keys: list[str], order: list[Column], carry: list[str]) -> DataFrame:
    """``keys`` and ``carry`` of the rows that are not the first of their key in the ascending
    order of the struct ``order``, which must tell the rows of a key apart."""
    rows = df.select(*dict.fromkeys([*keys, *carry]), F.struct(*order).alias("_order"))
    firsts = rows.groupBy(*keys).agg(F.min("_order").alias("_first")) \
        .withColumnsRenamed({k: f"_of_{k}" for k in keys})
    first = same_row([*keys, "_order"], [*(f"_of_{k}" for k in keys), "_first"])
    return rows.join(firsts, first, "left_anti").drop("_order")


def older_rows(df: DataFrame, keys=("job_id", "source"), ts: str = "extracted_at",
               tie_break: tuple[str, ...] = ("_source_file", "_source_pos")) -> DataFrame:
    """Keys and lineage of the rows that a newer row of their key replaces; a NULL timestamp
    sorts first, as in PostgreSQL DESC."""
    newest = -F.unix_micros(ts)
    return later_rows(df, list(keys), [newest, *nulls_last(*tie_break)], list(tie_break))


def latest_per_key(df: DataFrame, keys=("job_id", "source"), ts: str = "extracted_at",
                   tie_break: tuple[str, ...] = ("_source_file", "_source_pos")) -> DataFrame:
    """Newest row per key. Lineage columns break ties, so the result does not depend on input
    order; they must tell the rows of a key apart.

    Only keys, time and lineage are shuffled. The rows replaced are written first, so their
    size is known when the wide rows are joined against them: few are broadcast, many
    shuffle both sides."""
    gone = written(older_rows(df, keys, ts, tie_break), "older-rows")
    gone = gone.withColumnsRenamed({c: f"_gone_{c}" for c in gone.columns})
    names = [*keys, *tie_break]
    return df.join(gone, same_row(names, [f"_gone_{c}" for c in names]), "left_anti")


def cross_source_key(title: Column, company: Column, city: Column) -> list[Column]:
    return [F.lower(F.trim(title)), F.lower(F.trim(company)), F.lower(city)]


def cross_source_dedup(df: DataFrame, title="job_title", company="company_name",
                       city="job_city", ts="job_posted_at_utc") -> DataFrame:
    """The same job listed on several boards (title, company and city agree): the board of
    the newest posting keeps its rows, those of other boards go. Postings of one board are
    never merged, and a posting without title, company or city is no one's copy. A NULL date
    is oldest; source and job id break ties.

    Each board's newest posting of a job is a mergeable minimum over narrow rows; the boards
    that lose a job are written, and the wide rows are anti-joined against them."""
    names = ["_title", "_company", "_city"]
    keys = dict(zip(names, cross_source_key(F.col(title), F.col(company), F.col(city))))
    newest = F.struct(F.col(ts).isNull(), -F.unix_micros(F.col(ts).cast("timestamp")), *nulls_last("source", "job_id"))
    complete = df.select(*[c.alias(n) for n, c in keys.items()], "source", newest.alias("_newest")) \
        .dropna(subset=names)
    boards = complete.groupBy(*names, "source").agg(F.min("_newest").alias("_newest"))
    best = boards.groupBy(*names).agg(F.min("_newest").alias("_best"), F.count(F.lit(1)).alias("_boards"))
    best = best.where("_boards > 1").withColumnsRenamed({n: f"_of{n}" for n in names})
    losers = boards.join(best, same_row(names, [f"_of{n}" for n in names])).where("_newest != _best")
    gone = written(losers.select(*[F.col(n).alias(f"_gone{n}") for n in names], F.col("source").alias("_gone_source")),
                   "losing-boards")
    lost = reduce(lambda a, b: a & b, [c == F.col(f"_gone{n}") for n, c in keys.items()])
    return df.join(gone, lost & F.col("source").eqNullSafe(F.col("_gone_source")), "left_anti")
