"""Spelling variants: words one letter apart, grouped under their commonest form.

Near words are searched with bit-sliced position indexes: for a set of words, one bitset per
(position, letter) of those that have the letter there. A word is read letter by letter while
four bitsets move along it in step: words equal so far, and words with exactly one replaced,
one additional or one missing letter so far, the latter two with positions shifted by one.
So one reading compares a word with all words of its set at once.

The vocabulary is cut into sets that lose no pair. Two near words, the shorter one of m
letters, differ at one place; with the m letters cut into segments, they agree on everything
before and after the segment that holds the place. Each word goes to the sets of its segments,
once as the shorter and once as the longer word; sets that are too large are cut again by
halves of their segment, down to single letters. A pair that several segments explain counts in
the last one only: where the zero-error bitset does not yet reach past the segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import crc32_sql, ship_by_value, staged, table

RUN = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP_ONE_IN = 97
MIN_LETTERS = 5
MIN_COUNT = 3
RATIO = 2
# Words of a set that are searched together; a larger set is cut again.
SET_WORDS = 4096


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
                drop_one_in: int = DROP_ONE_IN) -> DataFrame:
    """(word, n): letter runs of whole texts, A-Z lower-cased; a run whose checksum with the
    document's id is a multiple of ``drop_one_in`` loses the letter that the checksum picks."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all("text", F.lit(f"{RUN}{{{min_letters},}}"), F.lit(0))).alias("run"))
    # lower() is right and fast where no letter beyond Z has a lower-case form
    low = F.when(F.col("run").rlike(r"[À-Þ]"), F.translate("run", UPPER, LOWER)).otherwise(F.lower("run"))
    sums = runs.select(low.alias("run"), F.crc32(F.concat("id", F.lit(":"), low).cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = sums.select(F.when(F.col("h") % drop_one_in == 0, cut).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def _bounds(short: Column, level: Column, segment: Column) -> tuple[Column, Column]:
    """First letter of a segment and the one after it, of 2^level segments of ``short`` letters."""
    parts = F.pow(F.lit(2.0), level)
    return tuple(F.floor(short * s / parts).cast("int") for s in (segment, segment + 1))


def _keyed(rows: DataFrame) -> DataFrame:
    """``key`` of the set of rows (word, n, short, level, segment): what the words must share."""
    start, end = _bounds(F.col("short"), F.col("level"), F.col("segment"))
    tail = F.col("short") - end
    key = F.concat_ws("|", F.col("short").cast("string"), F.col("level").cast("string"), F.col("segment").cast("string"),
                      F.substring("word", F.lit(1), start),
                      F.substring("word", F.length("word") - tail + 1, tail))
    return rows.withColumns({"key": key, "end": end})


def word_sets(words: DataFrame, set_words: int = SET_WORDS) -> DataFrame:
    """Rows (word, n, short, level, segment, key, end): each word in its sets of at most about
    ``set_words`` words. Only words of sets that are still too large are dealt again."""
    size = F.length("word")
    halves = F.explode(F.array(*[F.struct((size - less).alias("short"), F.lit(1).alias("level"), F.lit(s).alias("segment"))
                                 for less in (0, 1) for s in (0, 1)]))
    rows = staged(_keyed(words.select("word", "n", halves.alias("at")).select("word", "n", "at.*")), "variant-sets")
    done = []
    while True:
        large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("short").alias("short"),
                                        F.min("level").alias("level"))
        # a segment of one letter cannot be cut
        large = staged(large.where((F.col("members") > set_words) & (F.pow(F.lit(2.0), "level") < F.col("short")))
                       .select("key"), "variant-large")
        if large.isEmpty():
            break
        done.append(rows.join(large, "key", "left_anti"))
        again = rows.join(large, "key", "left_semi").select(
            "word", "n", "short", (F.col("level") + 1).alias("level"),
            F.explode(F.array(F.col("segment") * 2, F.col("segment") * 2 + 1)).alias("segment"))
        rows = staged(_keyed(again), "variant-sets")
    for part in done:
        rows = rows.unionByName(part.select(rows.columns))
    return rows


class SliceIndex:
    """Bit-sliced position index of a list of words: bit i stands for word i."""

    def __init__(self, words: list[str]) -> None:
        self.slices: dict[tuple[int, str], int] = {}
        self.of_length: dict[int, int] = {}
        self.all = (1 << len(words)) - 1
        for i, word in enumerate(words):
            for at in enumerate(word, 1):
                self.slices[at] = self.slices.get(at, 0) | 1 << i
            self.of_length[len(word)] = self.of_length.get(len(word), 0) | 1 << i

    def near(self, word: str, end: int) -> tuple[int, int]:
        """Bitset of the words one letter apart from ``word``, and that of the words equal to it
        in its first ``end`` letters."""
        equal, replaced, added, missing, up_to_end = self.all, 0, 0, 0, self.all
        find = self.slices.get
        for k, letter in enumerate(word, 1):
            same, after = find((k, letter), 0), find((k + 1, letter), 0)
            # the error happens at this letter, or has happened and this letter agrees
            replaced = replaced & same | equal & ~same
            added = (added | equal) & after
            missing = (missing & find((k - 1, letter), 0)) | equal
            equal &= same
            if k == end:
                up_to_end = equal
        m = len(word)
        longer, shorter = self.of_length.get(m + 1, 0), self.of_length.get(m - 1, 0)
        return (replaced & self.of_length.get(m, 0)) | ((added | equal) & longer) | (missing & shorter), up_to_end


def _bits(members: int) -> Iterator[int]:
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


def search_set(words: list[str], counts: list[int], short: int, end: int) -> Iterator[tuple[str, int, str, int]]:
    """(word, near words, the largest of them, its count) of each word that has any in its set.
    Of a pair one word at least has ``short`` letters, and only pairs that agree no further
    than before ``end`` count, unless the segment is the last."""
    index = SliceIndex(words)
    of_short = index.of_length.get(short, 0)
    if not of_short:
        return
    for word in words:
        near, agreed = index.near(word, end)
        if len(word) > short:
            near &= of_short
        if end < short:
            near &= ~agreed
        if near:
            best = min(_bits(near), key=lambda i: (-counts[i], words[i]))
            yield word, near.bit_count(), words[best], counts[best]


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets are runs of equal keys; one set at a time is held."""
    def found(key: tuple | None, words: list[str], counts: list[int]) -> list[tuple]:
        return list(search_set(words, counts, key[1], key[2])) if len(words) > 1 else []

    key, words, counts = None, [], []
    for batch in batches:
        rows: list[tuple] = []
        for *at, word, n in zip(*(batch.column(c).to_pylist() for c in ("key", "short", "end", "word", "n"))):
            if at != key:
                rows += found(key, words, counts)
                key, words, counts = at, [], []
            words.append(word)
            counts.append(n)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _NEAR)], schema=_NEAR)
    if rows := found(key, words, counts):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _NEAR)], schema=_NEAR)


def near_words(words: DataFrame, set_words: int = SET_WORDS) -> DataFrame:
    """(word, n_near, form, form_n) of the words with a near one; ``form`` is the near word of
    largest count, of equal ones the smallest. Each set gives one row per word, not per pair."""
    sets = word_sets(words, set_words).select("key", "short", "end", "word", "n")
    found = sets.repartition("key").sortWithinPartitions("key").mapInArrow(
        _search, "word string, n_near long, form string, form_n long")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct(
        (-F.col("form_n")).alias("less"), F.col("form"))).alias("best")).select(
            "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def follow_forms(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms are followed to the last. Counts at least double
    along a chain, so it ends; every round doubles the length that is followed."""
    hops = staged(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "variant-hops")
    while True:
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(hops.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-hops")
        hops = step.select("word", "root")
        if step.where("moved").isEmpty():
            return hops


def spelling_variants(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: float = RATIO,
                      drop_one_in: int = DROP_ONE_IN, set_words: int = SET_WORDS) -> DataFrame:
    """One row per word of ``docs`` (columns ``doc_id, text``): ``word, form, root, n, n_near,
    form_n``.

    Words come from :func:`word_counts`. Words are near if one inserted, deleted or replaced
    letter makes one the other. ``form`` is the near word of largest count (ties: smallest in
    code-point order) if that is at least ``ratio`` times the word's own count, else null;
    ``root`` is the last of the chain of forms, the word itself without a form. A null text has no
    words, a null id counts as empty, repeated rows count as often as they stand, other columns are
    not read, an empty table gives no rows.
    """
    words = staged(word_counts(docs, min_letters, min_count, drop_one_in), "variant-words")
    near = words.join(near_words(words, set_words), "word", "left")
    is_form = F.col("form_n") >= ratio * F.col("n")
    judged = staged(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                *[F.when(is_form, F.col(c)).alias(c) for c in ("form", "form_n")]), "variant-forms")
    return judged.join(follow_forms(judged), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


# Near pairs by shared deletions: at the same place of equally long words, or of the longer one.
ORACLE_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(
         coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
sums AS (SELECT run, {crc32_sql("(id || ':' || run)")} AS h FROM runs),
words AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % {DROP_ONE_IN} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                ELSE run END AS word FROM sums) w
  WHERE length(word) >= {MIN_LETTERS} GROUP BY 1 HAVING count(*) >= {MIN_COUNT}),
cuts AS (
  SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest
  FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS k FROM words) p),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN cuts b ON b.rest = a.word),
near AS (SELECT word, count(*) AS n_near, min((-n, other)) AS best FROM pairs GROUP BY 1),
forms AS (
  SELECT w.word, w.n, coalesce(p.n_near, 0) AS n_near,
         CASE WHEN -p.best[1] >= {RATIO} * w.n THEN p.best[2] END AS form,
         CASE WHEN -p.best[1] >= {RATIO} * w.n THEN -p.best[1] END AS form_n
  FROM words w LEFT JOIN near p USING (word)),
chain AS (
  SELECT word, word AS root, form FROM forms
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.form)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.form IS NULL"""

ship_by_value(__name__)
