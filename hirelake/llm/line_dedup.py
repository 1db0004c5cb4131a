"""Line deduplication by pairwise alignment.

Pairs of documents are aligned by patience diff over line hashes, and common blocks of enough
words are deleted from the later document. The result is that of aligning each document with
every earlier one. Any such block is covered by runs of lines that hold just enough words, so
only documents that share such a run can have one. An alignment starts at equal first or last
lines or at a line that stands once in both documents. So holders of a run meet by the run where
it has no line that repeats inside its document, and else only if they share such a start too.
Each later holder of a run meets the run's first holder; where lines of the run stay (they cross
others there, or repeat), it meets more and more of the other earlier holders, in rounds, until
its lines are gone or all were met.
Only hashes travel; the texts are read once more at the end to cut the lines out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import ship_by_value, staged, table, word_count

# An aligned block is deleted from this many words on.
MIN_BLOCK_WORDS = 10
# Holders of a run that a document has met by the end of each round grow by this factor.
ROUND_GROWTH = 8
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


def _anchors(old: list[int], new: list[int]) -> list[tuple[int, int]]:
    """Longest rising chain of lines that occur once in each sequence (patience sorting)."""
    first: dict[int, int] = {}
    twice = set()
    for k, h in enumerate(old):
        if h in first:
            twice.add(h)
        first[h] = k
    place: dict[int, int] = {}
    for k, h in enumerate(new):
        if h in place:
            twice.add(h)
        place[h] = k
    piles: list[int] = []
    tops: list[tuple[int, int, int]] = []  # old position, new position, index of the chain's previous link
    ends: list[int] = []
    for h, k in place.items():
        if h in first and h not in twice:
            at = bisect_left(piles, first[h])
            link = (first[h], k, ends[at - 1] if at else -1)
            tops.append(link)
            if at == len(piles):
                piles.append(first[h])
                ends.append(len(tops) - 1)
            else:
                piles[at], ends[at] = first[h], len(tops) - 1
    chain = []
    at = ends[-1] if ends else -1
    while at >= 0:
        old_at, new_at, at = tops[at]
        chain.append((old_at, new_at))
    return chain[::-1]


def patience_align(old: list[int], new: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of equal lines: equal ends are matched, unique common lines split the
    rest, and each part between them is aligned in turn. Parts without a unique common line
    stay unaligned beyond their equal ends."""
    found: list[tuple[int, int]] = []
    work = [(0, len(old), 0, len(new))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and old[a] == new[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and old[b - 1] == new[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        chain = _anchors(old[a:b], new[c:d])
        at, ct = a, c
        for x, y in chain:
            work.append((at, a + x, ct, c + y))
            found.append((a + x, c + y))
            at, ct = a + x + 1, c + y + 1
        if chain:
            work.append((at, b, ct, d))
    return sorted(found, key=lambda f: f[1])


def _deleted_lines(min_words: int):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places = [], []
            columns = (batch.column(c).to_pylist() for c in range(4))
            for later, old, new, words in zip(*columns, strict=True):
                block: list[int] = []
                gone: list[int] = []
                last = (-2, -2)
                for x, y in [*patience_align(old, new), (-9, -9)]:
                    if (x, y) != (last[0] + 1, last[1] + 1):
                        if sum(words[k] for k in block) >= min_words:
                            gone += block
                        block = []
                    block.append(y)
                    last = (x, y)
                if gone:
                    rows.append(later)
                    places.append(gone)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(places, pa.list_(pa.int32()))],
                                             names=["id", "gone"])
    return align


def _spans(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """For each line the shortest run of enough words that starts there and the shortest that
    ends there: each longer run is covered by those inside it. Time is linear in the lines."""
    sums = [0]
    for w in words:
        sums.append(sums[-1] + w)
    spans = set()
    stop = 1
    for start in range(len(words)):
        stop = max(stop, start + 1)
        while stop < len(words) and sums[stop] - sums[start] < min_words:
            stop += 1
        if sums[stop] - sums[start] >= min_words:
            spans.add((start, stop))
    start = 0
    for stop in range(1, len(words) + 1):
        while start + 1 < stop and sums[stop] - sums[start + 1] >= min_words:
            start += 1
        if sums[stop] - sums[start] >= min_words:
            spans.add((start, stop))
    return sorted(spans)


def _runs(min_words: int):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list[int], ...] = ([], [], [], [], [])
            for doc, hashes, words in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                prefix, power, repeats = [0], [1], [0]
                times = Counter(hashes)
                for h, w in zip(hashes, words, strict=True):
                    prefix.append((prefix[-1] * _BASE + h) % _PRIME)
                    power.append(power[-1] * _BASE % _PRIME)
                    repeats.append(repeats[-1] + (w > 0 and times[h] > 1))
                for start, stop in _spans(words, min_words):
                    key = (prefix[stop] - prefix[start] * power[stop - start]) % _PRIME
                    for column, value in zip(out, (doc, key, start, stop, repeats[start] < repeats[stop]), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                                             names=["id", "run", "start", "stop", "repeats"])
    return runs


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where an alignment of whole documents can start: lines that stand once, the first, the last."""
    for batch in batches:
        ids, starts = [], []
        for doc, hashes in zip(*(batch.column(c).to_pylist() for c in range(2)), strict=True):
            found = {h for h, times in Counter(hashes).items() if times == 1}
            found |= {hashes[0] * _BASE % _PRIME, (hashes[-1] * _BASE + 1) % _PRIME}
            ids += [doc] * len(found)
            starts += found
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64())], names=["id", "start_line"])


def _meeting_keys(runs: DataFrame, hashed: DataFrame) -> DataFrame:
    """``id, run, start, stop`` by keys that holders of a run meet by: the run, for documents in
    which none of its lines repeats; the run with each start that another document has too, for all
    holders of a run that repeats lines in one of them."""
    several = runs.groupBy("run").agg(F.max("repeats").alias("any"), (F.min("id") < F.max("id")).alias("many"))
    mixed = staged(runs.join(several.where("any AND many"), "run").select("id", "run", "start", "stop"), "line-mixed")
    starts = staged(hashed.join(mixed.select("id").distinct(), "id", "left_semi").select("id", "h").mapInArrow(
        _starts, "id bigint, start_line bigint"), "line-starts")
    known = starts.groupBy("start_line").agg((F.min("id") < F.max("id")).alias("many")).where("many")
    tied = mixed.join(starts.join(known, "start_line", "left_semi"), "id")
    return runs.where("NOT repeats").select("id", "run", "start", "stop").union(
        staged(tied.select("id", F.xxhash64("run", "start_line").alias("run"), "start", "stop"), "line-tied"))


def _unsettled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document's runs those with a line that is not gone."""
    for batch in batches:
        ids, left = [], []
        for doc, runs, gone in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            gone = set(gone or ())
            sums = [0]
            for k in range(max(r["stop"] for r in runs)):
                sums.append(sums[-1] + (k in gone))
            for r in runs:
                if sums[r["stop"]] - sums[r["start"]] < r["stop"] - r["start"]:
                    ids.append(doc)
                    left.append(r)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(left, batch.column(1).type.value_type)],
                                         names=["id", "r"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_block_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """``doc_id, text, n_lines, n_removed, removed`` per input row: the text without the line
    blocks it shares with an earlier document, and the positions of those lines.

    Lines are parts between ``\\n``; lines without words are never compared or deleted. A
    block is a run of lines aligned one after the other in both documents; a line goes if the
    alignment with any earlier document has it in a block. Earlier is the smaller id. Null texts
    count as empty (one empty line); rows without an id and rows that repeat an id keep their text:
    such ids are not compared. An empty table gives no rows.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(
        F.xxhash64(x).alias("h"), word_count(x).cast("int").alias("w")))
    hashed = base.where("doc_id IS NOT NULL").select("doc_id", lines.alias("lines"))
    once = hashed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"), F.first("lines").alias("lines"))
    hashed = staged(once.where("c = 1").select(
        F.col("doc_id").alias("id"), F.expr("transform(lines, x -> x.h)").alias("h"),
        F.expr("transform(lines, x -> x.w)").alias("w")), "line-hashes")
    found = staged(hashed.select("id", "h", "w").mapInArrow(
        _runs(min_block_words), "id bigint, run bigint, start int, stop int, repeats boolean"), "line-runs")
    runs = _meeting_keys(found, hashed)
    held = runs.groupBy("run").agg(F.min("id").alias("first"), F.max("id").alias("last"),
                                   F.count(F.lit(1)).alias("n")).where("first <> last").drop("last")
    shared = staged(runs.join(held, "run"), "line-shared")
    old = hashed.select(F.col("id").alias("first"), F.col("h").alias("old"))

    def aligned(pairs: DataFrame) -> DataFrame:
        met = staged(pairs.select("first", "id").distinct(), "line-pairs")
        return staged(met.join(hashed, "id").join(old, "first").select("id", "old", "h", "w").mapInArrow(
            _deleted_lines(min_block_words), "id bigint, gone array<int>"), "line-blocks")

    # a document meets holders by a hash of their id: in each round about so many of a run
    draw = F.pmod(F.xxhash64(F.lit("holder"), "id"), F.lit(1 << 30)) / float(1 << 30)
    holders = shared.select("run", F.col("id").alias("first"), (draw * F.col("n")).alias("draw")).distinct()
    later = shared.where("id <> first")
    blocks = aligned(later)
    met, most = 0, ROUND_GROWTH
    while True:
        gone = blocks.groupBy("id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("gone")))).alias("removed"))
        listed = later.where(F.col("n") > met).groupBy("id").agg(F.collect_list(F.struct("run", "start", "stop", "first", "n")).alias("runs"))
        later = staged(listed.join(gone, "id", "left").select("id", "runs", "removed").mapInArrow(
            _unsettled, "id bigint, r struct<run bigint, start int, stop int, first bigint, n bigint>").select("id", "r.*"), "line-left")
        if later.isEmpty():
            break
        more = holders.where((F.col("draw") >= met) & (F.col("draw") < most))
        blocks = blocks.union(aligned(later.select("run", "id").distinct().join(more, "run").where("first < id")))
        met, most = most, most * ROUND_GROWTH
    # merged at every size, so that small runs show what large ones shuffle
    joined = base.join(gone.hint("merge"), F.col("doc_id") == F.col("id"), "left")
    removed = F.coalesce("removed", F.expr("cast(array() AS array<int>)"))
    # the parts between deleted lines, in time linear in the lines
    kept = F.expr("""CASE WHEN removed IS NULL THEN text ELSE transform(
        array(struct(split(text, '\\n') AS l, concat(array(-1), removed, array(size(split(text, '\\n')))) AS b)),
        t -> array_join(flatten(transform(sequence(1, size(t.b) - 1),
            k -> slice(t.l, t.b[k - 1] + 2, t.b[k] - t.b[k - 1] - 1))), '\\n'))[0] END""")
    return joined.select("doc_id", kept.alias("text"), F.size(F.split("text", "\n")).alias("n_lines"),
                         F.size(removed).alias("n_removed"), removed.alias("removed"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


ship_by_value(__name__)
