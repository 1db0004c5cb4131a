"""Quality scores learned from preference pairs (Bradley-Terry).

A document has a strength linear in features of its whole text; that one document is
preferred to another has the logistic of the difference of their strengths as probability.
Weights come from pairs of a document labelled good and one labelled bad, by Newton steps on
the logistic loss of feature differences. Every labelled document that is not held out is in a
pair; features, pairs and sums over them are Spark jobs, and the driver sees sums only. The cut
is a quantile of the strengths of all these documents, and scores are the logistic of the
distance to it, moved so that the cut lies at ``CUT_SCORE``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from hirelake.llm.common import crc32_remainder, ship_by_value, staged, table

# Each bad row meets this many good ones, or as many as it takes that every good one is met.
PAIRS_PER_ROW = 8
HELD_OUT = (5, 0)
CUT_SCORE = 0.3
RIDGE = 1.0
NEWTON_STEPS = 12
# Steps end early once no weight moves by more.
SETTLED = 1e-9
# Rows numbered by one task.
RANK_ROWS = 50_000
# Quantiles of the strengths that are tried as the cut.
QUANTILES = np.arange(0.005, 0.6, 0.005)

# Byte classes: lower, upper, digit, blank, line end, sentence mark, other mark, non-ASCII.
_CLASSES = np.full(256, 6, dtype=np.int64)
_CLASSES[ord("a"):ord("z") + 1] = 0
_CLASSES[ord("A"):ord("Z") + 1] = 1
_CLASSES[ord("0"):ord("9") + 1] = 2
_CLASSES[[32, 9]] = 3
_CLASSES[[10, 11, 12, 13]] = 4
_CLASSES[[ord(c) for c in ".,;:?!'\"-()"]] = 5
_CLASSES[128:] = 7


def text_features(text: str) -> np.ndarray:
    """Shares of neighbouring byte-class pairs, and counts of words, repeats and lines."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    kind = _CLASSES[raw]
    pairs = np.bincount(kind[:-1] * 8 + kind[1:], minlength=64) if len(kind) > 1 else np.zeros(64)
    marks = np.array([text.count(c) for c in "!|#*$%&@<>{}=_/\\"], dtype=float)
    words = text.split()
    lines = text.split("\n")
    n = max(1, len(words))
    different = len(set(words))
    repeats = sum(map(str.__eq__, words, words[1:]))
    sizes = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    counts = np.array([
        np.log1p(len(words)), np.log1p(len(lines)), len(words) / max(1, len(lines)) / 100.0,
        different / n, different / n ** 0.8, np.sqrt(repeats / n), repeats / n,
        sizes.mean() / 10.0, sizes.std() / 10.0, min(5.0, sizes.max() / 20.0),
        1.0 - len(set(lines)) / len(lines), float(not words)])
    size = max(1, len(raw))
    return np.concatenate((counts, np.sqrt(pairs / size), np.sqrt(marks / n)))


def packed_features(text: Column) -> Column:
    """:func:`text_features` as the bytes of its values."""
    @pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: text_features(t or "").tobytes())
    return packed(text)


def _unpacked(packed: pa.Array) -> np.ndarray:
    """A row of features per value."""
    return np.frombuffer(b"".join(packed.to_pylist())).reshape(len(packed), -1)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(draw, label, features) of all labelled rows but the held out ones. Null labels and ids are
    left out. Only features meet the labels: texts stay in the task that reads them."""
    modulus, remainder = HELD_OUT
    key = F.col(id_col).cast("string")
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()
                          & (crc32_remainder(key, modulus) != remainder))
    usable = usable.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
    found = docs.where(F.col(id_col).isNotNull() & (crc32_remainder(key, modulus) != remainder)).select(
        F.col(id_col).alias("_id"), packed_features(F.col(text_col)).alias("features"))
    draw = F.pmod(F.xxhash64(F.lit("quality"), F.col("_id")), F.lit(1 << 30)) / float(1 << 30)
    return found.join(usable, "_id").select(draw.alias("draw"), "label", "features")


def _ranked(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The ``n`` rows with their number ``_rank`` from 0 in ascending ``order``: ranges are sorted on
    their own, and the sizes of the ranges before one are added."""
    rows = rows.repartitionByRange(max(1, -(-n // RANK_ROWS)), *order).sortWithinPartitions(*order)
    rows = staged(rows.withColumn("_at", F.monotonically_increasing_id()), "quality-ranks")
    part = F.shiftright("_at", 33)
    sizes = dict(rows.groupBy(part.alias("p")).count().collect())
    before, starts = 0, []
    for p in sorted(sizes):
        starts.append((p, before))
        before += sizes[p]
    starts = rows.sparkSession.createDataFrame(starts, "_part bigint, _before bigint")
    return rows.withColumn("_part", part).join(F.broadcast(starts), "_part").select(
        *[c for c in rows.columns if c != "_at"],
        (F.col("_before") + F.col("_at") - F.shiftleft("_part", 33)).alias("_rank"))


def _summed(rows: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray], width: int) -> np.ndarray:
    """Sum of ``of_batch`` over all rows: one row of sums a task, added up in the order of tasks."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += of_batch(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return sum((np.frombuffer(r.sums) for r in rows.mapInArrow(task, "sums binary").collect()), np.zeros(width))


def _newton_sums(delta: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the pairs' logistic loss."""
    p = 1.0 / (1.0 + np.exp(-np.clip(delta @ weights, -30, 30)))
    return delta.T @ (1.0 - p), (delta * (p * (1.0 - p))[:, None]).T @ delta


def _newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    weights = np.zeros(width)
    for _ in range(NEWTON_STEPS):
        gradient, hessian = sums(weights)
        step = np.linalg.solve(hessian + RIDGE * np.eye(width), gradient - RIDGE * weights)
        weights = weights + step
        if np.abs(step).max() < SETTLED:
            break
    return weights


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -6, 6)


def _pair_count(good: int, bad: int) -> int:
    """Good rows that each bad one meets."""
    return max(PAIRS_PER_ROW, -(-good // bad))


class Ranker:
    """Strength weights over standardised features, and the cut."""

    def __init__(self, x: np.ndarray, label: np.ndarray) -> None:
        """From rows in memory; :func:`train` does the same over tables."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        self.weights, self.cut = np.zeros(x.shape[1]), -np.inf
        z = self._standard(x)
        good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
        if not len(good) or not len(bad):
            return
        n = _pair_count(len(good), len(bad))
        partner = good[(np.arange(len(bad))[:, None] * n + np.arange(n)) % len(good)]
        delta = (z[partner] - z[bad][:, None]).reshape(-1, z.shape[1])
        self.weights = _newton(lambda w: _newton_sums(delta, w), z.shape[1])
        strength = z @ self.weights
        cuts = np.quantile(strength, QUANTILES)
        right = [(strength[good] >= c).mean() + (strength[bad] < c).mean() for c in cuts]
        self.cut = float(cuts[int(np.argmax(right))])

    @classmethod
    def of(cls, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float) -> Ranker:
        ranker = cls.__new__(cls)
        ranker.mean, ranker.scale, ranker.weights, ranker.cut = mean, scale, weights, cut
        return ranker

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return _standard(x, self.mean, self.scale)

    def scores(self, x: np.ndarray) -> np.ndarray:
        above = np.clip(self._standard(x) @ self.weights - self.cut, -30, 30)
        return 1.0 / (1.0 + np.exp(-(above + np.log(CUT_SCORE / (1.0 - CUT_SCORE)))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Ranker:
    """Ranker from all labelled rows but the held out ones; without both labels all score alike."""
    rows = staged(training_rows(docs, labels, id_col, text_col, label_col), "quality-rows")
    counts = dict(rows.groupBy("label").count().collect())
    good, bad = counts.get(1, 0), counts.get(0, 0)
    width, n = len(text_features("")), good + bad
    if not good or not bad:
        return Ranker.of(np.zeros(width), np.ones(width), np.zeros(width), -np.inf)

    mean = _summed(rows, lambda b: _unpacked(b["features"]).sum(axis=0), width) / n
    scale = np.sqrt(_summed(rows, lambda b: ((_unpacked(b["features"]) - mean) ** 2).sum(axis=0), width) / n) + 1e-3

    each = _pair_count(good, bad)
    order = ["draw", "features"]
    firsts = _ranked(rows.where("label = 1").select(*order), order, good).select(
        F.col("features").alias("good"), F.col("_rank").alias("_of"))
    seconds = _ranked(rows.where("label = 0").select(*order), order, bad).select(
        F.col("features").alias("bad"), F.explode(F.expr(f"sequence(_rank * {each}, _rank * {each} + {each - 1})")).alias("_pair"))
    seconds = seconds.select("bad", (F.col("_pair") % good).alias("_of"))

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                delta = _standard(_unpacked(batch["good"]), mean, scale) - _standard(_unpacked(batch["bad"]), mean, scale)
                packed = [row.tobytes() for row in delta]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["delta"])

    pairs = staged(seconds.join(firsts, "_of").select("good", "bad").mapInArrow(differences, "delta binary"), "quality-pairs")

    def sums(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = _summed(pairs, lambda b: np.concatenate([s.ravel() for s in _newton_sums(_unpacked(b["delta"]), weights)]),
                        width + width * width)
        return total[:width], total[width:].reshape(width, width)

    weights = _newton(sums, width)

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = _standard(_unpacked(batch["features"]), mean, scale) @ weights
                yield pa.RecordBatch.from_arrays([pa.array(found), batch["label"]], names=["strength", "label"])

    ranked = _ranked(rows.mapInArrow(strengths, "strength double, label int"), ["strength"], n)
    at = QUANTILES * (n - 1)
    low = np.floor(at).astype(int)
    needed = sorted({int(k) for k in low} | {min(n - 1, int(k) + 1) for k in low})
    values = {r._rank: r.strength for r in ranked.where(F.col("_rank").isin(needed)).collect()}
    cuts = np.array([values[k] + (values[min(n - 1, k + 1)] - values[k]) * (q - k) for k, q in zip(low.tolist(), at, strict=True)])

    def below(batch: pa.RecordBatch) -> np.ndarray:
        strength, label = np.asarray(batch["strength"]), np.asarray(batch["label"])
        return np.concatenate([(strength[label == k][:, None] < cuts).sum(axis=0) for k in (1, 0)])

    under = _summed(ranked.select("strength", "label"), below, 2 * len(cuts)).reshape(2, -1)
    right = (good - under[0]) / good + under[1] / bad
    return Ranker.of(mean, scale, weights, float(cuts[int(np.argmax(right))]))


def quality_score(docs: DataFrame, ranker: Ranker, text_col: str = "text") -> Column:
    """Score column for ``docs``, 0 to 1; null texts score as empty ones."""
    shared = docs.sparkSession.sparkContext.broadcast(ranker)

    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            x = np.stack([text_features(t or "") for t in batch]) if len(batch) else None
            yield pd.Series(shared.value.scores(x) if x is not None else [], dtype=float)
    return score(F.col(text_col))


def op9_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ranker = train(docs, table(spark, sf_dir, "labels"))
    modulus, remainder = HELD_OUT
    held_out = crc32_remainder(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), modulus) == remainder
    scored = docs.select("doc_id", held_out.alias("held_out"), quality_score(docs, ranker).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= CUT_SCORE, 1).otherwise(0))


ship_by_value(__name__)
