"""Language identification with segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. A word's
probability is the sum over all its segmentations into pieces (forward algorithm), a text's
log-probability is the sum over its words, and the languages' posterior under equal priors
gives prediction and score. Probabilities are trained by expectation maximisation: Spark
counts the words of a bounded sample per language, every iteration sums expected piece
counts over the word table (forward-backward), and only the piece table, whose size is that
of the vocabulary times the languages, reaches the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from hirelake.llm.common import crc32_remainder, ship_by_value, staged, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNDETERMINED = "und"
# Training rows taken per language (by a hash of the id, so the sample is the same each run).
TRAIN_ROWS = 1500
ITERATIONS = 4
SMOOTHING = 0.05
HELD_OUT = (4, 2)
# Training cuts longer runs of letters into stretches of this many; scoring does not.
TRAINED_RUN = 48
# Words whose scores a task remembers before it starts anew.
REMEMBERED_WORDS = 400_000
# Documents below this posterior, or without letters, are rejected by the filter.
MIN_SCORE = 0.5
START = "▁"
LETTERS = regex.compile(r"\p{L}+")
# The same but for numerals that are no digits, and faster.
WORDS = re.compile(r"[^\W\d_]+")
_SCALE = 16.0
# Prefix sums are scaled back beyond this, or its inverse, so that no product leaves the range of doubles.
_SMALL = 1e-100
# Looked at once in so many letters: no letter costs more than a factor of 1e-20.
_CHECKED = 8


def vocabulary_pieces(path: str = VOCABULARY) -> list[str]:
    """Lower-cased letter pieces of a sentencepiece model, word-start mark kept."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {START}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            piece = model.id_to_piece(i).lower()
            if piece.removeprefix(START).isalpha():
                found.add(piece)
    return sorted(found)


def letter_runs(text: str) -> list[str]:
    """The runs of letters (``\\p{L}``) of a text."""
    found = WORDS.findall(text)
    return found if not found or "".join(found).isalpha() else LETTERS.findall(text)


class Lattice:
    """Piece ids of every span of a list of equally long words: ``spans[(i, j)]`` has one id
    per word, 0 where the span is no piece, 1 for a letter the vocabulary lacks."""

    def __init__(self, pieces: list[str]) -> None:
        self.ids = {p: k + 2 for k, p in enumerate(pieces)}
        self.longest = max(len(p) for p in pieces)

    def spans(self, words: list[str]) -> dict[tuple[int, int], np.ndarray]:
        get, length, out = self.ids.get, len(words[0]), {}
        for i in range(length):
            for j in range(i + 1, min(length, i + self.longest) + 1):
                ids = np.fromiter((get(w[i:j], 0) for w in words), np.int64, len(words))
                if j == i + 1:
                    ids[ids == 0] = 1
                if ids.any():
                    out[i, j] = ids
        return out


    def ending(self, words: list[str], j: int, back: int) -> np.ndarray | None:
        """Ids of the spans of ``back`` letters that end before ``j``; None if none is a piece."""
        get = self.ids.get
        ids = np.fromiter((get(w[j - back:j], 0) for w in words), np.int64, len(words))
        if back == 1:
            ids[ids == 0] = 1
        return ids if ids.any() else None


def _stretches(run: str) -> list[str]:
    marked = START + run
    return [marked[k:k + TRAINED_RUN] for k in range(0, len(marked), TRAINED_RUN)]


def _by_length(words: Iterable[str]) -> Iterator[list[str]]:
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    return iter(groups.values())


def _log_sums(lattice: Lattice, words: list[str], scaled: np.ndarray) -> np.ndarray:
    """Logarithms [word, column] of the probabilities of equally long words, summed over all
    segmentations. Only the prefix sums that a piece can still reach are held, and they are
    scaled together when they get small or large, so words of any length stay in range and
    need not be cut."""
    length, reach = len(words[0]), lattice.longest
    alpha = [np.ones((len(words), scaled.shape[1]))]  # of the last positions
    logs = np.full(alpha[0].shape, -length * np.log(_SCALE))
    for j in range(1, length + 1):
        total = np.zeros_like(alpha[0])
        for back, before in enumerate(reversed(alpha), 1):
            ids = lattice.ending(words, j, back)
            if ids is not None:
                total += before * scaled[ids]
        alpha = [*alpha[-(reach - 1):], total] if reach > 1 else [total]
        if j % _CHECKED:
            continue
        far = (total > 0) & ((total < _SMALL) | (total > 1.0 / _SMALL))
        if far.any():
            factor = 1.0 / np.where(far, total, 1.0)
            logs -= np.log(factor)
            alpha = [a * factor for a in alpha]
    return logs + np.log(alpha[-1])


def _scaled(probability: np.ndarray, pieces: list[str]) -> np.ndarray:
    """Rows 0 (no piece) and 1 (unknown letter) before the pieces; a factor per letter keeps
    products of long words in range."""
    size = np.array([len(p) for p in pieces], dtype=float)
    known = probability * (_SCALE ** size)[:, None]
    edge = np.zeros((2, probability.shape[1]))
    edge[1] = 1e-7 * _SCALE
    return np.vstack((edge, known))


class Scorer:
    """Log-probabilities of words under every language, remembered between calls."""

    def __init__(self, pieces: list[str], probability: np.ndarray) -> None:
        self.lattice, self.scaled = Lattice(pieces), _scaled(probability, pieces)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.logs = np.zeros((1024, self.scaled.shape[1]))

    def _learn(self, words: set[str]) -> None:
        if len(self.place) + len(words) > REMEMBERED_WORDS:
            self.forget()
        at = len(self.place)
        need = at + len(words)
        if need > len(self.logs):
            grown = np.zeros((max(need, 2 * len(self.logs)), self.scaled.shape[1]))
            grown[:at] = self.logs[:at]
            self.logs = grown
        for group in _by_length(words):
            self.logs[at:at + len(group)] = _log_sums(self.lattice, [START + w for w in group], self.scaled)
            self.place.update(zip(group, range(at, at + len(group)), strict=True))
            at += len(group)

    def texts(self, texts: list[str]) -> np.ndarray:
        """(texts, languages) summed word log-probabilities; a row of NaN without letters."""
        words = [letter_runs(t.lower()) for t in texts]
        new = {w for found in words for w in found if w not in self.place}
        if len(self.place) + len(new) > REMEMBERED_WORDS:
            self.forget()
            new = {w for found in words for w in found}
        if new:
            self._learn(new)
        out = np.full((len(texts), self.scaled.shape[1]), np.nan)
        for k, found in enumerate(words):
            if found:
                ids = np.fromiter(map(self.place.__getitem__, found), np.int64, len(found))
                out[k] = self.logs[ids].sum(axis=0)
        return out


def _expected_counts(pieces: list[str], languages: list[str], probability: np.ndarray):
    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, scaled = Lattice(pieces), _scaled(probability, pieces)
        column = {name: k for k, name in enumerate(languages)}
        total = np.zeros((len(pieces) + 2, len(languages)))
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)
            parts = [(part, column[lang], n) for lang, word, n in rows for part in _stretches(word)]
            groups: dict[int, list[tuple[str, int, int]]] = {}
            for part in parts:
                groups.setdefault(len(part[0]), []).append(part)
            for length, group in groups.items():
                own = np.array([g[1] for g in group])
                weight = np.array([g[2] for g in group], dtype=float)
                spans = lattice.spans([g[0] for g in group])
                p = {s: scaled[ids, own] for s, ids in spans.items()}
                alpha, beta = np.zeros((2, length + 1, len(group)))
                alpha[0] = beta[length] = 1.0
                for (i, j) in sorted(p):
                    alpha[j] += alpha[i] * p[i, j]
                for (i, j) in sorted(p, key=lambda s: -s[0]):
                    beta[i] += beta[j] * p[i, j]
                weight /= np.where(alpha[length] > 0, alpha[length], np.inf)
                for (i, j), ids in spans.items():
                    share = alpha[i] * p[i, j] * beta[j] * weight
                    np.add.at(total, (ids, own), share)
        k, lang = np.nonzero(total[2:])
        yield pa.RecordBatch.from_arrays(
            [pa.array(k, pa.int64()), pa.array(lang, pa.int64()), pa.array(total[2:][k, lang], pa.float64())],
            names=["piece", "lang", "expected"])
    return expect


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str,
                  rows_per_language: int = TRAIN_ROWS) -> DataFrame:
    """(lang, text): about ``rows_per_language`` labelled rows of every language, none held out."""
    modulus, remainder = HELD_OUT
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    labelled = docs.where(F.col(lang_col).isNotNull() & (crc32_remainder(key, modulus) != remainder))
    share = labelled.groupBy(F.col(lang_col).alias("_lang")).agg(
        (F.lit(float(rows_per_language)) / F.count(F.lit(1))).alias("_share"))
    draw = F.pmod(F.xxhash64(F.lit("langid"), key), F.lit(1 << 30)) / float(1 << 30)
    taken = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), draw.alias("_draw"))
    return taken.join(F.broadcast(share), F.col("lang") == F.col("_lang")).where("_draw < _share").select("lang", "text")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          vocabulary: str = VOCABULARY, rows_per_language: int = TRAIN_ROWS,
          iterations: int = ITERATIONS) -> tuple[list[str], list[str], np.ndarray]:
    """(languages, pieces, probability[piece, language]) from labelled rows."""
    pieces = vocabulary_pieces(vocabulary)
    words = training_rows(docs, id_col, text_col, lang_col, rows_per_language).select(
        "lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))).alias("word"))
    counted = staged(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "word-counts")
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    if not languages:
        return [], pieces, np.zeros((len(pieces), 0))
    probability = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    for _ in range(iterations):
        table_ = counted.mapInArrow(_expected_counts(pieces, languages, probability),
                                    "piece bigint, lang bigint, expected double")
        sums = table_.groupBy("piece", "lang").agg(F.sum("expected").alias("expected")).toPandas()
        counts = np.full(probability.shape, SMOOTHING)
        counts[sums["piece"].to_numpy(), sums["lang"].to_numpy()] += sums["expected"].to_numpy()
        probability = counts / counts.sum(axis=0)
    return languages, pieces, probability


def predictor(spark: SparkSession, model: tuple[list[str], list[str], np.ndarray]):
    """A column function: text -> struct(lang, score)."""
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("lang string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages, pieces, probability = shared.value
        names = np.array([*languages, UNDETERMINED], dtype=object)
        scorer = Scorer(pieces, probability) if languages else None
        for batch in texts:
            found, score = [], []
            values = batch.tolist()
            at = 0
            while at < len(values):  # a few megabytes of text at once, whatever the batch holds
                stop, size = at, 0
                while stop < len(values) and (stop == at or size < 1 << 21):
                    size += len(values[stop] or "")
                    stop += 1
                logs = (scorer.texts([v or "" for v in values[at:stop]]) if scorer
                        else np.full((stop - at, 1), np.nan))
                empty = np.isnan(logs[:, 0])
                best = np.where(empty, 0, logs.argmax(axis=1))
                top = logs[np.arange(len(logs)), best]
                posterior = 1.0 / np.exp(logs - top[:, None]).sum(axis=1)
                found.append(names[np.where(empty, len(names) - 1, best)])
                score.append(np.where(empty, 0.0, posterior))
                at = stop
            yield pd.DataFrame({"lang": np.concatenate(found) if found else [],
                                "score": np.concatenate(score) if score else []})
    return predict


def identify(docs: DataFrame, model: tuple[list[str], list[str], np.ndarray], text_col: str = "text") -> Column:
    """Prediction column for ``docs``: struct(lang, score). Null, empty and letterless texts
    give (und, 0); ties go to the language first in order; without any labelled row all is
    und. Scores are posteriors of the whole text, between 0 and 1."""
    return predictor(docs.sparkSession, model)(F.col(text_col))


def known_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   min_score: float = MIN_SCORE) -> DataFrame:
    """Rows whose language is determined with ``min_score``; columns unchanged."""
    model = train(docs, id_col, text_col, lang_col)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    judged = docs.select(whole, identify(docs, model, text_col).alias("_found"))
    return judged.where((F.col("_found.lang") != UNDETERMINED) & (F.col("_found.score") >= min_score)).select("_doc.*")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs)
    modulus, remainder = HELD_OUT
    held_out = crc32_remainder(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), modulus) == remainder
    return docs.select("doc_id", held_out.alias("held_out"), identify(docs, model).alias("_found")).select(
        "doc_id", "held_out", F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score"))


ship_by_value(__name__)
