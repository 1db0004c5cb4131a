import random
import zlib

import numpy as np

from hirelake.llm import quality

LABELS = "doc_id bigint, quality int, toxic int"


def text(draw, good):
    words = ["".join(draw.choices("abcdefghijklmno", k=draw.randint(2, 9))) for _ in range(draw.randint(30, 120))]
    if not good:
        kind = draw.randrange(3)
        words = [w.upper() + "!!" for w in words] if kind == 0 else [words[0]] * 60 if kind == 1 else [
            w + draw.choice(["$$$", "***"]) for w in words]
    return " ".join(words)


def test_held_out_accuracy(spark, documents):
    draw = random.Random(3)
    good = [draw.random() < 0.8 for _ in range(500)]
    docs = documents([(k, text(draw, g), "en", "a") for k, g in enumerate(good)])
    # labels of held-out rows are turned round: they must not be learned
    held = [zlib.crc32(str(k).encode()) % 5 == 0 for k in range(500)]
    labels = spark.createDataFrame([(k, int(g != h), 0) for k, (g, h) in enumerate(zip(good, held, strict=True))], LABELS)
    ranker = quality.train(docs, labels)
    got = {r.doc_id: r.s for r in docs.select("doc_id", quality.quality_score(docs, ranker).alias("s")).collect()}
    assert np.mean([(got[k] >= quality.CUT_SCORE) == g for k, g in enumerate(good)]) > 0.97
    assert all(0 <= s <= 1 for s in got.values())


def test_order_follows_preferences():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    label = (x @ np.array([2.0, -1.0, 0.0, 0.0, 1.0]) + rng.logistic(size=600) > 0).astype(int)
    ranker = quality.Ranker(x, label)
    w = ranker.weights
    assert w[0] > w[4] > abs(w[2]) and w[1] < 0
    scores = ranker.scores(x)
    assert ((scores >= quality.CUT_SCORE) == (ranker._standard(x) @ w >= ranker.cut - 1e-9)).all()


def test_awkward_rows(spark, awkward, clashing, documents):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (6, 0, 0), (None, 1, 0), (7, None, 0), (99, 0, 1)], LABELS)
    ranker = quality.train(awkward, labels)
    got = [r.s for r in clashing.select(quality.quality_score(clashing, ranker).alias("s")).collect()]
    assert len(got) == awkward.count() and all(s is not None and 0 <= s <= 1 for s in got)
    none = quality.train(documents([]), labels.limit(0))
    assert none.scores(np.stack([quality.text_features("x")])).shape == (1,)
    empty = documents([])
    assert empty.select(quality.quality_score(empty, none)).count() == 0


def test_every_labelled_row_trains(spark, documents, monkeypatch):
    """More rows than a sample would hold; the sums over tables equal those over arrays."""
    draw = random.Random(5)
    good = [draw.random() < 0.9 for _ in range(5000)]
    docs = documents([(k, text(draw, g) if k % 9 else None, "en", "a") for k, g in enumerate(good)])
    labels = spark.createDataFrame([(k, int(g), 0) for k, g in enumerate(good)], LABELS)
    rows = quality.training_rows(docs, labels, "doc_id", "text", "quality").orderBy("draw", "features").toPandas()
    assert len(rows) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(5000))
    monkeypatch.setattr(quality, "RANK_ROWS", 700)
    ranker = quality.train(docs, labels)
    x = np.stack([np.frombuffer(f) for f in rows["features"]])
    plain = quality.Ranker(x, rows["label"].to_numpy())
    assert np.allclose(ranker.weights, plain.weights, atol=1e-6) and np.isclose(ranker.cut, plain.cut, atol=1e-6)
    assert np.allclose(ranker.scores(x), plain.scores(x), atol=1e-6)
