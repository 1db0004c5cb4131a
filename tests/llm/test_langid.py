import itertools
import math
import random
import zlib

import numpy as np

from hirelake.llm import langid

WORDS = {"en": "the and of with that this from have which there their would".split(),
         "de": "und der die nicht mit eine auch werden haben über schon".split(),
         "fr": "les des une dans pour avec être plus cette sont leur".split()}


def sample(draw, lang, n):
    return " ".join(draw.choice(WORDS[lang]) for _ in range(n))


def test_forward_sums_all_segmentations():
    pieces = sorted(["▁", "▁a", "a", "ab", "b", "▁ab", "bc", "c"])
    p = np.random.default_rng(1).random((len(pieces), 2))
    p /= p.sum(axis=0)
    scorer = langid.Scorer(pieces, p)
    for word in ("abc", "a", "cab", "abcabcab", "axb"):
        marked = "▁" + word
        total = np.zeros(2)
        for cuts in itertools.product([0, 1], repeat=len(marked) - 1):
            parts, last = [], 0
            for k, c in enumerate((*cuts, 1), start=1):
                if c:
                    parts.append(marked[last:k])
                    last = k
            prob = np.ones(2)
            for part in parts:
                if part in pieces:
                    prob *= p[pieces.index(part)]
                elif len(part) == 1:
                    prob *= 1e-7
                else:
                    prob *= 0
            total += prob
        assert np.allclose(scorer.texts([word])[0], np.log(total))


def test_long_runs_are_scored_whole():
    pieces = ["a", "▁"]
    scorer = langid.Scorer(sorted(pieces), np.array([[0.5], [0.5]]))
    got = scorer.texts(["a" * 5000])[0][0]
    assert math.isclose(got, 5001 * math.log(0.5), rel_tol=1e-9)
    # a piece across any place of a long run counts: f(n) = f(n - 1) / 4 + f(n - 2) / 2
    both = langid.Scorer(["a", "aa", "▁"], np.array([[0.25], [0.5], [1.0]])).texts(["a" * 100])[0][0]
    f = [1.0, 0.25]
    for _ in range(99):
        f.append(f[-1] / 4 + f[-2] / 2)
    assert math.isclose(both, math.log(f[100]), rel_tol=1e-9)


def test_no_run_underflows_and_numerals_are_no_letters():
    """Letters that every language gives next to nothing, in runs of any length."""
    pieces = sorted(["a", "b", "ab", "▁"])
    p = np.array([[1e-12, 1e-15]] * 4)
    scorer = langid.Scorer(pieces, p)
    for run in ("b" * 47, "b" * 48, "世" * 300, "b" * 3000):
        got = scorer.texts([run])[0]
        assert np.isfinite(got).all() and got[0] > got[1]
    assert langid.letter_runs("aé½b ²c_d3e ١f") == ["aé", "b", "c", "d", "e", "f"]
    assert np.isnan(scorer.texts(["½ ² ٣ 4_ ", "", "a"])[:, 0]).tolist() == [True, True, False]


def test_held_out_accuracy_and_labels_not_leaked(documents):
    draw = random.Random(2)
    langs = [draw.choice(list(WORDS)) for _ in range(240)]
    rows = []
    for k, lang in enumerate(langs):
        held_out = zlib.crc32(str(k).encode()) % 4 == 2
        # labels of held-out rows are wrong on purpose: they must not be learned
        rows.append((k, sample(draw, lang, 12), "wrong" if held_out else lang, "a"))
    docs = documents(rows)
    model = langid.train(docs, rows_per_language=100, iterations=2)
    assert model[0] == ["de", "en", "fr"]
    got = docs.select("doc_id", langid.identify(docs, model).alias("f")).collect()
    right = [r.f.lang == langs[r.doc_id] for r in got]
    assert sum(right) / len(right) > 0.98
    assert all(0 <= r.f.score <= 1 for r in got)


def test_awkward_rows(awkward, clashing, documents):
    model = langid.train(awkward, iterations=1)
    got = {r.doc_id: r.f for r in awkward.where("doc_id IS NOT NULL").select(
        "doc_id", langid.identify(awkward, model).alias("f")).collect()}
    assert all(got[k].lang == "und" and got[k].score == 0 for k in (3, 4, 5))
    assert got[6].lang in model[0]
    kept = langid.known_language(clashing)
    assert kept.columns == clashing.columns and {r.doc_id for r in kept.collect()}.isdisjoint({3, 4, 5})
    empty = documents([])
    assert langid.train(empty)[0] == [] and langid.known_language(empty).count() == 0


def test_forgetting_keeps_results(monkeypatch):
    pieces = sorted(["▁", *"abcdefgh"])
    p = np.random.default_rng(1).random((len(pieces), 2))
    words = ["".join(random.Random(k).choices("abcdefgh", k=5)) for k in range(300)]
    want = langid.Scorer(pieces, p).texts([" ".join(words)])
    monkeypatch.setattr(langid, "REMEMBERED_WORDS", 40)
    small = langid.Scorer(pieces, p)
    parts = [small.texts([" ".join(words[k:k + 30])]) for k in range(0, 300, 30)]
    assert np.allclose(sum(parts), want)
