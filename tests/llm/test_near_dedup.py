import random

from near_by_hand import components_by_hand

from hirelake.llm import near_dedup

def near_copies(draw, base, n, edits):
    for _ in range(n):
        words = base.split()
        for _ in range(draw.randint(0, edits)):
            words[draw.randrange(len(words))] = draw.choice("abcdefgh") * 3
        yield " ".join(words)


def test_components_equal_all_pairs(documents):
    draw = random.Random(4)
    texts = []
    for n, length in ((60, 90), (25, 40), (8, 300), (3, 12), (2, 5)):  # one group longer than a short bucket
        base = " ".join(draw.choice(["Alpha", "beta", "GAMMA", "delta", "x1", "y2", "z3"]) + str(draw.randrange(90))
                        for _ in range(length))
        texts += list(near_copies(draw, base, n, max(1, length // 18)))
    texts += ["one", "ONE", "two words", "", None, "  "]
    draw.shuffle(texts)
    docs = documents([(k, t, "en", "a") for k, t in enumerate(texts)])
    for k, similarity, rows in ((3, 0.85, 5), (5, 0.8, 4)):
        want = components_by_hand(dict(enumerate(texts)), k, round(similarity * 100))
        got = {r.doc_id: (r.n_shingles, r.component_id)
               for r in near_dedup.near_groups(docs, words=k, similarity=similarity, band_rows=rows).collect()}
        assert got == want


def test_estimates_are_unbiased():
    import numpy as np
    with np.errstate(over="ignore"):
        signer = near_dedup.Signer(512, 1)  # one value per band: a band agrees with the similarity's probability
        base = near_dedup._mix64(np.arange(1, 1001, dtype=np.uint64))
        agree = (signer.keys(np.sort(base[:900])) == signer.keys(np.sort(base[100:]))).mean()
    assert abs(agree - 0.8) < 0.05


def test_rows_that_repeat_an_id(documents):
    """Every text of an id is compared, whichever row comes first, and the id's rows are one group."""
    draw = random.Random(8)
    a, b, c = (" ".join(f"{draw.random()}" for _ in range(60)) for _ in range(3))
    near_b = b + " more"
    d, e, f = (" ".join(f"{draw.random()}" for _ in range(60)) for _ in range(3))
    rows = [(3, a), (5, a), (5, b), (9, near_b), (11, c), (11, ""), (12, c), (13, "alone"), (13, None), (14, b.upper()),
            (27, d), (27, e), (27, f), (28, e + " end"), (22, f + " end")]  # classes that share their least id
    got = near_dedup.near_groups(documents([(i, t, "en", "a") for i, t in rows])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {
        (3, 3), (5, 3), (9, 3), (14, 3), (11, 11), (12, 11), (13, 13), (27, 22), (28, 22), (22, 22)}
    assert len(got) == len(rows)
    kept = near_dedup.drop_near_copies(documents([(i, t, "en", "a") for i, t in rows[::-1]])).collect()
    assert sorted(r.doc_id for r in kept) == [3, 11, 11, 13, 13, 22]


def test_awkward_rows(awkward, clashing, documents):
    got = near_dedup.near_groups(awkward).collect()
    assert len(got) == awkward.count()
    kept = {r.doc_id for r in got if r.kept}
    assert kept == {1, 3, 4, 5, 6, 7, 8, None}
    rows = near_dedup.drop_near_copies(clashing)
    assert rows.columns == clashing.columns and rows.count() == 9
    assert near_dedup.near_groups(documents([])).count() == 0
