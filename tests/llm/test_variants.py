import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hirelake.llm import variants as v


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def by_hand(rows, min_letters=5, min_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 97 == 0:
                at = h % len(low)
                low = low[:at] + low[at + 1:]
            if len(low) >= min_letters:
                counts[low] += 1
    words = {w: n for w, n in counts.items() if n >= min_count}
    form, out = {}, []
    near = {w: [x for x in words if one_apart(w, x)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abÿ", min_size=2, max_size=7), min_size=1, max_size=12, unique=True), st.integers(1, 7))
def test_index_finds_words_one_apart(words, end):
    index = v.SliceIndex(words)
    for word in words:
        near, agreed = index.near(word, end)
        assert {words[i] for i in v._bits(near)} == {x for x in words if one_apart(word, x)}
        if end <= len(word):
            assert {words[i] for i in v._bits(agreed)} == {x for x in words if x[:end] == word[:end]}


@pytest.mark.parametrize("set_words", [2, 8, 4096])
def test_equals_plain_search(documents, set_words):
    """Few letters, so that sets are large and pairs have several explanations."""
    draw = random.Random(set_words)
    pool = ["".join(draw.choice("abÉé") for _ in range(draw.randint(4, 9))) for _ in range(150)]
    pool += ["aaaaa", "aaaaaa", "aaaaaaa", "baaaaa", "aaaaab"]
    often = [draw.choice([1, 3, 9, 27]) for _ in pool]
    rows = [(k, " ".join(w.upper() if draw.random() < 0.1 else w for w in draw.choices(pool, often, k=60))) for k in range(150)]
    got = v.spelling_variants(documents([(i, t, "en", "a") for i, t in rows]), set_words=set_words).collect()
    assert sorted(map(tuple, got)) == by_hand(rows)
    assert any(r.form and r.root != r.form for r in got)


def test_chain_of_forms(documents):
    text = " ".join(["colour"] * 40 + ["color"] * 18 + ["colr"] * 50 + ["colers"] * 4 + ["colors"] * 9)
    # an id with which no run loses a letter
    doc = next(i for i in range(999) if all(zlib.crc32(f"{i}:{w}".encode()) % 97 for w in set(text.split())))
    got = {r.word: (r.form, r.root, r.n_near) for r in v.spelling_variants(documents([(doc, text, "en", "a")])).collect()}
    assert got == {"colour": (None, "colour", 1), "color": ("colour", "colour", 2), "colors": ("color", "colour", 2),
                   "colers": ("colors", "colour", 1)}


def test_awkward_rows(awkward, clashing, documents):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    want = by_hand(rows, min_letters=4)
    assert want
    for frame in (awkward, clashing):
        assert sorted(map(tuple, v.spelling_variants(frame, min_letters=4).collect())) == want
    assert v.spelling_variants(documents([])).collect() == []


def test_very_long_run(documents):
    long = "ab" * 20_000
    rows = [(k, f"{long} {long}x {long[:-1]}") for k in range(4)]
    got = v.spelling_variants(documents([(i, t, "en", "a") for i, t in rows])).collect()
    assert {len(r.word): r.n_near for r in got} == {39_999: 1, 40_000: 2, 40_001: 1}
