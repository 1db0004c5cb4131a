import difflib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from hirelake.llm import line_dedup as ld


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=30), st.lists(st.integers(0, 12), max_size=30))
def test_alignment_is_a_rising_match(old, new):
    found = ld.patience_align(old, new)
    assert all(old[a] == new[b] for a, b in found)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))


def test_alignment_finds_moved_blocks():
    old, new = list(range(40)), [*range(100, 110), *range(5, 30), 200, *range(35, 40)]
    found = ld.patience_align(old, new)
    size = sum(m.size for m in difflib.SequenceMatcher(None, old, new, autojunk=False).get_matching_blocks())
    assert len(found) == size == 30


def test_equals_plain_alignment(documents):
    draw = random.Random(9)
    pool = [" ".join(f"w{draw.randrange(300)}" for _ in range(draw.randint(1, 14))) for _ in range(60)]
    texts = {}
    for k in range(150):
        parts = [draw.choice(pool) if draw.random() < 0.3 else f"own {k} {draw.random()}" for _ in range(draw.randint(1, 12))]
        if draw.random() < 0.3:
            at = draw.randrange(50)
            parts += ["", *pool[at:at + 8]]
        texts[k] = "\n".join(parts)
    want = removed_by_all(texts)
    got = ld.dedup_lines(documents([(k, t, "en", "a") for k, t in texts.items()])).collect()
    for r in got:
        assert list(r.removed) == want[r.doc_id]
        lines = texts[r.doc_id].split("\n")
        assert r.text == "\n".join(x for k, x in enumerate(lines) if k not in set(r.removed))
        assert (r.n_lines, r.n_removed) == (len(lines), len(r.removed))
    assert any(r.n_removed for r in got)


def test_passage_goes_from_later_document_only(documents):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(4, f"late start\n{passage}\nlate end", "en", "a"), (2, f"{passage}", "en", "b"), (3, "clean line of words here", "en", "a")]
    got = {r.doc_id: r.text for r in ld.dedup_lines(documents(rows)).collect()}
    assert got == {4: "late start\nlate end", 2: passage, 3: "clean line of words here"}


def test_awkward_rows(awkward, clashing, documents):
    got = ld.dedup_lines(awkward).collect()
    assert len(got) == awkward.count()
    assert all(r.n_removed == 0 for r in got)
    assert sorted(map(str, got)) == sorted(map(str, ld.dedup_lines(clashing).collect()))
    assert ld.dedup_lines(documents([])).count() == 0


def removed_by_all(texts, min_words=10):
    """Alignment with every earlier document."""
    lines = {i: t.split("\n") for i, t in texts.items()}
    out = {}
    for i in sorted(lines):
        gone = set()
        for e in (e for e in lines if e < i and set(lines[e]) & set(lines[i])):
            block, last = [], (-9, -9)
            for a, b in [*ld.patience_align(lines[e], lines[i]), (-5, -5)]:
                if (a, b) != (last[0] + 1, last[1] + 1):
                    if sum(len(lines[i][k].split()) for k in block) >= min_words:
                        gone |= set(block)
                    block = []
                block.append(b)
                last = (a, b)
        # of every earlier document
            out.setdefault(i, set()).update(gone)
        out.setdefault(i, set())
    return {i: sorted(g) for i, g in out.items()}


def test_blocks_shared_with_any_earlier_document(documents):
    x, y, long = "six words stand in line x", "six words stand in line y", " ".join(f"l{k}" for k in range(12))
    p, q, r = (" ".join(f"{c}{k}" for k in range(11)) for c in "pqr")
    texts = {
        # the lines of a block have different first holders
        1: f"a1\n{x}", 2: f"a2\n{y}", 3: f"b\n{x}\n{y}\nb end", 4: f"c\n{x}\n{y}\nc end",
        # the block crosses others in the alignment with its first holder
        11: f"{p}\nd\n{q}\n{r}", 12: f"e\n{p}\ne end", 13: f"f\n{q}\n{r}\nf mid\n{p}\nf end",
        # the first holder repeats the line
        21: f"g\n{long}\ng mid\n{long}\ng end", 22: f"h\n{long}\nh end", 23: f"i\n{long}\ni end",
    }
    want = removed_by_all(texts)
    assert want[4] == [1, 2] and want[13] == [1, 2, 4] and want[23] == [1]
    got = ld.dedup_lines(documents([(k, t, "en", "a") for k, t in texts.items()])).collect()
    assert {r.doc_id: list(r.removed) for r in got} == want


def test_equals_alignment_with_every_earlier_document(documents):
    draw = random.Random(4)
    pool = [" ".join(f"w{draw.randrange(300)}" for _ in range(draw.randint(1, 14))) for _ in range(25)]
    texts = {}
    for k in range(150):
        parts = [draw.choice(pool) if draw.random() < 0.5 else f"own {k} {draw.random()}" for _ in range(draw.randint(1, 12))]
        if draw.random() < 0.4:
            at = draw.randrange(20)
            parts += ["", *pool[at:at + 6], ""]
        texts[k] = "\n".join(parts)
    got = ld.dedup_lines(documents([(k, t, "en", "a") for k, t in texts.items()])).collect()
    assert {r.doc_id: list(r.removed) for r in got} == removed_by_all(texts)


def repeating_texts(n, shared=""):
    line = " ".join(f"r{k}" for k in range(10))
    return {k: f"a {k}\n{line}\nb {k}\n{shared}{line}\nc {k}" for k in range(n)}


def met_pairs(documents, texts, monkeypatch):
    """Pairs of documents that were aligned, and the lines removed."""
    counts, plain = [], ld.staged

    def counted(df, name):
        out = plain(df, name)
        if name == "line-pairs":
            counts.append(out.count())
        return out

    monkeypatch.setattr(ld, "staged", counted)
    got = ld.dedup_lines(documents([(k, t, "en", "a") for k, t in texts.items()])).collect()
    return sum(counts), {r.doc_id: list(r.removed) for r in got}


def test_repeated_lines_without_a_common_start_meet_nobody(documents, monkeypatch):
    texts = repeating_texts(60)
    assert met_pairs(documents, texts, monkeypatch) == (0, removed_by_all(texts))


def test_repeated_lines_meet_by_a_line_that_stands_once(documents, monkeypatch):
    """Each copy stands once in the part before or after the line that stands once in all."""
    texts = repeating_texts(30, shared="once in each\n")
    want = removed_by_all(texts)
    assert want[29] == [1, 3, 4]
    assert met_pairs(documents, texts, monkeypatch)[1] == want


def test_equals_alignment_where_lines_repeat(documents):
    """Few lines, so that most repeat inside a document; equal first and last lines."""
    draw = random.Random(12)
    pool = [" ".join(f"w{k}{j}" for j in range(draw.randint(0, 12))) for k in range(12)]
    texts = {}
    for k in range(120):
        parts = [draw.choice(pool) if draw.random() < 0.7 else f"own {k} {draw.random()}" for _ in range(draw.randint(1, 16))]
        texts[k] = "\n".join([*(["Home"] if draw.random() < 0.2 else []), *parts, *(["End"] if draw.random() < 0.2 else [])])
    got = ld.dedup_lines(documents([(k, t, "en", "a") for k, t in texts.items()])).collect()
    assert {r.doc_id: list(r.removed) for r in got} == removed_by_all(texts)
    for r in got:
        gone = set(r.removed)
        assert r.text == "\n".join(x for k, x in enumerate(texts[r.doc_id].split("\n")) if k not in gone)
