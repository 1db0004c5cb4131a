import random
import re

from hirelake.llm import packing


def check(rows, got, capacity):
    size = {}
    for i, t, _, _ in rows:
        size.setdefault(i, []).append(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    pieces, bins = {}, {}
    for r in got:
        pieces[r.doc_id] = pieces.get(r.doc_id, 0) + r.n_words
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    assert pieces == {i: sum(s) for i, s in size.items()}
    text = {i: t for i, t, _, _ in rows}
    for held in bins.values():
        assert sum(r.n_words for r in held) == held[0].bin_words <= capacity
        assert sorted(r.position for r in held) == list(range(len(held)))
        assert len({r.source for r in held}) == len(held)
        assert len({text[r.doc_id] for r in held}) == len(held)
    return bins


def best_fit_by_hand(items, capacity):
    """Plain best fit over (size, source, cluster); of equally tight bins the last changed."""
    bins = []  # [room, time of last change, sources, clusters]
    for time, (size, source, cluster) in enumerate(items):
        fits = [b for b in bins if b[0] >= size and source not in b[2] and (cluster < 0 or cluster not in b[3])]
        best = min(fits, key=lambda b: (b[0], -b[1]), default=None)
        if best is None:
            best = [capacity, 0, set(), set()]
            bins.append(best)
        best[0] -= size
        best[1] = time
        best[2].add(source)
        best[3].add(cluster)
    return [b[0] for b in bins]


def test_bins_equal_plain_best_fit():
    draw = random.Random(3)
    items = sorted(((draw.randint(1, 60), draw.randrange(70), draw.choice([-1, -1, 0, 1, 2])) for _ in range(1500)),
                   reverse=True)
    bins = packing.Bins(100, 70)
    for size, source, cluster in items:
        bins.place(size, source, cluster)
    assert list(bins.room[:bins.count]) == sorted(best_fit_by_hand(items, 100))


def test_pieces_and_conflicts(documents):
    draw = random.Random(8)
    rows = [(k, " ".join([f"d{draw.choice([k, k, 1])}"] + ["w"] * draw.choice([0, 3, 40, 130, 333])), "en",
             draw.choice(["hot"] * 5 + list("abcdefgh") + [None])) for k in range(700)]
    got = packing.pack(documents(rows), capacity=100, rows_per_shard=200).collect()
    bins = check(rows, got, 100)
    hot = sum(r.source == "hot" for r in got)
    assert len(bins) <= 1.4 * max(hot, sum(r.n_words for r in got) / 100)


def test_awkward_rows(awkward, clashing, documents):
    got = packing.pack(awkward, capacity=1000).collect()
    assert {r.doc_id for r in got} == {1, 2, 3, 4, 5, 6, 7, 8, None}
    assert sum(r.n_words for r in got) == 15 + 30_000 + 4 + 2 + 4
    assert all(r.bin_id is None for r in got if r.n_words == 0)
    assert sorted(map(str, got)) == sorted(map(str, packing.pack(clashing, capacity=1000).collect()))
    assert packing.pack(documents([])).count() == 0
