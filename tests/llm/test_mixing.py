import random

import duckdb

from hirelake.llm import mixing


def targets_by_hand(sizes, weights=mixing.WEIGHTS, cap=3):
    """Share by weight, cut at the limit, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s: cap * sizes[s] for s in free if share[s] > cap * sizes[s] + 1e-9}
        if not above:
            return share | fixed
        fixed |= above


def test_targets_and_copies(documents):
    draw = random.Random(1)
    rows = [(k, "w " * draw.choice([0, 1, 5, 30, 200]), "en", draw.choice(["a"] * 9 + ["b", "c", None, ""]))
            for k in range(900)]
    got = mixing.mix(documents(rows), rows_per_run=100).collect()
    sizes = {}
    source = {i: s for i, _, _, s in rows}
    for r in got:
        sizes[source[r.doc_id]] = sizes.get(source[r.doc_id], 0) + r["size"]
    wanted = targets_by_hand(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - wanted[s]) < 1e-6
        assert 0 <= r.copies <= 3 and r.taken == r["size"] * r.copies
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= 0.1 * wanted[s] + 400


def test_same_on_rerun_and_any_partitioning(documents):
    rows = [(k, "w " * (k % 17), "en", "ab"[k % 2]) for k in range(300)]
    one = sorted(mixing.mix(documents(rows)).collect())
    assert one == sorted(mixing.mix(documents(rows[::-1]).repartition(7)).collect())


def test_awkward_rows(awkward, clashing, documents):
    got = mixing.mix(awkward).collect()
    assert len(got) == awkward.count()
    assert all(r["size"] == 0 and r.taken == 0 for r in got if r.doc_id in (3, 4, 5))
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(clashing).collect()))
    assert mixing.mixed_rows(clashing).columns == clashing.columns
    assert mixing.mix(documents([])).count() == 0


def test_rows_are_repeated(documents):
    rows = [(k, "w w w", "en", "small" if k < 10 else "large") for k in range(100)]
    copies = {r.doc_id: r.copies for r in mixing.mix(documents(rows)).collect()}
    seen = {}
    for r in mixing.mixed_rows(documents(rows)).collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: c for k, c in copies.items() if c}


def test_sql_agrees(spark):
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet')")
    want = sorted(con.execute(mixing.ORACLE_SQL).fetchall())
    got = sorted(tuple(r) for r in mixing.op6_systematic_mix(spark, path).collect())
    assert got == want
