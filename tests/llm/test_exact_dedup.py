from pyspark.sql import functions as F

from hirelake.llm import exact_dedup


def groups_by_hand(rows):
    """Per text the largest id (no id is smallest) and the number of rows."""
    by_text = {}
    for i, t, *_ in rows:
        by_text.setdefault(t or "", []).append(i)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in by_text.items()}


def check(docs, got):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = groups_by_hand(rows)
    assert sorted(str((i, want[t or ""])) for i, t in rows) == sorted(
        str((r.doc_id, (r.keep_id, r.group_size))) for r in got)
    assert sum(r.kept for r in got) == len(want)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_awkward_rows(awkward, clashing, documents):
    check(awkward, exact_dedup.exact_groups(awkward).collect())
    check(clashing, exact_dedup.exact_groups(clashing).collect())
    kept = exact_dedup.drop_copies(clashing)
    assert kept.columns == clashing.columns and kept.count() == len(
        {r.text or "" for r in awkward.collect()})
    assert exact_dedup.exact_groups(documents([])).count() == 0


def test_bytes_decide_where_digests_clash(documents):
    rows = [(k, f"text {k % 40}", "en", "a") for k in range(200)]
    docs = documents(rows)
    weak = exact_dedup.exact_groups(docs, digest=lambda t: F.unhex(F.lpad(F.hex(F.length(t)), 8, "0")))
    check(docs, weak.collect())


def test_state_goes_on(spark, documents, tmpdir_path):
    first = exact_dedup.exact_groups(documents([(1, "x", "en", "a"), (2, "y", "en", "a")]), state_dir=tmpdir_path)
    assert {r.doc_id: r.group_size for r in first.collect()} == {1: 1, 2: 1}
    later = exact_dedup.exact_groups(documents([(0, "x", "en", "a"), (9, "y", "en", "a")]), state_dir=tmpdir_path)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in later.collect()}
    assert got == {0: (1, 2, False), 9: (9, 2, True)}
