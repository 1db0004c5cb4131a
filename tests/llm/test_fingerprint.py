import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from hirelake.llm import fingerprint as fp

PATTERN = re.compile(fp.PARAGRAPHS.replace(r"\z", r"\Z"))


def paragraphs(text):
    return {p for p in PATTERN.findall(text) if p.strip(" ")}


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, got):
    """Against plain sets: rows in order (id, text)."""
    assert len(got) == len(rows)
    for k, (r, (i, text)) in enumerate(zip(got, rows, strict=True)):
        follower = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + follower[:half]
        assert (r.doc_id, r.n_chars) == (i, len(text))
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - likeness(text, edited)) < 1e-9
        assert abs(r.near_next - likeness(text, follower)) < 1e-9


def test_every_document_of_the_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").orderBy("doc_id").collect()]
    check(rows, fp.op7_paragraph_sketch(spark, path).orderBy("doc_id").collect())


def test_difference_sizes(spark):
    """Small differences of large texts, stuck peels and folds of unlike sizes give exact sets."""
    draw = random.Random(6)
    rows = []
    for n in (0, 1, 2, 11, 12, 13, 40, 200, 700):
        for change in (0, 1, n // 2, n):
            lines = [f"line {draw.random()}" for _ in range(n)]
            other = lines[change:] + [f"new {draw.random()}" for _ in range(draw.choice([0, change, 3 * change]))]
            rows.append(("\n".join(lines), "\n".join(other)))
    df = spark.createDataFrame(rows, "a string, b string").repartition(8)
    for name in ("a", "b"):
        df = fp.with_sketch(df, name, name)
    for r in fp.with_likeness(df, "a", "b", "like").select("a", "b", "like").collect():
        assert abs(r.like - likeness(r.a, r.b)) < 1e-9


def test_long_texts_with_nothing_in_common(spark):
    """Thousands of digests that all differ, and one against thousands, are recovered from sketches."""
    rows = [("\n".join(f"a {n} {k}" for k in range(n)), "\n".join(f"b {n} {k}" for k in range(m)))
            for n, m in ((100, 100), (300, 300), (1000, 1000), (1, 5000), (10_000, 10_000))]
    rows += [(a, a + "\n" + b) for a, b in rows]
    df = spark.createDataFrame(rows, "a string, b string").repartition(8)
    for name in ("a", "b"):
        df = fp.with_sketch(df, name, name)
    df = fp.with_likeness(df, "a", "b", "like")
    assert "array_except" not in df._jdf.queryExecution().toString()
    for r in df.select("a", "b", "like").collect():
        assert abs(r.like - likeness(r.a, r.b)) < 1e-9


def test_cost_grows_with_the_paragraphs(spark):
    def seconds(n):
        pair = ("\n".join(f"a {k}" for k in range(n)), "\n".join(f"b {k}" for k in range(n)))
        df = spark.createDataFrame([pair], "a string, b string")
        for name in ("a", "b"):
            df = fp.with_sketch(df, name, name)
        start = time.perf_counter()
        fp.with_likeness(df, "a", "b", "like").select("like").collect()
        return time.perf_counter() - start
    seconds(1000)
    short, long = seconds(5000), seconds(40_000)
    assert long < 24 * short + 5


def test_order_of_ids(spark, documents):
    draw = random.Random(2)
    ids = draw.sample(range(-10**12, 10**12), 150) + list(range(50))
    docs = documents([(i, f"text of {i}", "en", "a") for i in ids])
    got = fp.with_next_text(docs, rows_per_range=7).collect()
    order = sorted(ids)
    want = {i: f"text of {order[(k + 1) % len(order)]}" for k, i in enumerate(order)}
    assert {r.doc_id: r.next_text for r in got} == want


def test_awkward_rows(awkward, clashing, documents):
    got = fp.with_next_text(awkward).collect()
    assert len(got) == awkward.count()
    assert [r.next_text for r in got if r.doc_id == 8] == ["same text here for all"]
    assert sorted(map(str, got)) == sorted(map(str, fp.with_next_text(clashing).collect()))
    assert fp.with_next_text(documents([])).count() == 0
    one = fp.with_next_text(documents([(5, "alone", "en", "a")])).collect()
    assert [r.next_text for r in one] == ["alone"]
    same = fp.with_sketch(awkward.withColumn("text", F.coalesce("text", F.lit(""))), "text", "t")
    written = same.select("text", F.expr(fp._written("s_t", "k_t")).alias("f")).distinct()
    assert written.groupBy("text").count().where("count > 1").count() == 0
