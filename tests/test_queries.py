"""Registered queries vs the DuckDB oracle, order independence, skill matching, plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from hirelake import catalog
from hirelake.functions.regex import ci_pattern
from hirelake.operators.skills import skill_match
from hirelake.plans.postings import bronze_from_documents
from hirelake.plans.silver import searchable_postings, silver_jobs
from hirelake.sources.tables import read_table
from hirelake.sources.taxonomy import read_taxonomy, taxonomy_rows, write_seed

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ORACLE_SUBSET = ["silver_jobs", "skill_match", "fct_job_postings", "median_salary_by_role",
                 "quality_checks", "landing_roundtrip", "first_seen_dedup", "latest_posting",
                 "landing_rejects", "insert_only_merge", "envelope_wrap", "collection_counters",
                 "cross_source_dedup", "date_rollup", "star_query"]


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from hirelake.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def _norm(cols, rows):
    import sys, os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from compare_oracle import rows_of
    return rows_of(cols, rows)


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(catalog.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", ORACLE_SUBSET)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF01)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm(df.columns, [tuple(r) for r in df.collect()]) == _norm(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["skill_name", "skill_category", "skill_label", "n_postings"]
    assert 0 < df.count() <= 10


def test_order_independence(spark):
    docs = read_table(spark, SF001, "documents")
    a = silver_jobs(bronze_from_documents(docs))
    b = silver_jobs(bronze_from_documents(docs.orderBy(F.desc("doc_id")).repartition(5)))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _plain_match(jobs, tax):
    """Every pattern on every text, in plain Python."""
    rows = [(r["category"], r["standard_name"], re.compile(ci_pattern(r["regex_pattern"]).replace("(?iUs)", "(?is)").replace(r"\z", r"\Z")))
            for r in tax.collect()]
    return {(j["job_id"], c, n) for j in jobs.collect() for c, n, p in rows if p.search(j["searchable_text"])}


def test_skill_match_equals_plain_regexes(spark, tmpdir_path):
    tax = read_taxonomy(spark, write_seed(spark, f"{tmpdir_path}/taxonomy"))
    assert sorted(map(tuple, tax.collect())) == sorted(taxonomy_rows())
    jobs = searchable_postings(catalog.Star(spark, SF001).silver)
    got = [tuple(r) for r in skill_match(jobs, tax).collect()]
    assert len(got) == len(set(got)) and set(got) == _plain_match(jobs, tax)


def test_skill_match_pattern_forms(spark):
    """Whole words, beginnings, optional characters, no boundary, folding hazards, groups."""
    patterns = [r"\yjava\y", r"\yjava", r"java", r"\ynode\.?js\y|\ynode\y", r"\yscikit[- ]learn\y", r"\yc\+\+\y",
                r"\yc#(?=\W|$)|(?<!\w)\.net\y", r"\ys/4hana\y", r"\y(spark|apache spark)\y", r"\ya_b\y", r"\yx?yz\y",
                r"\ykafka+\y", r"\yskill\y", r"\yüber\y"]
    texts = ["Java javascript", "JAVA", "xjava", "nodejs", "node.js NODE", "scikit-learn", "Scikit learning", "c++11 c++",
             "use C# now", ".NET", "asp.net", "S/4HANA", "apache Spark", "a_b a b", "yz xyz", "kafkaaa", "sKill \u017fkill",
             "Über \u0130", "", "node_js c#x"]
    jobs = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "job_id string, searchable_text string")
    tax = spark.createDataFrame([("c", f"p{k}", p) for k, p in enumerate(patterns)],
                                "category string, standard_name string, regex_pattern string")
    assert {tuple(r) for r in skill_match(jobs, tax).collect()} == _plain_match(jobs, tax)


def test_large_seed_in_one_scan(spark):
    """3,000 patterns take the same path as 61."""
    words = [f"skill{k}x" for k in range(3000)]
    tax = spark.createDataFrame([("c", w, rf"\y{w}\y|\y{w} tool\y") for w in words],
                                "category string, standard_name string, regex_pattern string")
    jobs = spark.createDataFrame([(str(k), f"we use {words[k * 7 % 3000]} and {words[k]}, not {words[k + 1]}s")
                                  for k in range(200)], "job_id string, searchable_text string")
    df = skill_match(jobs, tax)
    want = {(str(k), "c", w) for k in range(200) for w in (words[k * 7 % 3000], words[k])}
    assert {tuple(r) for r in df.collect()} == want
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_latest_posting_shuffles_keys_only(spark):
    """The rows replaced are found on narrow rows; payloads stay where they were read."""
    from hirelake.operators.dedup import latest_per_key, older_rows
    b = bronze_from_documents(read_table(spark, SF001, "documents"))
    plan = older_rows(b)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "raw_data" not in plan
    assert "Exchange hashpartitioning" not in latest_per_key(b)._jdf.queryExecution().executedPlan().toString()


def test_cross_source_dedup_rules(spark):
    from datetime import datetime

    from hirelake.operators.dedup import cross_source_dedup
    day = lambda d: d and datetime(2026, 1, d)
    rows = [("1", "a", "Dev", "X", "Wien", 3), ("2", "b", " dev", "x ", "wien", 9), ("3", "b", "DEV", "X", "Wien", 1),
            ("4", "a", "Dev", None, "Wien", 3), ("5", "b", "Dev", None, "Wien", 4), ("6", "a", "Dev", "X", None, 3),
            ("7", "a", "QA", "Y", "Graz", 2), ("8", "a", "QA", "Y", "Graz", 5), ("9", "c", "QA", "Y", "Graz", None)]
    df = spark.createDataFrame([(*r[:5], day(r[5])) for r in rows], "job_id string, source string, job_title string, "
                               "company_name string, job_city string, job_posted_at_utc timestamp")
    # board b has the newest Dev posting and keeps both; incomplete keys are nobody's copy
    assert sorted(r["job_id"] for r in cross_source_dedup(df).collect()) == ["2", "3", "4", "5", "6", "7", "8"]


def test_counters_add_up(spark):
    for r in catalog.QUERIES["collection_counters"](spark, SF01).collect():
        assert min(r["n_kept"], r["n_duplicate"], r["n_unmatched"]) >= 0
        assert r["n_kept"] + r["n_duplicate"] + r["n_unmatched"] == r["n_fetched"]


def test_hot_key_is_spread(spark):
    """Rows without an id share one key: the repeats are found by key and order, with no window."""
    from hirelake.operators.collect import first_sights, tag_first_seen
    rows = [("jooble", "0", k % 5, 1, k, k, f"t{k}") for k in range(500)] + [("jooble", str(k), 1, 1, k, 500 + k, "Cloud") for k in range(1, 20)]
    rows += [("arbeitnow", "s", 9, 2, 1, 600, "a"), ("arbeitnow", "s", 1, 3, 1, 601, "b"), ("adzuna", None, 1, 1, 1, 602, "x"), ("adzuna", None, 1, 1, 2, 603, "y")]
    log = spark.createDataFrame(rows, "source string, job_key string, keyword_rank int, page int, position int, fetch_seq long, title string")
    tagged = tag_first_seen(log)
    assert "Window" not in tagged._jdf.queryExecution().executedPlan().toString()
    firsts = {(r.source, r.job_key, r.fetch_seq) for r in tagged.filter("is_first").collect()}
    assert firsts == {("jooble", "0", 0), *(("jooble", str(k), 500 + k) for k in range(1, 20)), ("arbeitnow", "s", 600), ("adzuna", None, 602)}
    assert tagged.count() == len(rows)
    assert {tuple(r) for r in first_sights(log, ["fetch_seq"]).collect()} == firsts


def test_blanks(spark):
    from hirelake.functions.text import clean_description
    texts = ["a \t\r\n b", "a b", "a  b", "a – b", "x\x0by  z", "\x0b\x0c", " a  ", "a  b", "a&nbsp; b", None, ""]
    got = [r.c for r in spark.createDataFrame([(t,) for t in texts], "t string").select(clean_description(F.col("t")).alias("c")).collect()]
    assert got == ["a b", "a b", "a b", "a – b", "x\x0by z", " ", " a ", "a  b", "a b", None, ""]


def test_skills_by_words_alone(spark):
    """Alternatives of one word run as no regular expression; odd words and folds agree with it."""
    from hirelake.functions.word_index import one_words
    from hirelake.operators import skills
    assert one_words(r"\ysap\y|\ysap bw\y|\yS_4\y") == (["sap", "s_4"], r"\ysap bw\y")
    assert one_words(r"(?i)\ysap\y") == ([], r"(?i)\ysap\y")
    assert skills._literals_sql(r"\yphp\y") == "cast(array() AS array<string>)" and "sap bw" in skills._literals_sql(r"\ysap bw\y|\ysap\y")
    patterns = [r"\ysap\y|\ysap bw\y", r"\ykafka\y", r"\yc\+\+\y|\ycpp\y", r"\yai\y|\yai lab[s]?\y|lab", r"\yit_s\y", "x+y"]
    texts = ["SAP", "ſap bw", "\u212aafka!", "kafka\u0301", "sap_bw", "C++x cpp", "İt ai", "Aİ", "it_s", "LABS", "sap-ähnlich", "äsap", "XXY", "cppx", ""]
    seed = spark.createDataFrame([("c", f"p{i}", p) for i, p in enumerate(patterns)], "category string, standard_name string, regex_pattern string")
    jobs = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "job_id string, searchable_text string")
    got = {(r.job_id, r.skill_name) for r in skills.skill_match(jobs, seed).collect()}
    plain = {(r.job_id, f"p{i}") for i, p in enumerate(patterns)
             for r in jobs.where(F.col("searchable_text").rlike(ci_pattern(p))).collect()}
    assert got == plain and len(got) > 8


def test_silver_tasks_are_even(spark, tmpdir_path, monkeypatch):
    """A table of a few more files than cores is dealt evenly before bronze is written."""
    import glob

    from hirelake.sources.tables import deal_evenly
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'web' AS source")
    rows.repartition(cores + 2).write.parquet(f"{tmpdir_path}/documents.parquet")
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: f"{tmpdir_path}/{name}")
    silver = catalog.silver(spark, tmpdir_path)
    files = glob.glob(f"{tmpdir_path}/bronze/part-*")
    assert len(files) == 4 * cores and silver.count() > 380
    counts = [r[0] for r in spark.read.parquet(f"{tmpdir_path}/bronze").groupBy("_metadata.file_path").count().select("count").collect()]
    assert sum(counts) == 400 and max(counts) <= 2 * 400 / (4 * cores)
    many = spark.range(0, 400, 1, 4 * cores)
    assert deal_evenly(many) is many
