"""Text rules stay linear on junk, and equal the plain patterns."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from hirelake.functions.text import clean_description
from hirelake.operators import salary as S


@pytest.mark.parametrize("junk", ["1" * 100_000, "5" + " " * 100_000, "1 " * 50_000, "<" * 100_000, "<a" * 50_000,
                                  "1." * 50_000, "eur" + " " * 100_000, "5-" + "1" * 100_000])
def test_long_runs(spark, junk):
    df = spark.createDataFrame([(junk,)], "salary_text string")
    out = S.with_salary_matches(df).select("_sal_pre", "_sal_suf", clean_description(F.col("salary_text")).alias("c"))
    out.collect()  # compiles
    t = time.time()
    out.collect()
    assert time.time() - t < 1.5


def test_suffix_search_equals_pattern():
    draw = random.Random(1)
    bits = ["1", "23", ".", ",", " ", "  ", "-", "k", "eur", "€", "brutto", "x", "–", "$"]
    plain, linear = re.compile(S.SALARY_SUFFIX), re.compile(S._SUFFIX_SEARCH)
    for _ in range(60_000):
        text = "".join(draw.choice(bits) for _ in range(draw.randint(1, 14)))
        a, b = plain.search(text), linear.search(text)
        assert (a and a.group(0)) == (b and b.group(0)), text
        if a:
            c = plain.match(a.group(0))  # groups are read again from the match
            assert c.groups() == a.groups(), text


def test_cleaning_equals_plain_pattern(spark):
    draw = random.Random(2)
    bits = ["<", ">", "<b>", "</p>", "a", " ", "\n", "\t", "\r\n", "&nbsp;", "<>", "é"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 20))) for _ in range(800)] + ["", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", clean_description(F.col("t")).alias("c")).collect():
        want = r["t"]
        if want is not None:
            want = re.sub(r"[\r\n\t]+", " ", re.sub(r"<[^>]+>", " ", want)).replace("&nbsp;", " ")
            want = re.sub(r"[ \t\n\x0b\f\r]{2,}", " ", want)
        assert r["c"] == want


def test_fixed_values():
    """Pinned apart from the constants the queries and their SQL share."""
    assert (S.MONTHLY_FACTOR, S.HOURLY_FACTOR, S.THOUSAND, S.YEARLY_FLOOR) == (14, 1800, 1000, 10000)
    from hirelake.operators import metrics as J
    assert (J.MIN_POSTINGS_PER_SKILL, J.OUTLIER_HIGH) == (5, 300000)
    from hirelake.plans import gold as G
    assert (G.DATE_START, G.DATE_END, G.MONTH_NAME_WIDTH) == ("2024-01-01", "2026-12-31", 9)
    from hirelake.operators import collect as B
    assert B.JOB_KEYWORDS == ["Data Engineer", "Data Analyst", "Backend", "Cloud", "DevOps"]
    from hirelake.sources.taxonomy import taxonomy_rows
    assert len(taxonomy_rows()) == 61 and taxonomy_rows()[4] == ("tech_stack", "typescript", r"\ytypescript\y")


def test_checkpoint_folder_needed_on_a_cluster(spark, monkeypatch):
    from hirelake import session

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master, applicationId = "spark://host:7077", "x"
    with pytest.raises(RuntimeError):
        session.checkpoint_root(Cluster)


def test_salary_search_from_first_currency(spark):
    """Searching from the first currency token on gives the first matches in the whole text; of what
    stands before only the last characters are looked at, unless all of them may belong to an amount."""
    draw = random.Random(4)
    bits = ["1", "23", ".", ",", " ", "-", "k", "eur", "\u20ac", "brutto", "x", "\u2013", "$", "usd", "\u00a3", "e", "u", "\U0001f600", "\u00fc",
            "x" * 250, "1" * 250, " " * 250, "7" + " " * 250]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 12))) for _ in range(3000)] + [""]
    rows = spark.createDataFrame([(t,) for t in texts], "salary_text string")
    pre, suf = re.compile(S.SALARY_PREFIX), re.compile(S.SALARY_SUFFIX)
    for r in S.with_salary_matches(rows).collect():
        a, b = pre.search(r["salary_text"]), suf.search(r["salary_text"])
        assert (r["_sal_pre"], r["_sal_suf"]) == (a[0] if a else "", b[0] if b else ""), r["salary_text"]
    cut = S.with_salary_matches(spark.createDataFrame([("x" * 5000 + " 40 eur and more",)], "salary_text string")).first()
    assert len(cut["_sal_near"]) == 200 and cut["_sal_rest"] == "eur and more" and cut["_sal_suf"] == "40 eur"
