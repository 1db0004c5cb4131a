"""Salary golden rows (FIXTURES 5) through the silver salary columns."""

from decimal import Decimal

from pyspark.sql import functions as F

from hirelake.plans.silver import enrich, extract_fields
from hirelake.sources.bronze import BRONZE_SCHEMA

D = Decimal
GOLDEN = [  # text, raw currency, min, max, period, min yearly, max yearly
    ("€ 65.000 - 80.000", "€", D(65000), D(80000), "yearly", D(65000), D(80000)),
    ("EUR 65,5k–80k per year", "eur", D(65500), D(80000), "yearly", D(65500), D(80000)),
    ("50-60k €", "€", D(50), D(60000), "yearly", None, D(60000)),
    ("3.500 brutto monatlich", "brutto", D(3500), None, "monthly", D(49000), None),
    ("25 € per hour", "€", D(25), None, "hourly", D(45000), None),
    ("$120k", "$", D(120000), None, "yearly", D(120000), None),
    ("entrepreneur 5 years", "eur", D(5), None, "yearly", None, None),
    ("1.234.567 eur", "eur", D(234567), None, "yearly", D(234567), None),
    ("competitive salary", "eur", None, None, "yearly", None, None),
    ("€ 55.000 (bis 70.000 €)", "€", D(55000), None, "yearly", D(55000), None),
    ("40.000 - 50.000 EUR", "eur", D(40000), D(50000), "yearly", D(40000), D(50000)),
    ("€ 45k, later 60-70k eur", "€", D(45000), D(70000), "yearly", D(45000), D(70000)),
    ("2.800-3.200 € /monat", "€", D(2800), D(3200), "monthly", D(39200), D(44800)),
    ("£ 900", "£", D(900), None, "yearly", None, None),
]


def test_salary_golden(spark):
    rows = [(str(i), "jooble", "Backend", "austria", None, None, None, "t", i)
            for i, _ in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "job_id string, source string, keyword string, country string,"
                               " extracted_at timestamp, raw_data string, ingested_at timestamp,"
                               " _source_file string, _source_pos long")
    texts = spark.createDataFrame([(str(i), g[0]) for i, g in enumerate(GOLDEN)], "job_id string, s string")
    df = df.drop("raw_data").join(texts, "job_id").withColumn(
        "raw_data", F.to_variant_object(F.struct(F.lit("t").alias("title"), F.col("s").alias("salary"))))
    out = enrich(extract_fields(df.select(*[f.name for f in BRONZE_SCHEMA.fields])))
    got = {r["job_id"]: r for r in out.collect()}
    for i, (text, cur, lo, hi, period, ylo, yhi) in enumerate(GOLDEN):
        r = got[str(i)]
        assert r["raw_currency"] == cur, text
        assert r["base_salary_min"] == lo, text
        assert r["base_salary_max"] == hi, text
        assert r["salary_period"] == period, text
        assert r["salary_min_yearly"] == ylo, text
        assert r["salary_max_yearly"] == yhi, text
        assert r["salary_is_range"] == (lo is not None and hi is not None), text


def test_payload_number_wins(spark):
    df = spark.createDataFrame([("1", "adzuna", "monthly pay 3.000 eur")], "job_id string, source string, s string")
    df = df.select("job_id", "source", F.lit(None).cast("string").alias("keyword"),
                   F.lit(None).cast("string").alias("country"), F.lit(None).cast("timestamp").alias("extracted_at"),
                   F.to_variant_object(F.struct(F.col("s").alias("description"),
                                                F.lit(5000).alias("salary_min"))).alias("raw_data"),
                   F.lit(None).cast("timestamp").alias("ingested_at"),
                   F.lit(None).cast("string").alias("_source_file"), F.lit(1).cast("long").alias("_source_pos"))
    r = enrich(extract_fields(df)).first()
    assert r["base_salary_min"] == D(5000)
    assert r["salary_min_yearly"] == D(70000)   # a payload amount is still x14 when text says monthly


def test_token_in_body_or_last_words(spark):
    """The first token of a text counts, wherever it stands; its match is the whole text's."""
    from hirelake.functions.regex import first_match
    from hirelake.operators import salary as S
    amounts = ["€ 65.000", "50k usd", "neuro", "12 brutto 3", "$", "a£900", "7eur8"]
    fill = ["", "w " * 30, "ä" * 300, "\U0001f600 " * 20, "1" * 250, "  "]
    texts = [f"{a}{x}{b}{y}{c}" for a in fill for x in amounts for b in fill for y in ("", amounts[1], "eur") for c in ("", " a b", fill[1])]
    rows = spark.createDataFrame([(t,) for t in [*texts, "", None]], "salary_text string")
    out = S.with_salary_matches(rows).select("salary_text", "_sal_pre", "_sal_suf",
                                             first_match(F.col("salary_text"), S.SALARY_PREFIX).alias("p"),
                                             first_match(F.col("salary_text"), S.SALARY_SUFFIX).alias("s"))
    for r in out.collect():
        assert (r._sal_pre, r._sal_suf) == (r.p, r.s), r.salary_text
