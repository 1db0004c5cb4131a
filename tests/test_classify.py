"""Each classifier label is reached, per source."""

from pyspark.sql import functions as F

from hirelake.plans.silver import silver_jobs
from hirelake.sources.bronze import BRONZE_SCHEMA


def bronze_of(spark, rows):
    """rows: (job_id, source, payload-json)."""
    df = spark.createDataFrame(rows, "job_id string, source string, js string")
    return df.select(
        "job_id", "source", F.lit("Backend").alias("keyword"), F.lit("austria").alias("country"),
        F.lit("2026-04-01 06:00:00").cast("timestamp").alias("extracted_at"),
        F.parse_json("js").alias("raw_data"), F.current_timestamp().alias("ingested_at"),
        F.lit("t").alias("_source_file"), F.lit(1).cast("long").alias("_source_pos"),
    ).select(*[f.name for f in BRONZE_SCHEMA.fields])


LONG = " filler" * 30


def test_country_city_per_source(spark):
    rows = [
        ("a1", "adzuna", '{"title":"x","location":{"area":["Österreich","Wien","Wien"]}}'),
        ("a2", "adzuna", '{"title":"x","location":{"area":["Schweiz"]}}'),
        ("a3", "adzuna", '{"title":"x","location":{"area":["UK","London"]}}'),
        ("j1", "jooble", '{"title":"x","snippet":"Job in Graz, Austria"}'),
        ("j2", "jooble", '{"title":"x","snippet":"Team in Bangalore"}'),
        ("j3", "jooble", '{"title":"x","snippet":"zusammen in Berlin"}'),
        ("j4", "jooble", '{"title":"x","snippet":"in a team"}'),
        ("b1", "arbeitnow", '{"title":"x","location":"Leipzig, Sachsen"}'),
        ("b2", "arbeitnow", '{"title":"x","location":" germany "}'),
        ("b3", "arbeitnow", '{"title":"x","location":"Basel"}'),
        ("o1", "other", '{"title":"x"}'),
    ]
    got = {r["job_id"]: (r["job_country"], r["job_city"])
           for r in silver_jobs(bronze_of(spark, rows)).collect()}
    assert got == {
        "a1": ("AT", "Wien"), "a2": ("CH", None), "a3": ("UK", "London"),
        "j1": ("AT", "graz"), "j2": ("IN", None), "j3": ("US", "berlin"), "j4": ("Unknown", None),
        "b1": ("DE", "Leipzig"), "b2": ("DE", None), "b3": ("CH", "Basel"), "o1": ("Unknown", None),
    }


def test_attribute_labels(spark):
    rows = [
        ("1", "adzuna", '{"title":"Senior Dev","contract_time":"full_time","description":"Remote first."}'),
        ("2", "jooble", '{"title":"Junior Dev","type":"Part-time","snippet":"vor Ort"}'),
        ("3", "arbeitnow", '{"title":"Dev","remote":false,"job_types":["berufserfahren"],'
                           '"description":"Full/ Part-time: full-time. home office"}'),
        ("4", "arbeitnow", '{"title":"Werkstudent","remote":true,"description":"Teilzeit; C1 level"}'),
        ("5", "adzuna", '{"title":"Intern","description":"Minijob, on-site. German is an advantage"}'),
        ("6", "adzuna", '{"title":"Trainee","description":"no german required"}'),
        ("7", "adzuna", '{"title":"Medior Dev","description":"geringfügig"}'),
        ("8", "adzuna", '{"title":"Dev","description":"nothing here"}'),
    ]
    got = {r["job_id"]: r for r in silver_jobs(bronze_of(spark, rows)).collect()}
    assert [got[k]["employment_type"] for k in "12345678"] == [
        "vollzeit", "teilzeit", "vollzeit", "teilzeit", "minijob", "not_specified", "minijob", "not_specified"]
    assert [got[k]["is_remote"] for k in "12345678"] == [
        "yes", "no", "no", "yes", "no", "not_specified", "not_specified", "not_specified"]
    assert [got[k]["position_level"] for k in "12345678"] == [
        "senior", "junior", "middle", "werkstudent", "internship", "trainee", "middle", "not_specified"]
    assert [got[k]["language_requirement"] for k in "12345678"] == [
        "not_specified", "not_specified", "not_specified", "german_fluent", "german_basic",
        "english_only", "not_specified", "not_specified"]


def test_quality_tiers(spark):
    rows = [
        ("1", "adzuna", '{"title":"x"}'),
        ("2", "adzuna", '{"title":"x","description":"short"}'),
        ("3", "adzuna", '{"title":"x","description":"based in India' + LONG + '"}'),
        ("4", "adzuna", '{"title":"x","description":"ok' + LONG + '"}'),
        ("5", "adzuna", '{"title":"x","description":"ok' + LONG * 3 + '"}'),
    ]
    got = {r["job_id"]: r["description_quality_tier"]
           for r in silver_jobs(bronze_of(spark, rows)).collect()}
    assert got == {"1": "Tier 3 - Missing Description", "2": "Tier 3 - Too Short",
                   "3": "Tier 3 - Geo Mismatch", "4": "Tier 2 - Partial", "5": "Tier 1 - Valid"}


def test_html_and_whitespace(spark):
    rows = [("1", "adzuna", '{"title":"x","description":"<p>a</p>\\r\\n\\tb&nbsp;&nbsp;c   d"}')]
    r = silver_jobs(bronze_of(spark, rows)).first()
    assert r["job_description"] == " a b c d"


def test_latest_per_key_nulls_first(spark):
    from hirelake.operators.dedup import latest_per_key
    df = spark.createDataFrame(
        [("1", "s", "2026-04-01 00:00:00", "f", 1), ("1", "s", None, "f", 2),
         ("2", "s", "2026-04-01 00:00:00", "f", 3), ("2", "s", "2026-04-02 00:00:00", "f", 4)],
        "job_id string, source string, extracted_at string, _source_file string, _source_pos long"
    ).withColumn("extracted_at", F.col("extracted_at").cast("timestamp"))
    got = {r["job_id"]: r["_source_pos"] for r in latest_per_key(df).collect()}
    assert got == {"1": 2, "2": 4}
