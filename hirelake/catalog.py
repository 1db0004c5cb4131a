"""Registered queries: one per operator group, each over the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (DuckDB SQL over the
same parquet tables, registered as views) produce the same rows and column names.
Time columns are emitted as TIMESTAMP_NTZ (UTC wall time), like the test tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hirelake import oracle as O
from hirelake.functions.json_paths import json_decimal, json_text
from hirelake.functions.text import clean_description
from hirelake.operators import collect as B
from hirelake.operators import metrics as J
from hirelake.operators import quality as K
from hirelake.operators.dedup import cross_source_dedup, latest_per_key
from hirelake.operators.merge import insert_only_merge
from hirelake.plans import gold as G
from hirelake.plans import postings as P
from hirelake.plans.silver import cast_rejects, silver_job_skills, silver_jobs
from hirelake.plans.warehouse import Warehouse
from hirelake.session import apply_sql_defaults, scratch_path
from hirelake.sources.bronze import materialize
from hirelake.sources.envelope import write_envelopes
from hirelake.sources.keyed_table import KeyedTable
from hirelake.sources.landing import (accepted_rows, judged_rows, landing_rows, natural_key, read_landing,
                                      rejected_rows, write_landing)
from hirelake.sources.tables import deal_evenly, read_table, spread_scan
from hirelake.sources.taxonomy import read_taxonomy, write_seed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


# ----------------------------------------------------------------- shared building

def docs(spark, sf):
    apply_sql_defaults(spark)
    return spread_scan(read_table(spark, sf, "documents"))


def bronze(spark, sf):
    return P.bronze_from_documents(docs(spark, sf))


def silver(spark, sf):
    """Silver over a written bronze table: its keys are read without the payloads. The costly
    per-row work runs in tasks over its files, so these are made of equal size."""
    apply_sql_defaults(spark)
    even = P.bronze_from_documents(deal_evenly(read_table(spark, sf, "documents")))
    return silver_jobs(materialize(even, scratch_path(spark, "bronze")))


class Star:
    """The layers above bronze. Silver and the skill table are written as parquet on first
    use, as the warehouse materializes them as tables, and read with pruned columns; a query
    that needs no skills never matches them."""

    def __init__(self, spark: SparkSession, sf: str) -> None:
        self.spark, self.sf = spark, sf

    @cached_property
    def silver(self) -> DataFrame:
        return materialize(silver(self.spark, self.sf), scratch_path(self.spark, "silver"))

    @cached_property
    def skills(self) -> DataFrame:
        return materialize(silver_job_skills(self.silver, read_taxonomy(self.spark)),
                           scratch_path(self.spark, "skills"))

    @property
    def fact(self) -> DataFrame:
        return G.fct_job_postings(self.silver)

    @property
    def companies(self) -> DataFrame:
        return G.dim_companies(self.silver)

    @property
    def dim_skills(self) -> DataFrame:
        return G.dim_skills(self.skills)

    @property
    def bridge(self) -> DataFrame:
        return G.bridge_job_skills(self.skills)

    @property
    def dates(self) -> DataFrame:
        return G.dim_date(self.spark)


SILVER_SQL = "WITH " + O.silver_ctes()
GOLD_SQL = "WITH " + O.gold_ctes()

# ----------------------------------------------------------------------- silver


@register("silver_jobs", SILVER_SQL + """
SELECT job_id, source, keyword, extracted_at_utc, job_title, company_name, job_description,
       job_country, job_city, redirect_url, job_posted_at_utc, salary_is_range,
       salary_min_yearly, salary_max_yearly, normalized_currency, employment_type, is_remote,
       position_level, language_requirement, description_quality_tier
FROM silver""")
def q_silver_jobs(spark, sf):
    s = silver(spark, sf)
    return s.select(*[ntz(c) if c.endswith("_utc") else F.col(c) for c in s.columns])


@register("json_paths", SILVER_SQL + """
SELECT b.job_id, b.source, b.job_title, b.company_name, b.area_first, b.area_last,
       b.location, b.redirect_url, b.job_posted_at, b.contract_time, b.jtype, b.remote,
       b.job_types_text, b.payload_min AS salary_min, b.payload_max AS salary_max
FROM base b""")
def q_json_paths(spark, sf):
    from hirelake.plans.silver import extract_fields
    f = extract_fields(bronze(spark, sf))
    return f.select("job_id", "source", "job_title", "company_name",
                    F.col("_area_first").alias("area_first"), F.col("_area_last").alias("area_last"),
                    F.when(F.col("source") == "arbeitnow", F.col("_location")).alias("location"),
                    "redirect_url", F.col("job_posted_at").cast("timestamp_ntz").alias("job_posted_at"),
                    F.col("_contract_time").alias("contract_time"), F.col("_jtype").alias("jtype"),
                    F.col("_remote").alias("remote"), F.col("_job_types").alias("job_types_text"),
                    F.col("_salary_min").alias("salary_min"), F.col("_salary_max").alias("salary_max"))


@register("event_props", """
SELECT event_type, count(*) AS n_events,
       sum(TRY_CAST(json_extract_string(props, '$.k') AS DECIMAL(38,4))) AS sum_k,
       count(json_extract_string(props, '$.missing')) AS n_missing
FROM events GROUP BY event_type""")
def q_event_props(spark, sf):
    ev = read_table(spark, sf, "events").select("event_type", F.try_parse_json("props").alias("p"))
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(json_decimal(F.col("p"), "$.k")).cast("decimal(38,4)").alias("sum_k"),
        F.count(json_text(F.col("p"), "$.missing")).alias("n_missing"))


@register("html_clean", f"""
SELECT page_id,
       regexp_replace(replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
           '[\\r\\n\\t]+', ' ', 'g'), '&nbsp;', ' '), {O.q('[' + O.PG_SPACE_CHARS + ']{2,}')}, ' ', 'g')
           AS clean_text
FROM pages""")
def q_html_clean(spark, sf):
    pages = spread_scan(read_table(spark, sf, "pages").select("page_id", "html"))
    return pages.select("page_id", clean_description(F.col("html")).alias("clean_text"))


@register("salary_parse", SILVER_SQL + """
SELECT job_id, raw_currency, regex_min, regex_max, salary_period, base_salary_min,
       base_salary_max, salary_is_range, salary_min_yearly, salary_max_yearly, normalized_currency
FROM silver""")
def q_salary_parse(spark, sf):
    from hirelake.plans.silver import enrich, extract_fields
    from hirelake.operators.salary import salary_fields
    e = enrich(extract_fields(bronze(spark, sf)))
    sal = salary_fields(F.col("_sal_pre"), F.col("_sal_suf"))
    return e.select("job_id", "raw_currency",
                    sal["regex_min"].cast("decimal(38,4)").alias("regex_min"),
                    sal["regex_max"].cast("decimal(38,4)").alias("regex_max"),
                    "salary_period", "base_salary_min", "base_salary_max", "salary_is_range",
                    "salary_min_yearly", "salary_max_yearly", "normalized_currency")


@register("country_city", SILVER_SQL + "SELECT job_id, source, job_country, job_city FROM silver")
def q_country_city(spark, sf):
    return silver(spark, sf).select("job_id", "source", "job_country", "job_city")


@register("posting_attributes", SILVER_SQL + """
SELECT job_id, salary_period, employment_type, is_remote, position_level, language_requirement,
       normalized_currency FROM silver""")
def q_posting_attributes(spark, sf):
    from hirelake.plans.silver import enrich, extract_fields
    e = enrich(extract_fields(bronze(spark, sf)))
    return e.select("job_id", "salary_period", "employment_type", "is_remote", "position_level",
                    "language_requirement", "normalized_currency")


@register("quality_tier", SILVER_SQL + """
SELECT job_id, description_quality_tier, length(job_description) AS description_chars
FROM silver""")
def q_quality_tier(spark, sf):
    return silver(spark, sf).select("job_id", "description_quality_tier",
                                    F.length("job_description").alias("description_chars"))


# Two crawls of every posting; the second one is a day later for even ids, a day
# earlier for odd ids, and has no timestamp for every 13th id (NULL sorts first).
def _second_crawl(b: DataFrame) -> DataFrame:
    d = F.col("_source_pos")
    ts = (F.when(F.pmod(d, F.lit(13)) == 0, F.lit(None).cast("timestamp"))
          .when(F.pmod(d, F.lit(2)) == 0, F.col("extracted_at") + F.expr("INTERVAL 1 DAY"))
          .otherwise(F.col("extracted_at") - F.expr("INTERVAL 1 DAY")))
    kw = F.element_at(F.array(*[F.lit(k) for k in P.KEYWORDS]),
                      (F.pmod(d + 1, F.lit(len(P.KEYWORDS))) + 1).cast("int"))
    return b.withColumns({"extracted_at": ts, "keyword": kw,
                          "_source_file": F.lit("documents-crawl-2")})


@register("latest_posting", f"""
WITH p AS ({P.oracle_postings_sql()}),
two AS (
  SELECT job_id, source, keyword, extracted_at, 'documents' AS f, doc_id
  FROM p
  UNION ALL
  SELECT job_id, source,
         ([{", ".join(O.q(k) for k in P.KEYWORDS)}])[((doc_id + 1) % {len(P.KEYWORDS)}) + 1],
         CASE WHEN doc_id % 13 = 0 THEN NULL
              WHEN doc_id % 2 = 0 THEN extracted_at + INTERVAL 1 DAY
              ELSE extracted_at - INTERVAL 1 DAY END,
         'documents-crawl-2', doc_id
  FROM p
)
SELECT job_id, source, keyword, extracted_at FROM (
  SELECT *, row_number() OVER (PARTITION BY job_id, source
                               ORDER BY extracted_at DESC NULLS FIRST, f, doc_id) AS rn
  FROM two) WHERE rn = 1""")
def q_latest_posting(spark, sf):
    b = bronze(spark, sf)
    both = b.unionByName(_second_crawl(b))
    return latest_per_key(both).select("job_id", "source", "keyword", ntz("extracted_at"))


# ----------------------------------------------------------------- skills / gold

@register("skill_match", GOLD_SQL + "SELECT job_id, skill_category, skill_name FROM job_skills")
def q_skill_match(spark, sf):
    return Star(spark, sf).skills


@register("dim_companies", GOLD_SQL + "SELECT company_id, company_name FROM dim_companies")
def q_dim_companies(spark, sf):
    return Star(spark, sf).companies


@register("dim_skills", GOLD_SQL + "SELECT skill_id, skill_category, skill_name FROM dim_skills")
def q_dim_skills(spark, sf):
    return Star(spark, sf).dim_skills


@register("bridge_job_skills", GOLD_SQL + "SELECT job_id, skill_id FROM bridge")
def q_bridge(spark, sf):
    return Star(spark, sf).bridge


@register("fct_job_postings", GOLD_SQL + """
SELECT job_id, company_id, date_id, search_role, job_title, job_posted_at_utc, country, city,
       platform_name, position_level, employment_type, is_remote, salary_min_yearly,
       salary_max_yearly, salary_midpoint_yearly FROM fact""")
def q_fact(spark, sf):
    f = Star(spark, sf).fact
    return f.select(*[ntz(c) if c.endswith("_utc") else F.col(c) for c in f.columns])


@register("date_rollup", GOLD_SQL + """
SELECT d.year, d.quarter, d.month, d.month_name, d.day_of_week, d.is_weekend,
       count(*) AS n_postings, count(DISTINCT f.company_id) AS n_companies
FROM fact f LEFT JOIN dim_date d ON f.date_id = d.date_id
GROUP BY d.year, d.quarter, d.month, d.month_name, d.day_of_week, d.is_weekend""")
def q_date_rollup(spark, sf):
    s = Star(spark, sf)
    return (s.fact.join(F.broadcast(s.dates), "date_id", "left")
            .groupBy("year", "quarter", "month", "month_name", "day_of_week", "is_weekend")
            .agg(F.count(F.lit(1)).alias("n_postings"),
                 F.countDistinct("company_id").alias("n_companies")))


@register("star_query", GOLD_SQL + """
SELECT f.search_role, d.year, s.skill_name,
       count(DISTINCT f.job_id) AS n_postings, count(DISTINCT c.company_name) AS n_companies,
       count(*) - count(d.date_id) AS n_outside_calendar
FROM fact f LEFT JOIN dim_companies c ON f.company_id = c.company_id
LEFT JOIN dim_date d ON f.date_id = d.date_id
JOIN bridge b ON f.job_id = b.job_id JOIN dim_skills s ON b.skill_id = s.skill_id
GROUP BY f.search_role, d.year, s.skill_name""")
def q_star_query(spark, sf):
    s = Star(spark, sf)
    keys = ["search_role", "year", "skill_name"]
    j = G.star_query(s.fact, s.companies, s.dates, s.bridge, s.dim_skills)
    # one row per posting, then per company: no row is expanded for a second distinct count
    postings = (j.groupBy(*keys, "job_id").agg(F.count(F.lit(1)).alias("_n"), F.count("full_date").alias("_dated"))
                .groupBy(*keys).agg(F.count(F.lit(1)).alias("n_postings"),
                                    (F.sum("_n") - F.sum("_dated")).alias("n_outside_calendar")))
    companies = (j.groupBy(*keys, "company_name").count()
                 .groupBy(*keys).agg(F.count("company_name").alias("n_companies")))
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    return postings.alias("p").join(companies.alias("c"), same).select(
        *[F.col(f"p.{k}") for k in keys], "n_postings", "n_companies", "n_outside_calendar")


# ----------------------------------------------------------------------- metrics

@register("skill_demand", GOLD_SQL + """
SELECT s.skill_name, s.skill_category,
       list_reduce(list_transform(string_split(replace(s.skill_name, '_', ' '), ' '),
                   lambda x: upper(x[1]) || lower(x[2:])), lambda a, b: a || ' ' || b) AS skill_label,
       c.n_postings
FROM (SELECT skill_id, count(DISTINCT job_id) AS n_postings FROM bridge GROUP BY skill_id) c
JOIN dim_skills s ON c.skill_id = s.skill_id
ORDER BY c.n_postings DESC, s.skill_name ASC LIMIT 10""")
def q_skill_demand(spark, sf):
    s = Star(spark, sf)
    return J.skill_demand(s.bridge, s.dim_skills, top_n=10)


@register("skill_demand_by_role", GOLD_SQL + """
SELECT s.skill_name, s.skill_category,
       list_reduce(list_transform(string_split(replace(s.skill_name, '_', ' '), ' '),
                   lambda x: upper(x[1]) || lower(x[2:])), lambda a, b: a || ' ' || b) AS skill_label,
       c.n_postings
FROM (SELECT skill_id, count(DISTINCT job_id) AS n_postings FROM bridge
      WHERE job_id IN (SELECT job_id FROM fact WHERE search_role = 'Backend')
      GROUP BY skill_id) c
JOIN dim_skills s ON c.skill_id = s.skill_id
ORDER BY c.n_postings DESC, s.skill_name ASC LIMIT 10""")
def q_skill_demand_by_role(spark, sf):
    s = Star(spark, sf)
    return J.skill_demand(s.bridge, s.dim_skills, top_n=10, fact=s.fact, role="Backend")


@register("median_salary_by_role", GOLD_SQL + """
SELECT search_role, median(CAST(salary_midpoint_yearly AS DOUBLE)) AS median_salary,
       count(salary_midpoint_yearly) AS n_postings
FROM fact WHERE salary_midpoint_yearly IS NOT NULL GROUP BY search_role""")
def q_median_salary(spark, sf):
    return J.median_salary_by_role(Star(spark, sf).fact)


@register("remote_share", GOLD_SQL + """
SELECT search_role, platform_name, count(*) AS n_postings,
       sum(CASE WHEN is_remote = 'yes' THEN 1 ELSE 0 END) AS n_remote,
       sum(CASE WHEN is_remote = 'yes' THEN 1 ELSE 0 END) / count(*) AS remote_share
FROM fact GROUP BY search_role, platform_name""")
def q_remote_share(spark, sf):
    return J.remote_share(Star(spark, sf).fact, ["search_role", "platform_name"])


@register("highest_paying_skills", GOLD_SQL + f"""
SELECT s.skill_name, s.skill_category, m.n_postings, m.median_salary FROM (
  SELECT b.skill_id, count(*) AS n_postings,
         median(CAST(f.salary_midpoint_yearly AS DOUBLE)) AS median_salary
  FROM fact f JOIN bridge b ON f.job_id = b.job_id
  WHERE f.salary_midpoint_yearly IS NOT NULL GROUP BY b.skill_id
  HAVING count(*) >= {J.MIN_POSTINGS_PER_SKILL}) m
JOIN dim_skills s ON m.skill_id = s.skill_id""")
def q_highest_paying(spark, sf):
    s = Star(spark, sf)
    return J.highest_paying_skills(s.fact, s.bridge, s.dim_skills)


def _outlier_sql(c: str) -> str:
    return f"CASE WHEN {c} BETWEEN 10000 AND {J.OUTLIER_HIGH} THEN {c} END"


@register("salary_outliers", GOLD_SQL + f"""
SELECT job_id, platform_name, CAST(lo AS DECIMAL(38,4)) AS salary_min_yearly,
       CAST(hi AS DECIMAL(38,4)) AS salary_max_yearly,
       CAST(CASE WHEN lo IS NOT NULL AND hi IS NOT NULL THEN (lo + hi) / 2 END AS DECIMAL(38,4))
           AS salary_midpoint_yearly
FROM (SELECT job_id, platform_name, {_outlier_sql('salary_min_yearly')} AS lo,
             {_outlier_sql('salary_max_yearly')} AS hi FROM fact)""")
def q_salary_outliers(spark, sf):
    return J.without_outliers(Star(spark, sf).fact)


@register("exclude_tier3", SILVER_SQL + """
SELECT job_id, source, job_country, description_quality_tier FROM silver
WHERE NOT starts_with(description_quality_tier, 'Tier 3')""")
def q_exclude_tier3(spark, sf):
    return J.exclude_tier3(Star(spark, sf).silver).select("job_id", "source", "job_country",
                                                     "description_quality_tier")


@register("cross_source_dedup", SILVER_SQL + """
SELECT job_id, source, job_title, company_name, job_city FROM (
  SELECT *, first(source) OVER (
      PARTITION BY lower(trim(job_title)), lower(trim(company_name)), lower(job_city)
      ORDER BY job_posted_at_utc DESC NULLS LAST, source, job_id) AS board
  FROM silver)
WHERE source = board OR job_title IS NULL OR company_name IS NULL OR job_city IS NULL""")
def q_cross_source_dedup(spark, sf):
    return cross_source_dedup(Star(spark, sf).silver).select("job_id", "source", "job_title",
                                                        "company_name", "job_city")


@register("quality_checks", GOLD_SQL + """
SELECT 'dim_companies' AS table_name, 'company_id' AS column_name, 'unique' AS check_name,
       CAST((SELECT count(*) FROM (SELECT company_id FROM dim_companies WHERE company_id IS NOT NULL
             GROUP BY company_id HAVING count(*) > 1)) AS BIGINT) AS failures
UNION ALL SELECT 'dim_companies', 'company_id', 'not_null',
       CAST((SELECT count(*) FROM dim_companies WHERE company_id IS NULL) AS BIGINT)
UNION ALL SELECT 'dim_skills', 'skill_id', 'unique',
       CAST((SELECT count(*) FROM (SELECT skill_id FROM dim_skills WHERE skill_id IS NOT NULL
             GROUP BY skill_id HAVING count(*) > 1)) AS BIGINT)
UNION ALL SELECT 'dim_skills', 'skill_id', 'not_null',
       CAST((SELECT count(*) FROM dim_skills WHERE skill_id IS NULL) AS BIGINT)
UNION ALL SELECT 'fct_job_postings', 'job_id', 'unique',
       CAST((SELECT count(*) FROM (SELECT job_id FROM fact WHERE job_id IS NOT NULL
             GROUP BY job_id HAVING count(*) > 1)) AS BIGINT)
UNION ALL SELECT 'fct_job_postings', 'job_id', 'not_null',
       CAST((SELECT count(*) FROM fact WHERE job_id IS NULL) AS BIGINT)
UNION ALL SELECT 'fct_job_postings', 'company_id', 'not_null',
       CAST((SELECT count(*) FROM fact WHERE company_id IS NULL) AS BIGINT)""")
def q_quality_checks(spark, sf):
    s = Star(spark, sf)
    return K.run_checks(s.fact, s.companies, s.dim_skills)


# ------------------------------------------------------------ collection / ingest

FETCH_SQL = f"WITH log AS ({P.oracle_fetch_log_sql()})"
FIRST_SEEN_SQL = FETCH_SQL + f""",
bucketed AS (
  SELECT *, CASE {' '.join(f"WHEN contains(lower(title), {O.q(k.lower())}) THEN {O.q(k)}"
                           for k in B.JOB_KEYWORDS)} END AS title_keyword
  FROM log
),
tagged AS (
  SELECT *, row_number() OVER (PARTITION BY source, job_key
        ORDER BY keyword_rank, page, position, fetch_seq) AS n_seen
  FROM bucketed WHERE source <> 'arbeitnow'
  UNION ALL
  SELECT *, row_number() OVER (PARTITION BY source, job_key ORDER BY page, position, fetch_seq)
  FROM bucketed WHERE source = 'arbeitnow'
),
kept AS (
  SELECT * REPLACE (CASE WHEN source = 'arbeitnow' THEN title_keyword ELSE keyword END AS keyword)
  FROM tagged WHERE n_seen = 1 AND (source <> 'arbeitnow' OR title_keyword IS NOT NULL)
)"""


def _tagged(spark, sf) -> DataFrame:
    return B.tag_first_seen(P.fetch_log(docs(spark, sf)))


def _kept(spark, sf) -> DataFrame:
    return B.kept_rows(_tagged(spark, sf)).withColumn("country", F.lit(B.TARGET_COUNTRY))


@register("first_seen_dedup", FIRST_SEEN_SQL + """
SELECT source, job_key, keyword, page, position FROM kept""")
def q_first_seen(spark, sf):
    firsts = B.first_sights(P.fetch_log(docs(spark, sf)), ["keyword", "title", "page", "position"])
    kept = B.own_keyword(firsts.withColumn("title_keyword", B.bucket_keyword(F.col("title"))))
    return kept.select("source", "job_key", "keyword", "page", "position")


@register("keyword_bucket", FIRST_SEEN_SQL + """
SELECT doc_id, title, title_keyword AS keyword FROM bucketed WHERE title_keyword IS NOT NULL""")
def q_keyword_bucket(spark, sf):
    log = P.fetch_log(docs(spark, sf))
    return (log.select("doc_id", "title", B.bucket_keyword(F.col("title")).alias("keyword"))
            .filter(F.col("keyword").isNotNull()))


@register("collection_counters", FIRST_SEEN_SQL + """,
pages AS (
  SELECT source, CASE WHEN source <> 'arbeitnow' THEN keyword END AS keyword, page,
         count(*) AS n_fetched,
         count(*) FILTER (n_seen = 1 AND (source <> 'arbeitnow' OR title_keyword IS NOT NULL)) AS n_kept,
         count(*) FILTER (n_seen > 1) AS n_duplicate,
         count(*) FILTER (n_seen = 1 AND source = 'arbeitnow' AND title_keyword IS NULL) AS n_unmatched
  FROM tagged GROUP BY ALL)
SELECT p.*, CAST(sum(n_kept) OVER (PARTITION BY p.source, keyword ORDER BY page
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total,
       u.n_unique_ids
FROM pages p JOIN (SELECT source, count(DISTINCT job_key) AS n_unique_ids FROM log GROUP BY source) u
  ON p.source = u.source""")
def q_collection_counters(spark, sf):
    return B.collection_counters(_tagged(spark, sf))


@register("envelope_wrap", FIRST_SEEN_SQL + f"""
SELECT source, 'austria' AS country, keyword, CAST(fetch_seq // {B.ENVELOPE_CHUNK} AS BIGINT) AS part,
       max(total) AS total_records, count(*) AS n_jobs,
       md5(string_agg(job_key, ',' ORDER BY fetch_seq)) AS jobs_in_order
FROM (SELECT *, count(*) OVER (PARTITION BY source, keyword) AS total FROM kept)
GROUP BY source, keyword, fetch_seq // {B.ENVELOPE_CHUNK}""")
def q_envelope_wrap(spark, sf):
    env = B.wrap_envelope(_kept(spark, sf))
    ids = F.transform("jobs", lambda j: F.coalesce(json_text(j, "$.id"), json_text(j, "$.slug")))
    return env.select("source", "country", "keyword", "part", "total_records",
                      F.size("jobs").cast("long").alias("n_jobs"),
                      F.md5(F.array_join(ids, ",").cast("binary")).alias("jobs_in_order"))


LANDING_DAY, LANDING_NEXT_DAY = "2026-04-01", "2026-04-02"


def _write_day(spark, jobs: DataFrame, root: str, day: str) -> None:
    write_landing(jobs.select("source", "country", "keyword", "raw_data"), root,
                  extracted_at=F.lit(f"{day} 06:00:00").cast("timestamp"))


LANDED_SQL = FIRST_SEEN_SQL + f"""
SELECT job_key AS job_id, source, keyword, 'austria' AS country,
       TIMESTAMP '{{day}} 06:00:00' AS extracted_at
FROM kept WHERE NOT (source = 'jooble' AND jooble_id = 0)"""


@register("landing_roundtrip", LANDED_SQL.format(day=LANDING_DAY))
def q_landing_roundtrip(spark, sf):
    root = scratch_path(spark, "landing")
    _write_day(spark, _kept(spark, sf), root, LANDING_DAY)
    rows = landing_rows(spark, root, LANDING_DAY)
    return rows.select("job_id", "source", "keyword", "country", ntz("extracted_at"))


@register("landing_one_day", LANDED_SQL.format(day=LANDING_NEXT_DAY).replace(
    "source, keyword, 'austria'", "source, 'next ' || keyword AS keyword, 'austria'"))
def q_landing_one_day(spark, sf):
    """Two days in the lake, every job on both, on the second under other keywords; only the
    second day is read."""
    kept = _kept(spark, sf)
    root = scratch_path(spark, "landing")
    _write_day(spark, kept, root, LANDING_DAY)
    _write_day(spark, kept.withColumn("keyword", F.concat(F.lit("next "), "keyword")), root, LANDING_NEXT_DAY)
    rows = landing_rows(spark, root, LANDING_NEXT_DAY)
    return rows.select("job_id", "source", "keyword", "country", ntz("extracted_at"))


# Landing records with faults: by doc_id modulo 13, cut off, a repeated payload key, no
# source, a bad date, no id.
FAULT_CYCLE = 13
FAULTS_SQL = f"""CASE doc_id % {FAULT_CYCLE} WHEN 0 THEN 'corrupt' WHEN 2 THEN 'no_source'
  WHEN 3 THEN 'bad_timestamp' WHEN 4 THEN 'no_key' ELSE 'loaded' END"""


def _faulty_lines(documents: DataFrame) -> DataFrame:
    d = F.col("doc_id")
    fault = F.pmod(d, F.lit(FAULT_CYCLE))
    # the text as a JSON string: {"v":"..."} without its frame
    text = F.expr("coalesce(substring(_json, 6, length(_json) - 6), 'null')")
    key = F.when(fault == 4, F.lit('"id":0')).otherwise(F.concat(F.lit('"id":"'), d.cast("string"), F.lit('"')))
    repeated = F.when(fault == 1, F.lit(',"title":"first","title":"last"')).otherwise(F.lit(',"title":"only"'))
    source = F.when(fault == 2, F.lit("null")).otherwise(F.lit('"adzuna"'))
    date = F.when(fault == 3, F.lit("yesterday")).otherwise(F.lit(f"{LANDING_DAY}T06:00:00"))
    line = F.concat(F.lit('{"extracted_at":"'), date, F.lit('","source":'), source,
                    F.lit(',"country":"austria","keyword":"Cloud","job":{'), key, repeated,
                    F.lit(',"description":'), text, F.lit("}}"))
    made = documents.withColumn("_json", F.to_json(F.struct(F.col("text").alias("v")))).select(
        fault.alias("_fault"), line.alias("_line"))
    return made.select(F.when(F.col("_fault") == 0, F.expr("substring(_line, 1, length(_line) - 3)"))
                       .otherwise(F.col("_line")).alias("value"))


@register("landing_rejects", f"""
SELECT {FAULTS_SQL} AS outcome, count(*) AS n_records,
       count(*) FILTER (doc_id % {FAULT_CYCLE} = 1) AS n_last_title
FROM documents GROUP BY 1""")
def q_landing_rejects(spark, sf):
    root = scratch_path(spark, "landing-faults")
    day = f"{root}/p_source=adzuna/p_country=austria/year=2026/month=04/day=01/keyword_slug=cloud"
    _faulty_lines(docs(spark, sf)).write.text(day)
    judged = judged_rows(read_landing(spark, root, LANDING_DAY))
    title = json_text(F.col("raw_data"), "$.title")
    both = accepted_rows(judged).select(F.lit("loaded").alias("outcome"), title.alias("t")).unionByName(
        rejected_rows(judged).select(F.col("reject_reason").alias("outcome"), title.alias("t")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_records"),
                                       F.count_if(F.col("t") == "last").alias("n_last_title"))


@register("insert_only_merge", FETCH_SQL + """,
keyed AS (SELECT * FROM log WHERE NOT (source = 'jooble' AND jooble_id = 0)),
loads AS (SELECT 1 AS load_run, * FROM keyed WHERE fetch_seq % 2 = 0
          UNION ALL SELECT 2, * FROM keyed WHERE fetch_seq % 3 = 0
          UNION ALL SELECT 3, * FROM keyed),
firsts AS (SELECT job_key, source, min(load_run) AS load_run FROM loads GROUP BY 1, 2),
batches AS (SELECT load_run, count(*) AS batch_records FROM loads GROUP BY 1),
news AS (SELECT load_run, count(*) AS new_records FROM firsts GROUP BY 1)
SELECT b.load_run, batch_records, coalesce(new_records, 0) AS new_records,
       batch_records - coalesce(new_records, 0) AS skipped_records
FROM batches b LEFT JOIN news n ON b.load_run = n.load_run""")
def q_insert_only_merge(spark, sf):
    """Three loads into one table: batches that repeat keys within and overlap in part."""
    log = P.fetch_log(docs(spark, sf))
    fetched = materialize(log.select("source", "raw_data", "fetch_seq"), scratch_path(spark, "log"))
    keyed = natural_key(fetched) \
        .withColumns({"_source_file": F.lit("fetch"), "_source_pos": F.col("fetch_seq")})
    keyed = materialize(keyed.select("job_id", "source", "_source_file", "_source_pos"),
                        scratch_path(spark, "fetched"))
    path = scratch_path(spark, "bronze")
    sizes = None
    for run, step in ((1, 2), (2, 3), (3, 1)):
        batch = keyed.filter(F.col("_source_pos") % step == 0).withColumn("load_run", F.lit(run))
        insert_only_merge(path, batch)
        n = batch.groupBy("load_run").agg(F.count(F.lit(1)).alias("batch_records"))
        sizes = n if sizes is None else sizes.unionByName(n)
    news = spark.read.parquet(path).groupBy("load_run").agg(F.count(F.lit(1)).alias("new_records"))
    new = F.coalesce("new_records", F.lit(0))
    return sizes.join(news, "load_run", "left").select(
        "load_run", "batch_records", new.cast("long").alias("new_records"),
        (F.col("batch_records") - new).alias("skipped_records"))


@register("daily_run", GOLD_SQL + """,
tables AS (
  SELECT 'silver_jobs' AS name, count(*) AS n FROM silver
  UNION ALL SELECT 'silver_job_skills', count(*) FROM job_skills
  UNION ALL SELECT 'fct_job_postings', count(*) FROM fact
  UNION ALL SELECT 'dim_companies', count(*) FROM dim_companies
  UNION ALL SELECT 'dim_skills', count(*) FROM dim_skills
  UNION ALL SELECT 'dim_date', count(*) FROM dim_date
  UNION ALL SELECT 'bridge_job_skills', count(*) FROM bridge),
steps AS (
  SELECT 'rows' AS step, name, n FROM tables
  UNION ALL SELECT 'rejected_cast', unnest(['salary_min', 'salary_max', 'remote', 'job_posted_at']), 0
  UNION ALL SELECT 'check', unnest(['dim_companies.company_id unique', 'dim_companies.company_id not_null',
    'dim_skills.skill_id unique', 'dim_skills.skill_id not_null', 'fct_job_postings.job_id not_null',
    'fct_job_postings.company_id not_null']), 0
  UNION ALL SELECT 'check', 'fct_job_postings.job_id unique',
    (SELECT count(*) FROM (SELECT job_id FROM fact GROUP BY 1 HAVING count(*) > 1))),
loads AS (
  SELECT 'load' AS step, 'batch_records' AS name, count(*) AS first, count(*) AS again FROM documents
  UNION ALL SELECT 'load', 'new_records', count(*), 0 FROM documents
  UNION ALL SELECT 'load', 'skipped_records', 0, count(*) FROM documents)
SELECT r.run, step, name, n FROM steps, (SELECT unnest([1, 2]) AS run) r
UNION ALL SELECT 1, step, name, first FROM loads UNION ALL SELECT 2, step, name, again FROM loads""")
def q_daily_run(spark, sf):
    """All postings landed as envelope files of one day; the whole run on them, twice."""
    lake = scratch_path(spark, "lake")
    write_envelopes(bronze(spark, sf), lake, F.lit(f"{LANDING_DAY} 06:00:00").cast("timestamp"), order=("_source_pos",))
    root = scratch_path(spark, "warehouse")
    house = Warehouse(spark, root, prefix=f"run_{root[-12:]}_", buckets=16)
    seed = read_taxonomy(spark)
    reports = [house.daily_run(lake, LANDING_DAY, seed).withColumn("run", F.lit(run)) for run in (1, 2)]
    return reports[0].unionByName(reports[1]).select("run", "step", "name", "n")


@register("keyed_table_loads", ORACLE["insert_only_merge"])
def q_keyed_table_loads(spark, sf):
    """The same three loads into the bucketed table; the result is the audit it keeps."""
    log = P.fetch_log(docs(spark, sf))
    keyed = natural_key(log.select("source", "raw_data", "fetch_seq")).select(
        "job_id", "source", F.lit("fetch").alias("_source_file"), F.col("fetch_seq").alias("_source_pos"))
    keyed = materialize(keyed, scratch_path(spark, "fetched"))
    table = KeyedTable(spark, scratch_path(spark, "keyed"), keyed.schema, buckets=16)
    for step in (2, 3, 1):
        table.merge(keyed.filter(F.col("_source_pos") % step == 0))
    return table.loads().drop("load_id")


@register("envelope_files", LANDED_SQL.format(day=LANDING_DAY))
def q_envelope_files(spark, sf):
    """Written as one envelope file per board and keyword, read back in that layout."""
    root = scratch_path(spark, "envelopes")
    write_envelopes(_kept(spark, sf), root, F.lit(f"{LANDING_DAY} 06:00:00").cast("timestamp"))
    rows = landing_rows(spark, root, LANDING_DAY, layout="plain")
    return rows.select("job_id", "source", "keyword", "country", ntz("extracted_at"))


# Envelope files above this size are read in parts by the query below: every file here.
ENVELOPE_PART_BYTES = 32 << 10


@register("envelope_split", LANDED_SQL.format(day=LANDING_DAY))
def q_envelope_split(spark, sf):
    """Envelope files read back in parts, each file by many tasks."""
    root = scratch_path(spark, "envelopes")
    write_envelopes(_kept(spark, sf), root, F.lit(f"{LANDING_DAY} 06:00:00").cast("timestamp"))
    rows = landing_rows(spark, root, LANDING_DAY, layout="plain", split_bytes=ENVELOPE_PART_BYTES)
    return rows.select("job_id", "source", "keyword", "country", ntz("extracted_at"))


# Payloads with values of the wrong kind, by doc_id: the cycle of each column's bad value.
BAD_VALUE_EVERY = {"salary_min": 7, "salary_max": 11, "remote": 5, "job_posted_at": 13}


def _misfit_bronze(documents: DataFrame) -> DataFrame:
    d = F.col("doc_id")
    source = F.element_at(F.array(*[F.lit(s) for s in P.SOURCES]), (F.pmod(d, F.lit(3)) + 1).cast("int"))
    bad = {c: F.pmod(d, F.lit(n)) == 0 for c, n in BAD_VALUE_EVERY.items()}
    stamp = F.when(bad["job_posted_at"], F.lit("soon")).otherwise(
        F.when(source == "arbeitnow", F.lit("1775023200")).otherwise(F.lit("2026-04-01T06:00:00Z")))
    raw = F.to_variant_object(F.struct(
        d.cast("string").alias("id"), F.col("text").alias("description"), F.col("text").alias("snippet"),
        F.when(bad["salary_min"], F.lit("a lot")).otherwise(F.lit("50000")).alias("salary_min"),
        F.when(bad["salary_max"], F.lit("")).when(F.pmod(d, F.lit(2)) == 0, F.lit("70000")).alias("salary_max"),
        F.when(bad["remote"], F.lit("maybe")).otherwise(F.lit("true")).alias("remote"),
        stamp.alias("created"), stamp.alias("updated"), stamp.alias("created_at")))
    return documents.select(d.cast("string").alias("job_id"), source.alias("source"), F.lit("Cloud").alias("keyword"),
                            F.lit(f"{LANDING_DAY} 06:00:00").cast("timestamp").alias("extracted_at"),
                            raw.alias("raw_data"), F.lit("documents").alias("_source_file"), d.alias("_source_pos"))


@register("cast_rejects", """
SELECT column_name, count(text) AS n_values, count(*) FILTER (text IS NOT NULL AND value IS NULL) AS n_rejected FROM (
  SELECT 'salary_min' AS column_name, v AS text, TRY_CAST(v AS DECIMAL(38,4))::VARCHAR AS value
  FROM (SELECT CASE WHEN doc_id % 7 = 0 THEN 'a lot' ELSE '50000' END AS v FROM documents)
  UNION ALL SELECT 'salary_max', v, TRY_CAST(v AS DECIMAL(38,4))::VARCHAR
  FROM (SELECT CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 2 = 0 THEN '70000' END AS v FROM documents)
  UNION ALL SELECT 'remote', v, TRY_CAST(v AS BOOLEAN)::VARCHAR
  FROM (SELECT CASE WHEN doc_id % 5 = 0 THEN 'maybe' ELSE 'true' END AS v FROM documents)
  UNION ALL SELECT 'job_posted_at', v, CASE WHEN doc_id % 3 = 2 THEN TRY_CAST(v AS DOUBLE)::VARCHAR
                                            ELSE TRY_CAST(v AS TIMESTAMPTZ)::VARCHAR END
  FROM (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'soon' WHEN doc_id % 3 = 2 THEN '1775023200'
                            ELSE '2026-04-01T06:00:00Z' END AS v FROM documents)) GROUP BY 1""")
def q_cast_rejects(spark, sf):
    """Values of the payloads that silver could not cast, counted while it is written."""
    casts = Observation("casts")
    bronze_t = materialize(_misfit_bronze(docs(spark, sf)), scratch_path(spark, "bronze"))
    materialize(silver_jobs(bronze_t, casts), scratch_path(spark, "silver"))
    return cast_rejects(spark, casts)


@register("stream_ingest", FIRST_SEEN_SQL + """
SELECT job_key AS job_id, source, keyword, 'austria' AS country FROM kept
WHERE NOT (source = 'jooble' AND jooble_id = 0)""")
def q_stream_ingest(spark, sf):
    from hirelake.streaming.ingest import ingest_available
    root = scratch_path(spark, "landing")
    _write_day(spark, _kept(spark, sf), root, LANDING_DAY)
    base = scratch_path(spark, "stream")
    bronze_t = ingest_available(spark, root, f"{base}/bronze", f"{base}/_checkpoint")
    return bronze_t.select("job_id", "source", "keyword", "country")


# ------------------------------------------------------------- seed, layers, payload text

@register("skill_match_csv_seed", GOLD_SQL + """
SELECT skill_category, skill_name, count(*) AS n_postings FROM job_skills GROUP BY 1, 2""")
def q_skill_match_csv_seed(spark, sf):
    seed = read_taxonomy(spark, write_seed(spark, scratch_path(spark, "seed")))
    found = silver_job_skills(Star(spark, sf).silver, seed)
    return found.groupBy("skill_category", "skill_name").agg(F.count(F.lit(1)).alias("n_postings"))


@register("layer_partitioned", SILVER_SQL + """
SELECT source, job_country, count(*) AS n_postings, count(salary_min_yearly) AS n_salaries
FROM silver WHERE source = 'jooble' GROUP BY 1, 2""")
def q_layer_partitioned(spark, sf):
    """A layer table written in partitions; the filter reads one partition."""
    narrow = Star(spark, sf).silver.select("source", "job_country", "salary_min_yearly")
    table = materialize(narrow, scratch_path(spark, "layer"), partition_by=["source"])
    return table.filter(F.col("source") == "jooble").groupBy("source", "job_country").agg(
        F.count(F.lit(1)).alias("n_postings"), F.count("salary_min_yearly").alias("n_salaries"))


@register("payload_text", SILVER_SQL + """
SELECT job_id, source, title, salary, length(body) AS body_chars FROM postings""")
def q_payload_text(spark, sf):
    from hirelake.functions.json_paths import payload_to_text
    rows = bronze(spark, sf).select("job_id", "source", payload_to_text("raw_data").alias("j"))
    field = lambda name: F.get_json_object("j", f"$.{name}")
    return rows.select("job_id", "source", field("title").alias("title"), field("salary").alias("salary"),
                       F.length(F.coalesce(field("description"), field("snippet"))).cast("long").alias("body_chars"))
