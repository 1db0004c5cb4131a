"""Job postings derived from the driver's ``documents`` table.

The driver tables hold invented prose, not job postings, so postings are built from
``documents`` deterministically: every document becomes one posting whose full text
is the description (or jooble ``snippet``), with a test phrase appended. Source,
title, salary text, location and flags come from the literal lists below by
``doc_id`` modulo the list length. Every document is used, whole.

The same arithmetic is rendered as DuckDB SQL (``oracle_postings_sql``) so the oracle
computes the expected columns without building JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Test inputs (our own, chosen so that every rule of the silver layer fires).
SOURCES = ["adzuna", "jooble", "arbeitnow"]
KEYWORDS = ["Data Engineer", "Data Analyst", "Backend", "Cloud", "DevOps"]
TITLES = [
    "Senior Data Engineer (m/w/d)",
    "Junior Backend Developer",
    "Werkstudent Data Analyst",
    "Cloud Engineer - Internship",
    "DevOps Trainee",
    "Mid-Level Backend Engineer",
    "Data Analyst",
    "Lead Cloud Architect",
    "Sr. DevOps Engineer",
    "Entry Level Data Engineer",
    "Praktikum Backend Entwicklung",
    "Platform Engineer",
    "BI Developer Jr.",
]
EXTRA_TEXT = [
    "<p>We use <b>Python</b>, Spark and SQL.</p> Full-time, remote possible.",
    "Vollzeit &nbsp; vor Ort in Wien.\r\nDeutsch C1 erforderlich.",
    "Part-time role.\tHome office 2 days. English only team.",
    "Teilzeit, hybrid. German B2 nice to have. Kubernetes, Docker, AWS.",
    "Full/Part-time: Part-time\nOn-site in Graz. Java 17, Spring Boot.",
    "Minijob. Work from home. C# & .NET, Azure DevOps.",
    "100%ig Remote! golang, Go lang, Terraform, CI/CD.",
    "Office-based in Berlin. React.js, TypeScript, Node.js.",
    "<div class=\"x\">Machine Learning, PyTorch, scikit-learn, LLM</div>",
    "Working language: English. dbt, Snowflake, Airflow, BigQuery.",
    "Präsenz im Büro in Zürich. SAP S/4HANA, Excel, Power BI.",
    "Geringfügig beschäftigt. C++ dev, C++dev, Rust, Scala, Kafka.",
    "Team in Bangalore and India. Fließend Deutsch. Tableau.",
    "Full/ part time: full time; WFH on Fridays. MongoDB, Redis.",
    "",
    "Based in Hamburg, usa clients. German language skills required. R Studio, PHP.",
    "ÖSTERREICH, Linz. 100% remote. Kotlin, Angular, Vue.js, GraphQL.",
]
SALARY_TEXTS = [
    "€ 65.000 - 80.000",
    "EUR 65,5k–80k per year",
    "50-60k €",
    "3.500 brutto monatlich",
    "25 € per hour",
    "$120k",
    "entrepreneur 5 years",
    "1.234.567 eur",
    "competitive salary",
    "€ 55.000 (bis 70.000 €)",
    "40.000 - 50.000 EUR",
    "€ 45k, later 60-70k eur",
    "2.800-3.200 € /monat",
    "£ 900",
    None,
]
AREAS = [
    ["Österreich", "Wien", "Wien"],
    ["Austria", "Steiermark", "Graz"],
    ["Deutschland", "Bayern", "München"],
    ["Schweiz", "Zürich"],
    ["Österreich"],
    ["UK", "London"],
    [],
]
LOCATIONS = [
    "Wien, Österreich",
    "Berlin, Germany",
    " germany ",
    "Zürich",
    "Leipzig",
    "Remote",
    "Linz, Upper Austria",
    None,
]
CONTRACT_TIMES = ["full_time", "part_time", None, "contract"]
JOOBLE_TYPES = ["Full-time", "Part-time", "Temporary", None]
JOB_TYPES = [["senior", "full time"], ["berufserfahren"], ["entry level", "internship"], []]
EPOCH_START = "2024-01-01 00:00:00"
POSTED_SPREAD_SECONDS = 1200 * 86400  # reaches into 2027: some dates have no dim_date row
POSTED_STEP = 1_000_003  # spreads the dates over the whole range from a few hundred documents on
NO_TITLE_EVERY, NO_BODY_EVERY, SHARED_ID_EVERY = 23, 29, 31  # remainders 5, 7 and 3
EXTRACTED_AT = "2026-04-01 06:00:00"


def _pick(values: list, idx: Column) -> Column:
    """``values[idx]`` for a literal list (idx is 0-based)."""
    lits = []
    for v in values:
        if isinstance(v, list):
            lits.append(F.array(*[F.lit(x) for x in v]).cast("array<string>"))
        else:
            lits.append(F.lit(v).cast("string"))
    return F.element_at(F.array(*lits), (idx + 1).cast("int"))


def _mod(doc_id: Column, n: int) -> Column:
    return F.pmod(doc_id, F.lit(n))


def posting_columns(docs: DataFrame) -> DataFrame:
    """Typed posting fields, one row per document (no JSON yet)."""
    d = F.col("doc_id")
    posted = F.timestamp_seconds(
        F.unix_seconds(F.lit(EPOCH_START).cast("timestamp"))
        + F.pmod(d * F.lit(POSTED_STEP), F.lit(POSTED_SPREAD_SECONDS)))
    extra = _pick(EXTRA_TEXT, _mod(d, len(EXTRA_TEXT)))
    body = F.when(extra == "", F.col("text")).otherwise(F.concat(F.col("text"), F.lit(" "), extra))
    body = F.when(_mod(d, NO_BODY_EVERY) != 7, body)
    adzuna_paid = _mod(d, 4) == 1
    sal_min = 30000 + _mod(d, 40) * 1000
    keep = [c for c in ("_h",) if c in docs.columns]
    return docs.select(
        F.col("doc_id"), *keep,
        # now and then the id that another board uses for the document before
        F.when(_mod(d, SHARED_ID_EVERY) == 3, d - 1).otherwise(d).cast("string").alias("job_id"),
        _pick(SOURCES, _mod(d, 3)).alias("source"),
        _pick(KEYWORDS, _mod(d, 5)).alias("keyword"),
        F.when(_mod(d, NO_TITLE_EVERY) != 5, _pick(TITLES, _mod(d, len(TITLES)))).alias("title"),
        F.when(_mod(d, 17) != 0, F.concat(F.lit("Company "), F.upper(F.col("source"))))
        .alias("company"),
        body.alias("body"),
        _pick(SALARY_TEXTS, _mod(d, len(SALARY_TEXTS))).alias("salary"),
        F.when(adzuna_paid, sal_min).alias("salary_min"),
        F.when(adzuna_paid, sal_min + 12000).alias("salary_max"),
        _pick(AREAS, _mod(d, len(AREAS))).alias("area"),
        _pick(LOCATIONS, _mod(d, len(LOCATIONS))).alias("location"),
        _pick(CONTRACT_TIMES, _mod(d, len(CONTRACT_TIMES))).alias("contract_time"),
        _pick(JOOBLE_TYPES, _mod(d, len(JOOBLE_TYPES))).alias("jtype"),
        _pick(JOB_TYPES, _mod(d, len(JOB_TYPES))).alias("job_types"),
        F.when(_mod(d, 5) != 0, _mod(d, 2) == 0).alias("remote"),
        posted.alias("posted_at"),
        F.concat(F.lit("https://jobs.example/"), d.cast("string")).alias("url"),
    )


def payload(p: DataFrame) -> Column:
    """The raw job object, shaped as its source delivers it (VARIANT)."""
    src = F.col("source")
    adzuna = F.to_variant_object(F.struct(
        F.col("job_id").alias("id"),
        F.col("title"),
        F.struct(F.col("company").alias("display_name")).alias("company"),
        F.col("body").alias("description"),
        F.struct(F.col("area")).alias("location"),
        F.col("url").alias("redirect_url"),
        F.date_format("posted_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created"),
        F.col("salary_min"), F.col("salary_max"),
        F.col("salary"),
        F.col("contract_time"),
    ))
    jooble = F.to_variant_object(F.struct(
        F.col("job_id").cast("bigint").alias("id"),
        F.col("title"),
        F.col("company"),
        F.col("body").alias("snippet"),
        F.col("url").alias("link"),
        F.date_format("posted_at", "yyyy-MM-dd HH:mm:ss").alias("updated"),
        F.col("salary"),
        F.col("jtype").alias("type"),
    ))
    arbeit = F.to_variant_object(F.struct(
        F.col("job_id").alias("slug"),
        F.col("title"),
        F.col("company").alias("company_name"),
        F.col("body").alias("description"),
        F.col("location"),
        F.col("url"),
        F.unix_seconds("posted_at").alias("created_at"),
        F.col("remote"),
        F.col("job_types"),
        F.col("salary"),
    ))
    return F.when(src == "adzuna", adzuna).when(src == "jooble", jooble).otherwise(arbeit)


def bronze_from_documents(docs: DataFrame) -> DataFrame:
    """Bronze rows (schema of ``hirelake.sources.bronze.BRONZE_COLUMNS``), one per document."""
    p = posting_columns(docs)
    return p.select(
        "job_id", "source", "keyword",
        F.lit("austria").alias("country"),
        (F.lit(EXTRACTED_AT).cast("timestamp")
         + F.make_dt_interval(hours=F.pmod(F.col("doc_id"), F.lit(24)).cast("int")))
        .alias("extracted_at"),
        payload(p).alias("raw_data"),
        F.lit(EXTRACTED_AT).cast("timestamp").alias("ingested_at"),
        F.lit("documents").alias("_source_file"),
        F.col("doc_id").alias("_source_pos"),
    )


# ----------------------------------------------------------------------- DuckDB side

def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, list):
        return "[" + ", ".join(_sql_lit(x) for x in v) + "]::VARCHAR[]"
    return "'" + str(v).replace("'", "''") + "'"


def _sql_pick(values: list, n_expr: str) -> str:
    return "([" + ", ".join(_sql_lit(v) for v in values) + f"])[({n_expr}) + 1]"


def oracle_postings_sql() -> str:
    """DuckDB SELECT with the typed fields of ``posting_columns`` + per-source paths."""
    m = lambda n: f"(doc_id % {n})"  # noqa: E731 - doc_id is never negative
    extra = _sql_pick(EXTRA_TEXT, m(len(EXTRA_TEXT)))
    return f"""
    SELECT doc_id,
           CAST(CASE WHEN {m(SHARED_ID_EVERY)} = 3 THEN doc_id - 1 ELSE doc_id END AS VARCHAR) AS job_id,
           {_sql_pick(SOURCES, m(3))} AS source,
           {_sql_pick(KEYWORDS, m(5))} AS keyword,
           CASE WHEN {m(NO_TITLE_EVERY)} <> 5 THEN {_sql_pick(TITLES, m(len(TITLES)))} END AS title,
           CASE WHEN {m(17)} <> 0 THEN 'Company ' || upper(documents.source) END AS company,
           CASE WHEN {m(NO_BODY_EVERY)} <> 7 THEN
                CASE WHEN {extra} = '' THEN text ELSE text || ' ' || {extra} END END AS body,
           {_sql_pick(SALARY_TEXTS, m(len(SALARY_TEXTS)))} AS salary,
           CASE WHEN {m(4)} = 1 THEN 30000 + {m(40)} * 1000 END AS salary_min,
           CASE WHEN {m(4)} = 1 THEN 30000 + {m(40)} * 1000 + 12000 END AS salary_max,
           {_sql_pick(AREAS, m(len(AREAS)))} AS area,
           {_sql_pick(LOCATIONS, m(len(LOCATIONS)))} AS location,
           {_sql_pick(CONTRACT_TIMES, m(len(CONTRACT_TIMES)))} AS contract_time,
           {_sql_pick(JOOBLE_TYPES, m(len(JOOBLE_TYPES)))} AS jtype,
           {_sql_pick(JOB_TYPES, m(len(JOB_TYPES)))} AS job_types,
           CASE WHEN {m(5)} <> 0 THEN {m(2)} = 0 END AS remote,
           TIMESTAMP '{EPOCH_START}' + to_seconds((doc_id * {POSTED_STEP}) % {POSTED_SPREAD_SECONDS})
               AS posted_at,
           TIMESTAMP '{EXTRACTED_AT}' + to_hours(doc_id % 24) AS extracted_at
    FROM documents
    """


# ------------------------------------------------------------------ fetch log fixture
# Collection-time rows: every document is a job fetched by one source under one
# keyword, on a page and position of the result list. The job id is derived from the
# text, so exact copies in ``documents`` are the same job fetched twice.
PAGE_SIZE = 50
MAX_PAGES = 10
JOOBLE_MISSING_ID_EVERY = 13  # jooble rows with id 0 (falsy: dropped when loading)


def fetch_log(docs: DataFrame) -> DataFrame:
    d = F.col("doc_id")
    h = F.md5(F.col("text"))
    jooble_id = F.when(_mod(d, JOOBLE_MISSING_ID_EVERY) == 1, F.lit(0).cast("bigint")) \
        .otherwise(F.conv(F.substring(F.col("_h"), 1, 12), 16, 10).cast("bigint"))
    p = posting_columns(docs.withColumn("_h", h))
    base = p.select(
        "doc_id", "source", "keyword", "title", "company", "body", "salary", "url",
        (_mod(d, 5) + 1).cast("int").alias("keyword_rank"),
        (F.pmod(F.floor(d / PAGE_SIZE), F.lit(MAX_PAGES)) + 1).cast("int").alias("page"),
        _mod(d, PAGE_SIZE).cast("int").alias("position"),
        d.alias("fetch_seq"),
        F.substring(F.col("_h"), 1, 16).alias("_hex16"),
        F.when(F.col("source") == "jooble", jooble_id).alias("_jooble_id"),
    )
    key = F.when(F.col("source") == "jooble", F.col("_jooble_id").cast("string")) \
        .otherwise(F.col("_hex16"))
    raw = (F.when(F.col("source") == "adzuna", F.to_variant_object(F.struct(
                F.col("_hex16").alias("id"), F.col("title"),
                F.struct(F.col("company").alias("display_name")).alias("company"),
                F.col("body").alias("description"), F.col("url").alias("redirect_url"))))
           .when(F.col("source") == "jooble", F.to_variant_object(F.struct(
               F.col("_jooble_id").alias("id"), F.col("title"), F.col("company"),
               F.col("body").alias("snippet"), F.col("url").alias("link"))))
           .otherwise(F.to_variant_object(F.struct(
               F.col("_hex16").alias("slug"), F.col("title"),
               F.col("company").alias("company_name"), F.col("body").alias("description"),
               F.col("url")))))
    return base.select("doc_id", "source", "keyword", "keyword_rank", "page", "position",
                       "fetch_seq", "title", key.alias("job_key"), raw.alias("raw_data"))


def oracle_fetch_log_sql() -> str:
    m = lambda n: f"(doc_id % {n})"
    hex16 = "substr(md5(text), 1, 16)"
    jooble_id = (f"CASE WHEN {m(JOOBLE_MISSING_ID_EVERY)} = 1 THEN 0 "
                 f"ELSE CAST(('0x' || substr(md5(text), 1, 12)) AS BIGINT) END")
    src = _sql_pick(SOURCES, m(3))
    return f"""
    SELECT doc_id, {src} AS source, {_sql_pick(KEYWORDS, m(5))} AS keyword,
           CAST({m(5)} + 1 AS INTEGER) AS keyword_rank,
           CAST(((doc_id // {PAGE_SIZE}) % {MAX_PAGES}) + 1 AS INTEGER) AS page,
           CAST({m(PAGE_SIZE)} AS INTEGER) AS position,
           doc_id AS fetch_seq,
           CASE WHEN {m(NO_TITLE_EVERY)} <> 5 THEN {_sql_pick(TITLES, m(len(TITLES)))} END AS title,
           CASE WHEN {src} = 'jooble' THEN CAST({jooble_id} AS VARCHAR) ELSE {hex16} END AS job_key,
           CASE WHEN {src} = 'jooble' THEN {jooble_id} END AS jooble_id
    FROM documents
    """
