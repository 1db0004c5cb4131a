"""Silver layer: bronze payloads -> one wide cleaned row per posting, and the
posting-to-skill table.

Plan shape: the latest-row-per-key step runs first, on bronze's key columns alone; payloads
are never shuffled, so the regex-heavy per-row work runs in the tasks that read bronze, as
many as its files give. Keeping the newest row first and classifying after gives the same
rows as classifying first, because every later column is a function of its own row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.json_paths import (epoch_timestamp, iso_timestamp, json_bool,
                                           json_decimal, json_first, json_last, json_text,
                                           per_source)
from hirelake.functions.regex import fold_hazard
from hirelake.functions.text import clean_description, concat_nulls_empty, salary_text
from hirelake.operators import classify as C
from hirelake.operators import salary as S
from hirelake.operators.dedup import latest_per_key
from hirelake.operators.skills import skill_match

SILVER_COLUMNS = (
    "job_id", "source", "keyword", "extracted_at_utc", "job_title", "company_name",
    "job_description", "job_country", "job_city", "redirect_url", "job_posted_at_utc",
    "salary_is_range", "salary_min_yearly", "salary_max_yearly", "normalized_currency",
    "employment_type", "is_remote", "position_level", "language_requirement",
    "description_quality_tier",
)


def extract_fields(bronze: DataFrame) -> DataFrame:
    """Typed fields cut from the VARIANT payload, per source path."""
    raw, src = F.col("raw_data"), F.col("source")
    fields = bronze.select(
        "job_id", "source", "keyword", "extracted_at",
        json_text(raw, "$.title").alias("job_title"),
        per_source(src, {"adzuna": json_text(raw, "$.company.display_name"),
                         "jooble": json_text(raw, "$.company")},
                   json_text(raw, "$.company_name")).alias("company_name"),
        json_text(raw, "$.description").alias("_description"),
        json_text(raw, "$.snippet").alias("_snippet"),
        json_text(raw, "$.salary").alias("_salary"),
        json_first(raw, "$.location.area").alias("_area_first"),
        json_last(raw, "$.location.area").alias("_area_last"),
        json_text(raw, "$.location").alias("_location"),
        per_source(src, {"adzuna": json_text(raw, "$.redirect_url"),
                         "jooble": json_text(raw, "$.link")},
                   json_text(raw, "$.url")).alias("redirect_url"),
        per_source(src, {"adzuna": iso_timestamp(json_text(raw, "$.created")),
                         "jooble": iso_timestamp(json_text(raw, "$.updated")),
                         "arbeitnow": epoch_timestamp(json_text(raw, "$.created_at"))},
                   iso_timestamp(json_text(raw, "$.created_at"))).alias("job_posted_at"),
        json_text(raw, "$.contract_time").alias("_contract_time"),
        json_text(raw, "$.type").alias("_jtype"),
        json_bool(raw, "$.remote").alias("_remote"),
        json_text(raw, "$.job_types").alias("_job_types"),
        json_decimal(raw, "$.salary_min").alias("_salary_min"),
        json_decimal(raw, "$.salary_max").alias("_salary_max"),
    )
    # the texts, cut from the payload once
    return fields.withColumn("_desc_raw", per_source(src, {"jooble": F.col("_snippet")}, F.col("_description")))


def enrich(fields: DataFrame) -> DataFrame:
    """Cleaning, classifiers and salary parsing on the extracted fields."""
    src = F.col("source")
    stage1 = fields.withColumns({
        "job_description": clean_description(F.col("_desc_raw")),
        "salary_text": salary_text(F.col("_description"), F.col("_snippet"), F.col("_salary")),
        "_snip_lc": F.lower(F.col("_snippet")),
    })
    # cleaning and lower() bring no such character in, so one flag of the raw texts serves all three
    raw_hazards = [F.coalesce(fold_hazard(F.col(c)), F.lit(False)) for c in ("_description", "_snippet", "_salary")]
    stage2 = stage1.withColumns({
        "_desc_lc": F.lower(F.col("job_description")),
        "_hazard": reduce(lambda a, b: a | b, raw_hazards),
    })
    stage2 = S.with_salary_matches(stage2, "salary_text")
    # rule inputs by name: each rule test is then built as one SQL expression
    desc, dlc, dhz = "job_description", "_desc_lc", "_hazard"
    sal = S.salary_fields(F.col("_sal_pre"), F.col("_sal_suf"))
    stage3 = stage2.withColumns({
        "job_country": C.job_country(src, F.col("_area_first"), "_snippet",
                                     F.col("_location"), "_snip_lc", dhz),
        "job_city": C.job_city(src, F.col("_area_first"), F.col("_area_last"),
                               F.col("_snippet"), F.col("_location"), F.col("_snip_lc")),
        "salary_period": C.salary_period("salary_text", dhz),
        "employment_type": C.employment_type(src, F.col("_contract_time"), F.col("_jtype"),
                                             desc, dlc, dhz),
        "is_remote": C.is_remote(src, F.col("_remote"), desc, dlc, dhz),
        "position_level": C.position_level(src, F.col("job_title"), F.col("_job_types")),
        "language_requirement": C.language_requirement(desc, dlc, dhz),
        "raw_currency": sal["raw_currency"],
        "base_salary_min": F.coalesce(F.col("_salary_min"), sal["regex_min"]).cast(S.AMOUNT),
        "base_salary_max": F.coalesce(F.col("_salary_max"), sal["regex_max"]).cast(S.AMOUNT),
    })
    stage4 = stage3.withColumns({
        "salary_is_range": F.col("base_salary_min").isNotNull() & F.col("base_salary_max").isNotNull(),
        "normalized_currency": C.normalized_currency(F.col("raw_currency")),
        "salary_min_yearly": S.salary_floor(S.to_yearly(F.col("base_salary_min"), F.col("salary_period"))),
        "salary_max_yearly": S.salary_floor(S.to_yearly(F.col("base_salary_max"), F.col("salary_period"))),
        "description_quality_tier": C.description_quality_tier(F.col(desc), F.col("job_country"), F.col(dlc)),
    })
    return stage4


def payload_casts(raw: Column, source: Column) -> dict[str, tuple[Column, Column]]:
    """Payload values that silver casts, per column: the text and its typed value. Bad values
    become NULL there (one bad row must not stop a load), so they are counted."""
    posted = per_source(source, {"adzuna": json_text(raw, "$.created"), "jooble": json_text(raw, "$.updated")},
                        json_text(raw, "$.created_at"))
    stamp = per_source(source, {"arbeitnow": epoch_timestamp(posted)}, iso_timestamp(posted))
    return {"salary_min": (json_text(raw, "$.salary_min"), json_decimal(raw, "$.salary_min")),
            "salary_max": (json_text(raw, "$.salary_max"), json_decimal(raw, "$.salary_max")),
            "remote": (json_text(raw, "$.remote"), json_bool(raw, "$.remote")),
            "job_posted_at": (posted, stamp)}


def observe_casts(bronze: DataFrame, metrics: Observation) -> DataFrame:
    """The same rows; ``metrics`` gets, with the job that writes them, how many payload values
    of each column there are and how many do not cast."""
    counts = []
    for name, (text, value) in payload_casts(F.col("raw_data"), F.col("source")).items():
        counts += [F.count(text).alias(f"{name}/values"), F.count_if(text.isNotNull() & value.isNull()).alias(f"{name}/rejected")]
    return bronze.observe(metrics, *counts)


def cast_rejects(spark: SparkSession, metrics: Observation) -> DataFrame:
    """(column_name, n_values, n_rejected) from the metrics of a finished job."""
    found = metrics.get
    names = dict.fromkeys(key.split("/")[0] for key in found)
    return spark.createDataFrame([(n, found[f"{n}/values"], found[f"{n}/rejected"]) for n in names],
                                 "column_name string, n_values long, n_rejected long")


def silver_jobs(bronze: DataFrame, casts: Observation | None = None) -> DataFrame:
    """The 20-column cleaned posting table (one row per job_id, source). ``casts`` observes
    rejected payload values (:func:`observe_casts`) while the table is written."""
    latest = latest_per_key(bronze)
    if casts is not None:
        latest = observe_casts(latest, casts)
    out = enrich(extract_fields(latest))
    return out.select(
        "job_id", "source", "keyword",
        F.col("extracted_at").alias("extracted_at_utc"),
        "job_title", "company_name", "job_description", "job_country", "job_city",
        "redirect_url", F.col("job_posted_at").alias("job_posted_at_utc"),
        "salary_is_range", "salary_min_yearly", "salary_max_yearly", "normalized_currency",
        "employment_type", "is_remote", "position_level", "language_requirement",
        "description_quality_tier")


def searchable_postings(silver: DataFrame) -> DataFrame:
    """Postings with a non-empty description: ``title || ' ' || description``."""
    return (silver.filter(F.col("job_description").isNotNull() & (F.col("job_description") != ""))
            .select("job_id", concat_nulls_empty("job_title", F.lit(" "), "job_description")
                    .alias("searchable_text")))


def silver_job_skills(silver: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(job_id, skill_category, skill_name), distinct. Grouped by job_id alone: equal
    ids from two boards merge, as in the original model."""
    return skill_match(searchable_postings(silver), taxonomy)
