"""Gold layer: star schema over silver (fact, company/skill/date dimensions, bridge)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.keys import date_key, surrogate_key
from hirelake.operators.classify import TIER_MISSING, is_weekend
from hirelake.operators.salary import salary_midpoint

# Calendar range of the date dimension.
DATE_START = "2024-01-01"
DATE_END = "2026-12-31"
MONTH_NAME_WIDTH = 9  # month names blank-padded to the longest name


def dim_companies(silver: DataFrame) -> DataFrame:
    return (silver.filter(F.col("company_name").isNotNull()).select("company_name").distinct()
            .select(surrogate_key("company_name").alias("company_id"), "company_name"))


def dim_skills(job_skills: DataFrame) -> DataFrame:
    return (job_skills.select("skill_name", "skill_category").distinct()
            .select(surrogate_key("skill_name").alias("skill_id"), "skill_category", "skill_name"))


def bridge_job_skills(job_skills: DataFrame) -> DataFrame:
    return job_skills.select("job_id", surrogate_key("skill_name").alias("skill_id"))


def date_spine(spark: SparkSession, start: str = DATE_START, end: str = DATE_END) -> DataFrame:
    """One row per day, both ends included (size fixed by the range, not the data)."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                                                      F.expr("INTERVAL 1 DAY"))).alias("date_day"))


def dim_date(spark: SparkSession, start: str = DATE_START, end: str = DATE_END) -> DataFrame:
    d = F.col("date_day")
    iso_dow = F.expr("extract(DAYOFWEEK_ISO FROM date_day)").cast("int")
    return date_spine(spark, start, end).select(
        date_key(d).alias("date_id"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.rpad(F.date_format(d, "MMMM"), MONTH_NAME_WIDTH, " ").alias("month_name"),
        F.quarter(d).alias("quarter"),
        iso_dow.alias("day_of_week"),
        is_weekend(iso_dow).alias("is_weekend"),
    )


def fct_job_postings(silver: DataFrame) -> DataFrame:
    """Postings with keys; rows without a description are not facts (other Tier 3
    rows stay)."""
    lo, hi = F.col("salary_min_yearly"), F.col("salary_max_yearly")
    return silver.filter(F.col("description_quality_tier") != TIER_MISSING).select(
        "job_id",
        surrogate_key("company_name").alias("company_id"),
        date_key("job_posted_at_utc").alias("date_id"),
        F.col("keyword").alias("search_role"),
        "job_title",
        "job_posted_at_utc",
        F.col("job_country").alias("country"),
        F.col("job_city").alias("city"),
        F.col("source").alias("platform_name"),
        "position_level", "employment_type", "is_remote",
        "salary_min_yearly", "salary_max_yearly",
        salary_midpoint(lo, hi).alias("salary_midpoint_yearly"),
    )


def star_query(fact: DataFrame, companies: DataFrame, dates: DataFrame, bridge: DataFrame,
               skills: DataFrame) -> DataFrame:
    """Fact joined to its dimensions: left on company and date (a posting may have no
    company row or a date outside the calendar), inner through the bridge to skills.
    Postings without a company share one marker key that no company has: they pass by
    the company join instead of meeting in one task. The date dimension is bounded by its
    calendar range and is broadcast; the data-sized dimensions are left to the planner,
    which broadcasts them only when their measured size is under the threshold."""
    nameless = F.col("company_id") == surrogate_key(F.lit(None).cast("string"))
    named = fact.filter(~nameless).join(companies, "company_id", "left")
    rest = fact.filter(nameless).withColumn("company_name", F.lit(None).cast("string"))
    return (named.unionByName(rest)
            .join(F.broadcast(dates), "date_id", "left")
            .join(bridge, "job_id")
            .join(skills, "skill_id"))
