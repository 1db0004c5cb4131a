"""Market metrics over the star schema (what the dashboard shows).

Medians are exact: values are first counted per (group, value), a fully distributed
aggregate, and the percentile then runs on those frequencies, so a group's final
task holds its distinct values, never its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import display_label
from hirelake.operators.salary import YEARLY_FLOOR, drop_outliers, salary_midpoint

# Dashboard thresholds.
MIN_POSTINGS_PER_SKILL = 5
OUTLIER_HIGH = 300000

SKETCH_K = 800  # size of the quantile sketches


def cross_filter(fact: DataFrame, role: str | None = None, **equals) -> DataFrame:
    """Restrict any metric to a search role (and/or other column values)."""
    out = fact if role is None else fact.filter(F.col("search_role") == role)
    for c, v in equals.items():
        out = out.filter(F.col(c) == v)
    return out


def exact_median(df: DataFrame, keys: list[str], value: Column | str,
                 name: str = "median_value", count_name: str = "n_values") -> DataFrame:
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    freq = (df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull())
            .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")))
    return freq.groupBy(*keys).agg(F.percentile(F.col("_v"), F.lit(0.5), F.col("_n")).alias(name),
                                   F.sum("_n").alias(count_name))


def sketch_median(df: DataFrame, keys: list[str], value: Column | str, name: str = "median_value",
                  count_name: str = "n_values", k: int = SKETCH_K) -> DataFrame:
    """Median per group from a mergeable quantile sketch of fixed size, for values too many and
    too varied to count: the rank of the answer is within ``rank_error(k)`` of the middle with
    99 % probability. One shuffle of one sketch per group and task."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    sketched = (df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull()).groupBy(*keys)
                .agg(F.kll_sketch_agg_double("_v", k).alias("_s")))
    return sketched.select(*keys, F.kll_sketch_get_quantile_double("_s", F.lit(0.5)).alias(name),
                           F.kll_sketch_get_n_double("_s").alias(count_name))


def rank_error(k: int = SKETCH_K) -> float:
    """Normalized rank error of a KLL sketch of size ``k`` (99 % confidence, published fit)."""
    return 2.296 / k ** 0.9021


def skill_demand(bridge: DataFrame, skills: DataFrame, top_n: int = 10,
                 fact: DataFrame | None = None, role: str | None = None) -> DataFrame:
    """Postings per skill, most demanded first (ties by name), top ``top_n``."""
    b = bridge
    if role is not None:
        jobs = cross_filter(fact, role).select("job_id")
        b = b.join(jobs, "job_id", "left_semi")
    counts = b.groupBy("skill_id").agg(F.countDistinct("job_id").alias("n_postings"))
    out = counts.join(skills, "skill_id").select(
        "skill_name", "skill_category", display_label(F.col("skill_name")).alias("skill_label"),
        "n_postings")
    return out.orderBy(F.col("n_postings").desc(), F.col("skill_name").asc()).limit(top_n)


def median_salary_by_role(fact: DataFrame, exact: bool = True) -> DataFrame:
    """Exact, or from a sketch (:func:`sketch_median`)."""
    median = exact_median if exact else sketch_median
    return median(fact, ["search_role"], "salary_midpoint_yearly", "median_salary", "n_postings")


def remote_share(fact: DataFrame, by: list[str] | None = None) -> DataFrame:
    by = by or []
    g = fact.groupBy(*by) if by else fact.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n_postings"),
                 F.sum(F.when(F.col("is_remote") == "yes", 1).otherwise(0)).alias("n_remote")) \
        .withColumn("remote_share", F.col("n_remote") / F.col("n_postings"))


def highest_paying_skills(fact: DataFrame, bridge: DataFrame, skills: DataFrame,
                          min_n: int = MIN_POSTINGS_PER_SKILL) -> DataFrame:
    """Median midpoint salary per skill; skills with fewer than ``min_n`` salaried
    postings are dropped (HAVING)."""
    paid = fact.filter(F.col("salary_midpoint_yearly").isNotNull()) \
        .select("job_id", "salary_midpoint_yearly")
    per_skill = paid.join(bridge, "job_id")
    med = exact_median(per_skill, ["skill_id"], "salary_midpoint_yearly",
                       "median_salary", "n_postings")
    return (med.filter(F.col("n_postings") >= min_n)
            .join(skills, "skill_id")
            .select("skill_name", "skill_category", "n_postings", "median_salary"))


def without_outliers(fact: DataFrame, lo: int = YEARLY_FLOOR, hi: int = OUTLIER_HIGH) -> DataFrame:
    """Both salary tails removed (set to NULL) and the midpoint recomputed."""
    lo_c = drop_outliers(F.col("salary_min_yearly"), lo, hi)
    hi_c = drop_outliers(F.col("salary_max_yearly"), lo, hi)
    return fact.select("job_id", "platform_name", lo_c.alias("salary_min_yearly"),
                       hi_c.alias("salary_max_yearly"),
                       salary_midpoint(lo_c, hi_c).alias("salary_midpoint_yearly"))


def exclude_tier3(silver: DataFrame) -> DataFrame:
    """Keep postings whose description tier is not a Tier 3 label."""
    return silver.filter(~F.col("description_quality_tier").startswith("Tier 3"))


__all__ = ["cross_filter", "exact_median", "sketch_median", "rank_error", "skill_demand", "median_salary_by_role",
           "remote_share", "highest_paying_skills", "without_outliers", "exclude_tier3"]
