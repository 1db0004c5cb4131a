"""Key checks of the gold tables (unique, not null), as failing-row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHECK_COLUMNS = ["table_name", "column_name", "check_name", "failures"]


def table_checks(name: str, df: DataFrame, unique: list[str], not_null: list[str]) -> DataFrame:
    """All checks of one table in one pass per unique column: a group-by on the key
    gives duplicate values and NULL rows; other not-null counts ride along."""
    rows = []
    done_nn = set()
    for key in unique:
        others = [c for c in not_null if c != key and c not in done_nn]
        g = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                *[F.count_if(F.col(c).isNull()).alias(f"_nn_{c}") for c in others])
        aggs = [F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("_dup")]
        aggs.append(F.sum(F.when(F.col(key).isNull(), F.col("_n")).otherwise(0)).alias("_null"))
        aggs += [F.sum(f"_nn_{c}").alias(f"_nn_{c}") for c in others]
        s = g.agg(*aggs)
        parts = [F.struct(F.lit(key).alias("column_name"), F.lit("unique").alias("check_name"),
                          F.col("_dup").cast("long").alias("failures"))]
        if key in not_null:
            parts.append(F.struct(F.lit(key).alias("column_name"), F.lit("not_null").alias("check_name"),
                                  F.coalesce(F.col("_null"), F.lit(0)).cast("long").alias("failures")))
            done_nn.add(key)
        for c in others:
            parts.append(F.struct(F.lit(c).alias("column_name"), F.lit("not_null").alias("check_name"),
                                  F.coalesce(F.col(f"_nn_{c}"), F.lit(0)).cast("long").alias("failures")))
            done_nn.add(c)
        rows.append(s.select(F.explode(F.array(*parts)).alias("r"))
                    .select(F.lit(name).alias("table_name"), "r.*"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.select(*CHECK_COLUMNS)


def run_checks(fact: DataFrame, companies: DataFrame, skills: DataFrame) -> DataFrame:
    """The seven key checks of the gold schema."""
    return (table_checks("dim_companies", companies, ["company_id"], ["company_id"])
            .unionByName(table_checks("dim_skills", skills, ["skill_id"], ["skill_id"]))
            .unionByName(table_checks("fct_job_postings", fact, ["job_id"], ["job_id", "company_id"])))
