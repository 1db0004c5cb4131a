"""Salary extraction: free text to typed yearly amounts.

The text is ``LOWER(TRIM(CONCAT(description, ' ', snippet, ' ', salary)))`` of the raw
payload. Two patterns look for an amount with the currency before it (prefix) or
after it (suffix). Each pattern scans the full text once for its first match; the
capture groups are then read from that short match only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.regex import PG_SPACE_CHARS, first_match, groups_of_match, sql_text
from hirelake.functions.text import decimal_text

# ----------------------------------------------------------------------------------
# Salary patterns (PostgreSQL regex on lower-cased text), yearly
# conversion factors (14 monthly salaries, 1800 working hours) and the low floor.
# ----------------------------------------------------------------------------------
SALARY_PREFIX = r"(eur|€|\$|usd|£)\s*([0-9]+(?:[.,][0-9]+)?)(k)?\s*(?:[-–]\s*([0-9]+(?:[.,][0-9]+)?)(k)?)?"
SALARY_SUFFIX = r"([0-9]+(?:[.,][0-9]+)?)(k)?\s*(?:[-–]\s*([0-9]+(?:[.,][0-9]+)?)(k)?)?\s*(eur|€|brutto|\$|usd|£)"
DEFAULT_RAW_CURRENCY = "eur"
MONTHLY_FACTOR = 14
HOURLY_FACTOR = 1800
THOUSAND = 1000
YEARLY_FLOOR = 10000
# ----------------------------------------------------------------------------------

AMOUNT = "decimal(38,4)"

# The suffix pattern as searched: same matches, but a run of digits is entered at its start
# only, and blanks before the currency are tried once, so long runs cost linear time.
# The first character is tested before all else, as most places have another one.
_SUFFIX_SEARCH = "(?=[0-9])(?<![0-9])" + SALARY_SUFFIX.replace(r"(k)?\s*(?:[-–]", r"(k)?(?:\s*[-–]", 1)
_PREFIX_SEARCH = r"(?=[eu€$£])" + SALARY_PREFIX


def _amount(number: Column, k_flag: Column) -> Column:
    """``65,5`` + ``k`` -> 65500; ``65.000`` -> 65000; NULL when there is no number."""
    with_k = F.try_multiply(decimal_text(number, True).try_cast(AMOUNT),
                            F.lit(THOUSAND).cast("decimal(10,0)"))
    plain = decimal_text(number, False).try_cast(AMOUNT)
    return F.when(number.isNotNull(),
                  F.when(F.coalesce(k_flag == "k", F.lit(False)), with_k).otherwise(plain))


# Currency tokens of both patterns; the characters an amount before a currency can consist of, none
# of which a token begins with; and how much of the text before the first token is looked at first.
_TOKENS = ("€", "$", "£", "usd", "brutto", "eur")
_NO_AMOUNT = f"[^0-9.,k{PG_SPACE_CHARS}–-]"
_AMOUNT_CHARS = 200
_LAST_WORDS = 8  # of the text, where the salary field stands


def with_salary_matches(df: DataFrame, text: str = "salary_text") -> DataFrame:
    """Add the two first matches (``_sal_pre``, ``_sal_suf``; '' when absent).

    No match begins before the first currency token but for the amount that stands right before
    it, so both patterns search from there on only: from the last characters before the token if
    one of them cannot be part of an amount, else from the start. A text is searched for a token much
    faster than for its place, and most have their first one in the salary field at their end: the
    last words are looked at on their own, as no token holds a blank."""
    tokens = ", ".join(map(sql_text, _TOKENS))

    def to_token(t: str) -> Column:
        return F.expr(f"aggregate(array({tokens}), `{t}`, (t, c) -> IF(contains(t, c), substring_index(t, c, 1), t))")
    df = df.withColumn("_sal_last", F.substring_index(text, " ", -_LAST_WORDS))
    df = df.withColumn("_sal_body", F.expr(f"cast(left(cast(`{text}` AS binary), octet_length(`{text}`) - octet_length(_sal_last)) AS string)"))
    df = df.withColumns({"_sal_in_body": to_token("_sal_body"), "_sal_in_last": to_token("_sal_last")})
    in_body = F.octet_length("_sal_in_body") < F.octet_length("_sal_body")
    before = F.when(in_body, F.col("_sal_in_body")).otherwise(F.concat("_sal_body", "_sal_in_last"))
    none = F.octet_length("_sal_before") == F.octet_length(text)  # most texts hold no token
    # what stands before is a prefix: cut off by bytes, as characters would have to be counted
    rest = F.expr(f"cast(substring(cast(`{text}` AS binary), octet_length(_sal_before) + 1) AS string)")
    # as many bytes as the characters have at most, and a few more
    last_bytes = 4 * _AMOUNT_CHARS + 4
    near = F.expr(f"cast(substring(cast(_sal_before AS binary), -{last_bytes}, {last_bytes}) AS string)")
    cut = df.withColumn("_sal_before", before).withColumns({
        "_sal_rest": F.when(none, F.lit("")).otherwise(rest),
        "_sal_near": F.when(none, F.lit("")).otherwise(F.right(near, F.lit(_AMOUNT_CHARS))),
    })
    near = F.when(F.col("_sal_near").rlike(_NO_AMOUNT), F.col("_sal_near")).otherwise(F.col("_sal_before"))
    none = F.col("_sal_rest") == ""
    return cut.drop("_sal_last", "_sal_body", "_sal_in_body", "_sal_in_last").withColumns({
        "_sal_pre": F.when(none, F.lit("")).otherwise(first_match(F.col("_sal_rest"), _PREFIX_SEARCH)),
        "_sal_suf": F.when(none, F.lit("")).otherwise(first_match(F.concat(near, F.col("_sal_rest")), _SUFFIX_SEARCH)),
    })


def salary_fields(pre_match: Column, suf_match: Column) -> dict[str, Column]:
    """raw_currency, regex_min, regex_max from the prefix and suffix matches."""
    pre = {i: groups_of_match(pre_match, SALARY_PREFIX, i) for i in range(1, 6)}
    suf = {i: groups_of_match(suf_match, SALARY_SUFFIX, i) for i in range(1, 6)}
    has_pre = pre_match != ""
    has_suf = suf_match != ""
    raw_currency = (F.when(has_pre, pre[1]).when(has_suf, suf[5])
                    .otherwise(F.lit(DEFAULT_RAW_CURRENCY)))
    regex_min = (F.when(has_pre & pre[2].isNotNull(), _amount(pre[2], pre[3]))
                 .when(has_suf & suf[1].isNotNull(), _amount(suf[1], suf[2])))
    regex_max = (F.when(has_pre & pre[4].isNotNull(), _amount(pre[4], pre[5]))
                 .when(has_suf & suf[3].isNotNull(), _amount(suf[3], suf[4])))
    return {"raw_currency": raw_currency, "regex_min": regex_min, "regex_max": regex_max}


def to_yearly(amount: Column, period: Column) -> Column:
    """monthly x14, hourly x1800, else unchanged (overflow gives NULL)."""
    return (F.when(period == "monthly",
                   F.try_multiply(amount, F.lit(MONTHLY_FACTOR).cast("decimal(10,0)")))
            .when(period == "hourly",
                  F.try_multiply(amount, F.lit(HOURLY_FACTOR).cast("decimal(10,0)")))
            .otherwise(amount)).cast(AMOUNT)


def salary_floor(amount: Column, floor: int = YEARLY_FLOOR) -> Column:
    """Amounts under the floor are parsing noise: NULL."""
    return F.when(amount < F.lit(floor), F.lit(None)).otherwise(amount).cast(AMOUNT)


def salary_midpoint(lo: Column, hi: Column) -> Column:
    return F.when(lo.isNotNull() & hi.isNotNull(),
                  F.try_divide(F.try_add(lo, hi), F.lit(2).cast("decimal(10,0)"))).cast(AMOUNT)


def drop_outliers(amount: Column, lo: int = YEARLY_FLOOR, hi: int = 300000) -> Column:
    """Both tails are parsing errors: keep amounts in [lo, hi], else NULL."""
    return F.when(amount.between(F.lit(lo), F.lit(hi)), amount).cast(AMOUNT)
