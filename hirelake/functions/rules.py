"""Ordered rule tables: the first matching rule wins, NULL input matches nothing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.regex import fold_hazard, regex_any_ci


def classify_rules(rules: Iterable[tuple[Column, str]], default: Column | str | None) -> Column:
    """CASE WHEN cond1 THEN label1 ... ELSE default END."""
    out = None
    for cond, label in rules:
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if default is None:
        return out
    dflt = F.lit(default) if isinstance(default, str) else default
    return dflt if out is None else out.otherwise(dflt)


def regex_rules(text: Column | str, table: Iterable[tuple[str, str]], default: Column | str | None,
                lowered: Column | str | None = None, hazard: Column | str | None = None) -> Column:
    """``CASE WHEN text ~* p1 THEN l1 ...``: a table of (PostgreSQL pattern, label).
    ``text``, ``lowered`` and ``hazard`` may be column names (cheaper to build)."""
    if not isinstance(text, str):
        lowered = lowered if lowered is not None else F.lower(text)
        hazard = hazard if hazard is not None else fold_hazard(text)
    elif lowered is None or hazard is None:
        lowered = lowered if lowered is not None else F.lower(F.col(text))
        hazard = hazard if hazard is not None else fold_hazard(F.col(text))
    return classify_rules(((regex_any_ci(text, p, lowered, hazard), label)
                           for p, label in table), default)
