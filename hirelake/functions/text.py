"""Text cleaning and string helpers with PostgreSQL semantics."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.regex import PG_SPACE_CHARS

# The cleaning patterns.
_HTML_TAG = "<[^>]+>"
_TO_SPACE = ("\r", "\n", "\t", "&nbsp;")
_MULTI_SPACE = "[" + PG_SPACE_CHARS + "]{2,}"

# Texts with one of these may hold other spaces than the plain one (once line breaks are gone), and
# no text without one of the marks, the last a byte, does: bytes are searched faster than classes.
_MAYBE_OTHER_SPACE = r"[\x0B\f\x{1680}-\x{3000}]"
_OTHER_SPACE_MARKS = ("\x0B", "\f", "\u1680", "\u3000", b"\xe2")


def _bound(text: Column, step: Callable[[Column], Column]) -> Column:
    """``step`` of the text, which is computed once however often ``step`` or a filter on the
    result names it."""
    return F.get(F.transform(F.array(text), step), F.lit(0))


def strip_html(text: Column) -> Column:
    """Every ``<...>`` tag becomes one space. Only the text up to its last ``>`` is
    searched: behind it no tag can end, and a row of ``<`` would be scanned once each."""
    def stripped(t: Column) -> Column:
        tail = F.substring_index(t, ">", -1)
        head = F.left(t, F.length(t) - F.length(tail))
        return F.when(t.contains("<") & t.contains(">"), F.concat(F.regexp_replace(head, _HTML_TAG, " "), tail)).otherwise(t)
    return _bound(text, stripped)


def flatten_whitespace(text: Column) -> Column:
    """CR/LF/TAB runs to a space, ``&nbsp;`` to a space, 2+ spaces to one; no trim."""
    # runs collapse in the last step; a text is searched faster than it is searched for replacing
    marks = F.array(*[F.lit(c) for c in _TO_SPACE])
    text = F.aggregate(marks, text, lambda t, c: F.when(F.contains(t, c), F.replace(t, c, F.lit(" "))).otherwise(t))

    def collapsed(t: Column) -> Column:
        # the class of all spaces is slow to test at every character: most texts need only the plain one
        marked = [F.contains(t.cast("binary") if isinstance(m, bytes) else t, F.lit(m)) for m in _OTHER_SPACE_MARKS]
        other = reduce(lambda a, b: a | b, marked) & t.rlike(_MAYBE_OTHER_SPACE)
        return F.when(other, F.regexp_replace(t, _MULTI_SPACE, " ")) \
            .when(t.contains("  "), F.regexp_replace(t, "  +", " ")).otherwise(t)
    return _bound(text, collapsed)


def clean_description(text: Column) -> Column:
    return flatten_whitespace(strip_html(text))


def concat_nulls_empty(*cols: Column | str) -> Column:
    """PostgreSQL ``CONCAT``: NULL arguments count as empty strings."""
    return F.concat(*[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
                      for c in cols])


def salary_text(description: Column, snippet: Column, salary: Column) -> Column:
    """``LOWER(TRIM(CONCAT(description, ' ', snippet, ' ', salary)))`` on raw fields."""
    return F.lower(F.trim(concat_nulls_empty(description, F.lit(" "), snippet,
                                             F.lit(" "), salary)))


def before_first_comma(text: Column) -> Column:
    """``TRIM(split_part(text, ',', 1))`` (trims spaces only)."""
    return F.trim(F.split_part(text, F.lit(","), F.lit(1)))


def decimal_text(number: Column, thousands: bool) -> Column:
    """Number text as written: ``65,5`` (with k) or ``65.000`` (without)."""
    if thousands:
        return F.replace(number, F.lit(","), F.lit("."))
    return F.replace(F.replace(number, F.lit("."), F.lit("")), F.lit(","), F.lit(""))


def display_label(name: Column) -> Column:
    """``ci_cd`` -> ``Ci Cd`` for presentation."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))
