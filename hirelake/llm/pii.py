"""Personal data: regular expressions propose, validators confirm, nearby words adjust a score.

All work is row-wise SQL over the whole text: no shuffle, no Python. Patterns use possessive
quantifiers and look-behinds so that each runs in time linear in the text (a digit run is
entered once, at its start) and match exactly what the plain patterns match.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import table


@dataclass(frozen=True)
class Kind:
    """One kind of personal data. ``confirm`` is SQL over the matched text ``m``; ``start``
    is a character every match contains (or None for a digit); ``context`` are words that
    make a match likelier; spans of kinds that are not ``base`` stay from ``MIN_SCORE`` on."""

    name: str
    pattern: str
    confirm: str
    prior: float
    context: str
    base: bool = True
    start: str | None = None


DIGITS = "regexp_replace(m, '[^0-9]', '')"
LUHN = (f"aggregate(sequence(1, length({DIGITS})), 0, (a, i) -> a + "
        f"CASE WHEN i % 2 = 1 THEN int(substr(reverse({DIGITS}), i, 1)) "
        f"ELSE int(substr('0246813579', int(substr(reverse({DIGITS}), i, 1)) + 1, 1)) END) % 10 = 0")
IBAN = "regexp_replace(m, ' ', '')"
MOD97 = (f"length({IBAN}) BETWEEN 15 AND 34 AND aggregate(sequence(1, length({IBAN})), 0, (a, i) -> "
         f"(CASE WHEN substr(concat(substr({IBAN}, 5), substr({IBAN}, 1, 4)), i, 1) BETWEEN '0' AND '9' "
         f"THEN a * 10 + ascii(substr(concat(substr({IBAN}, 5), substr({IBAN}, 1, 4)), i, 1)) - 48 "
         f"ELSE a * 100 + ascii(substr(concat(substr({IBAN}, 5), substr({IBAN}, 1, 4)), i, 1)) - 55 END) % 97) = 1")

# In the order that breaks ties between spans with one start.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "true", 0.8, "mail|contact|write|kontakt|correo|courriel", start="@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         "forall(split(m, '[.]'), p -> length(ltrim('0', p)) <= 3 AND "
         "int(concat('0', right(ltrim('0', p), 3))) <= 255)",
         0.6, r"\bip\b|address|server|host|router|adresse|servidor", start="."),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])",
         LUHN, 0.7, "card|visa|master|amex|credit|debit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({DIGITS}) BETWEEN 9 AND 15",
         0.6, "phone|tel|call|mobile|fax|whatsapp|anruf|appel|llama", start="+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         MOD97, 0.8, "iban|account|bank|konto|compte|cuenta", base=False),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         "true", 0.4, r"\bssn\b|social security|tax id", base=False),
)
AGAINST = "version|order|invoice|serial|isbn|model|build|release"
CONTEXT_BEFORE, CONTEXT_AFTER = 48, 24
CONTEXT_BONUS, CONTEXT_MALUS = 0.2, 0.3
MIN_SCORE = 0.5
# No match of any kind is shorter (a@b.c); matches whose places are summed up at once.
SHORTEST = 5
BLOCK = 64


def _quoted(text: str) -> str:
    return "r'" + text + "'"


def _found(kind: Kind) -> Column:
    """Matches of a kind in ``text``, skipping the regex where it cannot match."""
    possible = f"contains(text, '{kind.start}')" if kind.start else "true"
    digit = "true" if kind.name == "email" else "has_digit"
    return F.expr(f"CASE WHEN {digit} AND {possible} THEN regexp_extract_all(text, {_quoted(kind.pattern)}, 0) "
                  f"ELSE cast(array() AS array<string>) END")


def _gaps(kind: Kind) -> Column:
    """The pieces of ``text`` before, between and after the matches of a kind."""
    return F.expr(f"CASE WHEN size(m_{kind.name}) > 0 THEN split(text, {_quoted(kind.pattern)}, -1) "
                  f"ELSE cast(array() AS array<string>) END")


def _spans(kind: Kind, order: int) -> Column:
    """Confirmed spans of a kind from its matches ``m_<kind>`` and the pieces between them
    ``g_<kind>``, whose lengths give the places, in code points. Places are summed up inside
    blocks of matches and over the blocks, so a text with very many matches costs little more
    than in proportion to them."""
    m, g = f"m_{kind.name}", f"g_{kind.name}"
    block = (f"aggregate(sequence(b * {BLOCK}, least(size({m}), (b + 1) * {BLOCK}) - 1), "
             f"named_struct('at', 0, 'out', cast(array() AS array<int>)), (a, i) -> named_struct("
             f"'at', a.at + length(get({g}, i)) + length(get({m}, i)), "
             f"'out', concat(a.out, array(a.at + length(get({g}, i))))))")
    blocks = f"transform(sequence(0, (size({m}) - 1) div {BLOCK}), b -> {block})"
    summed = (f"aggregate(p, named_struct('at', 0, 'out', cast(array() AS array<int>)), (a, x) -> named_struct("
              f"'at', a.at + x.at, 'out', concat(a.out, array(a.at))), a -> a.out)")
    starts = (f"flatten(transform(array({blocks}), p -> flatten(zip_with(p, {summed}, "
              f"(x, at) -> transform(x.out, s -> s + at)))))")
    kept = (f"filter(transform({starts}, (s, i) -> named_struct('s', s, 'e', s + length(get({m}, i)), 'i', i, 'm', get({m}, i))), "
            f"x -> exists(array(x.m), m -> {kind.confirm}))")
    scored = f"transform({kept}, x -> named_struct(" \
             f"'s', x.s, 'o', {order}, 'e', x.e, 'kind', '{kind.name}', 'base', {str(kind.base).lower()}, " \
             f"'score', {_score(kind, m, g)}))"
    return F.expr(f"CASE WHEN size({m}) = 0 THEN cast(array() AS array<struct<s:int,o:int,e:int,"
                  f"kind:string,base:boolean,score:double>>) ELSE {scored} END")


def _score(kind: Kind, m: str, g: str) -> str:
    """The context of match ``x.i`` is put together from the pieces around it: cutting it out of
    the whole text would walk the text once per match."""
    before = (f"right(array_join(transform(sequence(greatest(0, x.i - {CONTEXT_BEFORE // SHORTEST + 1}), x.i), j -> "
              f"concat(right(get({g}, j), {CONTEXT_BEFORE}), CASE WHEN j < x.i THEN get({m}, j) ELSE '' END)), ''), {CONTEXT_BEFORE})")
    after = (f"left(array_join(transform(sequence(x.i + 1, least(size({m}), x.i + 1 + {CONTEXT_AFTER // SHORTEST + 1})), j -> "
             f"concat(left(get({g}, j), {CONTEXT_AFTER}), coalesce(left(get({m}, j), {CONTEXT_AFTER}), ''))), ''), {CONTEXT_AFTER})")
    near = f"lower(concat({before}, ' ', {after}))"
    return (f"cast(round(least(1.0D, greatest(0.0D, {kind.prior}D + CASE WHEN {near} RLIKE {_quoted(kind.context)} "
            f"THEN {CONTEXT_BONUS}D ELSE 0.0D END - CASE WHEN {near} RLIKE {_quoted(AGAINST)} "
            f"THEN {CONTEXT_MALUS}D ELSE 0.0D END)), 3) AS double)")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             min_score: float = MIN_SCORE) -> DataFrame:
    """``doc_id, text, spans``: every confirmed span as (s, o, e, kind, base, score), by start.

    Offsets are code points, end exclusive. Base kinds stay whatever their score; the kinds
    this method adds (iban, ssn) need ``min_score``. A null text counts as empty and has no
    spans; null and repeated ids are separate rows; an empty table gives no rows; other
    columns of the input are not looked at.
    """
    out = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = out.withColumn("has_digit", F.col("text").rlike("[0-9]"))
    out = out.withColumns({f"m_{k.name}": _found(k) for k in KINDS})
    out = out.withColumns({f"g_{k.name}": _gaps(k) for k in KINDS})
    out = out.withColumns({f"s_{k.name}": _spans(k, i) for i, k in enumerate(KINDS)})
    spans = F.array_sort(F.concat(*[F.col(f"s_{k.name}") for k in KINDS]))
    spans = F.filter(spans, lambda x: x["base"] | (x["score"] >= min_score))
    return out.select("doc_id", "text", spans.alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` with every span replaced by its kind in brackets; of overlapping spans
    the first stands."""
    found = find_pii(docs, id_col, text_col)
    cut = F.expr(
        "aggregate(spans, named_struct('at', 0, 'out', ''), (a, x) -> CASE WHEN x.s < a.at THEN a ELSE "
        "named_struct('at', x.e, 'out', concat(a.out, substr(text, a.at + 1, x.s - a.at), '[', x.kind, ']')) END, "
        "a -> concat(a.out, substr(text, a.at + 1)))")
    return found.select("doc_id", cut.alias("text"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    written = "concat_ws(':', x.kind, x.s, x.e)"
    counts = [F.expr(f"cast(size(filter(spans, x -> x.kind = '{k.name}')) AS bigint)").alias(f"n_{k.name}")
              for k in KINDS]
    return found.select(
        "doc_id", *counts,
        F.sha2(F.expr(f"array_join(transform(filter(spans, x -> x.base), x -> {written}), ',')"), 256)
        .alias("base_sha256"),
        F.expr(f"array_join(transform(spans, x -> {written}), ',')").alias("spans"),
        F.expr("array_join(transform(spans, x -> cast(x.score AS string)), ',')").alias("scores"))
