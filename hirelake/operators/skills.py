"""Skill matching: postings x taxonomy on ``text ~* pattern`` (a theta join).

The taxonomy is a seed file. An inverted index from words to patterns
(``functions.word_index``) turns the distinct words of a text into patterns that match, where an
alternative is one word, and candidate patterns. Of these only the alternatives of several words or
marks run as regular expressions, inside the row, if the text holds their literals. The result is
exact; everything stays in the JVM and one scan of the postings serves seeds of every size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.functions.regex import ci_pattern, fold_hazard, needles
from hirelake.functions.word_index import WordIndex, one_words, sql_text, words_of


def _literals_sql(pattern: str) -> str:
    """Literals one of which a text must hold to match ``pattern`` if no word of it settles that:
    none if there are no other alternatives, the empty one if they have no literals."""
    _, rest = one_words(pattern)
    literals = (needles(rest) or [""]) if rest is not None else []
    return f"cast(array({', '.join(map(sql_text, literals))}) AS array<string>)"


def _matches_sql(i: str, patterns: list[str]) -> str:
    """``_text ~* patterns[i]``; numbers from ``len(patterns)`` on are settled by a word. The text is
    searched for literals first, but where case folding differs (``_hz``), as these say nothing
    there. A balanced tree of comparisons leads to the one constant pattern."""
    def pick(low: int, high: int) -> str:
        if high - low == 1:
            return f"regexp(_text, {sql_text(ci_pattern(patterns[low]))})"
        mid = (low + high) // 2
        return f"CASE WHEN {i} < {mid} THEN {pick(low, mid)} ELSE {pick(mid, high)} END"
    literals = f"array({', '.join(map(_literals_sql, patterns))})"
    held = f"exists(get({literals}, {i}), x -> contains(_low, x))"
    return f"CASE WHEN {i} >= {len(patterns)} THEN true WHEN _hz OR {held} THEN {pick(0, len(patterns))} ELSE false END"


def skill_match(jobs: DataFrame, taxonomy: DataFrame, id_col: str = "job_id",
                text_col: str = "searchable_text") -> DataFrame:
    """(id, skill_category, skill_name) for every taxonomy pattern the text matches, one row
    per distinct triple. The seed is read to the driver: a file kept by hand, not data."""
    rows = [tuple(r) for r in taxonomy.select("category", "standard_name", "regex_pattern").collect()]
    if not rows:
        return jobs.select(id_col, F.lit("").alias("skill_category"), F.lit("").alias("skill_name")).limit(0)
    patterns = [p for *_, p in rows]
    text = F.col(text_col)
    prepared = jobs.select(F.col(id_col), text.alias("_text"), fold_hazard(text).alias("_hz"), F.lower(text).alias("_low"))
    prepared = prepared.withColumn("_words", words_of(F.col("_low")))
    tried = prepared.select(id_col, "_text", "_low", "_hz", WordIndex(patterns).candidates("_low", "_words", "_hz").alias("_ids"))
    # candidates are tested inside their row, each against a constant pattern (compiled once a
    # task), and only hits are exploded: no copy of the text per candidate
    hits = tried.select(id_col, F.explode(F.expr(f"filter(_ids, i -> {_matches_sql('i', patterns)})")).alias("_i"))
    names = ", ".join(f"struct({sql_text(c or '')} AS c, {sql_text(n or '')} AS n)" for c, n, _ in rows)
    return hits.select(id_col, F.expr(f"get(array({names}), _i % {len(rows)})").alias("_s")).select(
        id_col, F.col("_s.c").alias("skill_category"), F.col("_s.n").alias("skill_name")).distinct()
