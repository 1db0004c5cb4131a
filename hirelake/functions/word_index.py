"""Inverted index from words to regular expressions.

Most rule patterns can match only where a certain word stands: each alternative has an entry
word, the run of word characters that any match of it must hold as a whole word, begin a word
with, or end a word with. A text is cut into its words once; looking these up gives the few patterns that can match, and only
those run as regular expressions. Where the entry word is only a word's beginning or end, the
text is searched for it; a pattern with an alternative that has no entry word is a candidate for
every text. Candidates are a superset, so results are the regexes' own. An alternative that is one
whole word needs no regular expression: the look-up tells.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.regex import _ONE_WORD, _alternatives, _bracket_end, _split_top, sql_text

WORDS = r"(?U)[\w]+"
WHOLE, BEGIN, END = "whole", "begin", "end"


def words_of(lowered: Column) -> Column:
    """The words of a lower-cased text: the one scan of it."""
    return F.regexp_extract_all(lowered, F.lit(WORDS), F.lit(0))


def _is_word(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def _marks(p: str, i: int) -> int:
    """Index past a bracket at ``i`` that holds no word characters; 0 if there is none."""
    if p[i:i + 1] != "[" or p[i + 1] == "^":
        return 0
    end = _bracket_end(p, i)
    body = p[i + 1:end - 1]
    return 0 if any(_is_word(c) or c == "\\" for c in body) or "-" in body[1:-1] else end


def _without_options(p: str) -> list[str]:
    """Both forms of a pattern with one optional mark, ``a[- ]?b``: with it and without."""
    for i, c in enumerate(p):
        if c == "[" and (end := _marks(p, i)) and p[end:end + 1] == "?":
            return [p[:end] + p[end + 1:], p[:i] + p[end + 1:]]
    return [p]


def entry_word(alternative: str) -> tuple[str, str] | None:
    """(word, kind): any match of the alternative holds a word equal to ``word``, beginning or
    ending with it; None when that cannot be told. Reads the literal characters from the start
    of the alternative; ``word`` is lower case."""
    p, bounded = alternative, True
    if p.startswith(r"\y"):
        p = p[2:]
    elif p.startswith(r"(?<!\w)"):
        p = p[7:]
    else:
        bounded = False

    def found(word: str, closed: bool) -> tuple[str, str] | None:
        if not word or not (bounded or closed):
            return None
        return word.lower(), (WHOLE if closed else BEGIN) if bounded else END

    word, i = "", 0
    while i < len(p):
        c, size = p[i], 1
        if c == "\\" and i + 1 < len(p):
            if p[i + 1] == "y":
                return found(word, True)
            if p[i + 1].isalnum():
                break
            c, size = p[i + 1], 2
        elif c == "[" and (end := _marks(p, i)) and p[end:end + 1] not in ("?", "*", "{"):
            return found(word, True)
        elif c in "[(.^$*+?{|":
            break
        follows = p[i + size:i + size + 1]
        if follows in ("?", "*", "{"):  # this character may be missing
            break
        if _is_word(c):
            word += c
        elif word:
            return found(word, True)
        elif not bounded:
            break  # the word after a leading mark begins there, not at a border of ours
        i += size
        if follows == "+":
            break
    return found(word, False)


def _bounded_alternatives(pattern: str) -> list[str]:
    """Top-level alternatives, their own boundaries kept; boundaries around a group of
    alternatives are handed to each."""
    parts = _split_top(pattern)
    if len(parts) > 1:
        return [a for part in parts for a in _bounded_alternatives(part)]
    lead = r"\y" if pattern.startswith(r"\y") else ""
    tail = r"\y" if pattern.endswith(r"\y") else ""
    inner = _alternatives(pattern)
    return [pattern] if len(inner) == 1 else [lead + a + tail for a in inner]


def entry_words(pattern: str) -> list[tuple[str, str]] | None:
    """Entry words of all alternatives, or None if one has none."""
    found = [entry_word(form) for alt in _bounded_alternatives(pattern) for form in _without_options(alt)]
    return None if None in found else found


def one_words(pattern: str) -> tuple[list[str], str | None]:
    """The alternatives that are one whole word of ASCII characters, in lower case, and the pattern
    of all others (None if there are none). A text matches ``pattern`` exactly when it holds one of
    the words or matches the rest. Embedded options hold for all alternatives: nothing is cut off."""
    if pattern.startswith("***") or re.match(r"\(\?[a-z]", pattern):
        return [], pattern
    parts = _split_top(pattern)
    words = [m[1].lower() for p in parts if (m := _ONE_WORD.fullmatch(p))]
    rest = [p for p in parts if not _ONE_WORD.fullmatch(p)]
    return words, "|".join(rest) if rest else None


class WordIndex:
    """Candidate patterns (by their number) of a text, from its words. A pattern that one of its
    :func:`one_words` settles has its number plus ``size``."""

    def __init__(self, patterns: Sequence[str]) -> None:
        self.size = len(patterns)
        self.always: list[int] = []
        self.whole: dict[str, list[int]] = {}
        self.parts: dict[str, list[int]] = {}
        for i, pattern in enumerate(patterns):
            words, rest = one_words(pattern)
            for word in dict.fromkeys(words):
                self.whole.setdefault(word, []).append(self.size + i)
            entries = entry_words(rest) if rest else []
            if entries is None:
                self.always.append(i)
            for word, kind in dict.fromkeys(entries or []):
                ids = (self.whole if kind == WHOLE else self.parts).setdefault(word, [])
                if i not in ids:
                    ids.append(i)

    def candidates(self, lowered: str, words: str, hazard: str) -> Column:
        """``array<int>`` over the column names of the lower-cased text, of its words and of the
        flag of rows that every pattern must try (see ``regex.fold_hazard``). Built as one SQL
        expression."""
        parts = [f"cast(array({', '.join(map(str, self.always))}) AS array<int>)"]
        if self.whole:
            keys = sorted(self.whole)
            names = f"array({', '.join(map(sql_text, keys))})"
            ids = ", ".join(f"array({', '.join(map(str, self.whole[k]))})" for k in keys)
            parts.append(f"flatten(transform(array_intersect(`{words}`, {names}), "
                         f"w -> element_at(map_from_arrays({names}, array({ids})), w)))")
        parts += [f"IF(contains(`{lowered}`, {sql_text(word)}), array({', '.join(map(str, ids))}), cast(array() AS array<int>))"
                  for word, ids in self.parts.items()]
        return F.expr(f"CASE WHEN `{hazard}` THEN sequence(0, {self.size - 1}) "
                      f"ELSE array_distinct(concat({', '.join(parts)})) END")
