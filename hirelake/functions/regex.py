"""PostgreSQL regular expressions on Spark.

Rules are written in PostgreSQL's ARE dialect (the dialect the pipeline's rules were
authored in) and translated to ``java.util.regex`` so they run inside Spark's
generated code. The differences that change results:

* ``\\y`` is a word boundary in PostgreSQL, ``\\b`` in Java.
* ``\\b`` is a *backspace* in PostgreSQL, so ``\\bin\\b`` never matches normal text.
* ``~*`` folds case with Unicode rules (``ÖSTERREICH`` matches ``österreich``),
  word characters are Unicode letters and digits, and ``.`` matches a newline:
  Java needs ``(?iUs)``.
* ``\\s`` is the locale's space class; ``$`` is the end of the string only.

``regex_any_ci`` searches the lower-cased text first. An alternative that is a plain literal
is settled by that search; every other alternative contains a literal that any match must
contain, so that its regex runs only where the text holds one. Where the alternative allows it,
this is a case-sensitive regex on the lower-cased text that begins with a literal, which Java
searches for by skips; else the case-insensitive one. Characters whose case folding differs between ``lower()`` and the regex
engine (dotted/dotless i, long s) send a row to the whole regex, so the result is always the
regex's own answer.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as PostgreSQL's [[:space:]] sees it in a UTF-8 glibc locale
# (no-break spaces U+00A0, U+2007, U+202F are not spaces there).
PG_SPACE_CHARS = (r"\t\n\x0B\f\r \x{1680}\x{2000}-\x{2006}\x{2008}-\x{200A}"
                  r"\x{2028}\x{2029}\x{205F}\x{3000}")

# Characters that the case-insensitive regex equates with an ASCII letter while
# lower() maps them elsewhere: they disable the literal pre-filter for a row.
FOLD_HAZARDS = ("İ", "ı", "ſ")

_COMMON = " enisratodlhucmgpfbwyvk"  # the frequent characters of English and German texts, by frequency
_META = set("\\^$.|?*+()[]{}")
_ONE_WORD = re.compile(r"\\y([A-Za-z0-9_]+)\\y")
_LITERAL_FIRST = re.compile(r"([^\\^$.|?*+()\[\]{}]+)((?:\[- \]\??|\\s\*|\.\{\d+,\d+\}|[^\\^$.|?*+()\[\]{}])*)")
_TWO_PARTS = re.compile(r"([^\\^$.|?*+()\[\]{}]+)\[- \](\?)?([^\\^$.|?*+()\[\]{}]+)")


def _bracket_end(p: str, i: int) -> int:
    """Index just past the bracket expression starting at ``p[i] == '['``."""
    j = i + 1
    if j < len(p) and p[j] == "^":
        j += 1
    if j < len(p) and p[j] == "]":
        j += 1
    while j < len(p):
        if p[j] == "\\":
            j += 2
            continue
        if p[j] == "]":
            return j + 1
        j += 1
    raise ValueError(f"unterminated bracket expression in {p!r}")


def _group_end(p: str, i: int) -> int:
    """Index just past the group starting at ``p[i] == '('``."""
    depth = 0
    j = i
    while j < len(p):
        c = p[j]
        if c == "\\":
            j += 2
            continue
        if c == "[":
            j = _bracket_end(p, j)
            continue
        if c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if depth == 0:
                return j + 1
        j += 1
    raise ValueError(f"unbalanced parentheses in {p!r}")


def pg_to_java(pattern: str) -> str:
    """Translate a PostgreSQL ARE body to a java.util.regex body (no flags)."""
    out: list[str] = []
    i, n = 0, len(pattern)
    while i < n:
        c = pattern[i]
        if c == "[":
            end = _bracket_end(pattern, i)
            body = pattern[i:end]
            out.append(body.replace(r"\s", PG_SPACE_CHARS))
            i = end
            continue
        if c == "\\" and i + 1 < n:
            e = pattern[i + 1]
            out.append({
                "y": r"\b",
                "b": r"\x08",
                "B": r"\\",
                "m": r"\b(?=\w)",
                "M": r"\b(?<=\w)",
                "A": r"\A",
                "Z": r"\z",
                "s": "[" + PG_SPACE_CHARS + "]",
                "S": "[^" + PG_SPACE_CHARS + "]",
            }.get(e, c + e))
            i += 2
            continue
        out.append(r"\z" if c == "$" else c)
        i += 1
    return "".join(out)


def ci_pattern(pattern: str) -> str:
    """Java pattern equal to PostgreSQL ``~* pattern``."""
    first, body = first_chars(pattern), pg_to_java(pattern)
    # one look at the next character, where most places fail, before boundaries and alternatives
    return f"(?iUs)(?=[{first}])(?:{body})" if first else "(?iUs)" + body


def first_chars(pattern: str) -> str | None:
    """The characters that a match can begin with (one case of each); None unless every
    alternative begins with an ASCII letter, digit or slash of its own."""
    if pattern.startswith(("(?", "***")):
        return None
    found = []
    for alt in _alternatives(pattern):
        c = alt[:1]
        if not (c.isascii() and (c.isalnum() or c == "/")) or alt[1:2] in ("?", "*", "{"):
            return None
        found.append(c)
    return "".join(dict.fromkeys(found))


def cs_pattern(pattern: str) -> str:
    """Java pattern equal to PostgreSQL ``~ pattern`` / ``regexp_match``."""
    return "(?Us)" + pg_to_java(pattern)


# --------------------------------------------------------------------------- needles

def _split_top(p: str) -> list[str]:
    parts, start, i = [], 0, 0
    while i < len(p):
        c = p[i]
        if c == "\\":
            i += 2
            continue
        if c == "[":
            i = _bracket_end(p, i)
            continue
        if c == "(":
            i = _group_end(p, i)
            continue
        if c == "|":
            parts.append(p[start:i])
            start = i + 1
        i += 1
    parts.append(p[start:])
    return parts


def _strip_boundaries(p: str) -> str:
    changed = True
    while changed:
        changed = False
        if p.startswith(r"\y"):
            p, changed = p[2:], True
        if p.endswith(r"\y") and not p.endswith(r"\\y"):
            p, changed = p[:-2], True
    return p


def _alternatives(p: str) -> list[str]:
    p = _strip_boundaries(p)
    if p.startswith("(") and not p.startswith(("(?=", "(?!", "(?<")) \
            and _group_end(p, 0) == len(p):
        inner = p[3:-1] if p.startswith("(?:") else p[1:-1]
        return [a for part in _split_top(inner) for a in _alternatives(part)]
    parts = _split_top(p)
    if len(parts) > 1:
        return [a for part in parts for a in _alternatives(part)]
    return [p]


def _required_literal(alt: str) -> str:
    """Longest run of characters that every match of ``alt`` contains."""
    runs: list[str] = []
    cur: list[str] = []

    def flush():
        if cur:
            runs.append("".join(cur))
            cur.clear()

    i, n = 0, len(alt)
    while i < n:
        c = alt[i]
        tok = None
        if c == "\\" and i + 1 < n:
            e = alt[i + 1]
            i += 2
            if e == "b":
                tok = "\x08"
            elif e.isalnum():
                flush()
                continue
            else:
                tok = e
        elif c == "[":
            i = _bracket_end(alt, i)
            flush()
        elif c == "(":
            i = _group_end(alt, i)
            flush()
        elif c in ".^$":
            i += 1
            flush()
        elif c in "*+?{":
            # quantifier after a skipped construct
            i = (alt.index("}", i) + 1) if c == "{" else i + 1
            flush()
            continue
        else:
            tok = c
            i += 1
        if tok is None:
            continue
        q = alt[i] if i < n else ""
        if q in ("?", "*"):
            i += 1
            flush()
            continue
        if q == "{":
            j = alt.index("}", i)
            lo = int((alt[i + 1:j].split(",")[0] or "0"))
            i = j + 1
            if lo > 0:
                cur.append(tok)
            flush()
            continue
        if q == "+":
            i += 1
            cur.append(tok)
            flush()
            continue
        cur.append(tok)
    flush()
    return max(runs, key=len) if runs else ""


def needles(pattern: str) -> list[str] | None:
    """Literal strings (lower case) one of which any match must contain, or None."""
    out: list[str] = []
    for alt in _alternatives(pattern):
        lit = _required_literal(alt).lower()
        if not lit:
            return None
        if lit not in out:
            out.append(lit)
    return out


# --------------------------------------------------------------------------- Columns

def fold_hazard(col: Column) -> Column:
    return reduce(lambda a, b: a | b, [col.contains(h) for h in FOLD_HAZARDS])


def sql_text(text: str) -> str:
    """A SQL string literal, whatever the session's escape setting for plain ones."""
    if "'" not in text and all(ch >= " " for ch in text):
        return f"r'{text}'"
    return "concat(" + ", ".join(f"char({ord(ch)})" if ch == "'" or ch < " " else f"r'{ch}'" for ch in text) + ")"


def rare_tail(literal: str) -> str:
    """``literal`` from one of its rarer characters on: a byte search compares the rest only where
    the first byte agrees, so it passes a text faster. At least four characters stay."""
    starts = range(max(1, len(literal) - 3))
    return literal[min(starts, key=lambda i: (_COMMON.find(literal[i]) + 1 and len(_COMMON) - _COMMON.find(literal[i]), i)):]


def settled(pattern: str) -> tuple[list[str], list[str], str | None]:
    """The alternatives that are plain literals and those that are one whole word of ASCII
    characters (both in lower case), and the pattern of all others (None if there are none).
    Embedded options hold for all alternatives: nothing is cut off."""
    if pattern.startswith("***") or re.match(r"\(\?[a-z]", pattern):
        return [], [], pattern
    inner = pattern
    while inner.startswith("(") and not inner.startswith("(?") and _group_end(inner, 0) == len(inner):
        inner = inner[1:-1]
    literals, words, rest = [], [], []
    for part in _split_top(inner):
        if part and not set(part) & _META:
            literals.append(part.lower())
        elif m := _ONE_WORD.fullmatch(part):
            words.append(m[1].lower())
        else:
            rest.append(part)
    return literals, words, "|".join(rest) if rest else None


def held_forms(pattern: str) -> list[str] | None:
    """As :func:`needles`, but an alternative of two literals with a blank or hyphen between them
    (``a[- ]?b``) counts with all its forms, which few texts hold by chance."""
    if needles(pattern) is None:
        return None
    out: list[str] = []
    for alt in _alternatives(pattern):
        m = _TWO_PARTS.fullmatch(alt)
        out += [m[1] + c + m[3] for c in ["-", " "] + [""] * bool(m[2])] if m else [_required_literal(alt)]
    return list(dict.fromkeys(x.lower() for x in out))


def lowered_alternatives(pattern: str) -> list[tuple[list[str], str]] | None:
    """For each alternative the literals one of which a lower-cased text must hold, and a
    case-sensitive Java pattern that matches the lower-cased text where the alternative matches the
    text (but for rows of :func:`fold_hazard`). It begins with the alternative's first literal, the
    boundary before it tested behind it. None unless every alternative begins with a literal and
    goes on with literals, ``[- ]``, ``\\s*`` and ``.{m,n}`` only, none of which a change of case touches."""
    found: list[tuple[list[str], str]] = []
    for part in _split_top(pattern):
        lead, tail = part.startswith(r"\y"), part.endswith(r"\y") and not part.endswith(r"\\y")
        inner = part[2 * lead:len(part) - 2 * tail]
        if inner.startswith("(") and not inner.startswith("(?") and _group_end(inner, 0) == len(inner):
            inner = inner[1:-1]
        for alt in _split_top(inner):
            m = _LITERAL_FIRST.fullmatch(alt)
            if not m or alt != alt.lower() or any(h in alt for h in FOLD_HAZARDS):
                return None
            behind = rf"(?<=\b{m[1]})" if lead else ""
            found.append((held_forms(alt), f"(?Us){m[1]}{behind}{pg_to_java(m[2])}" + r"\b" * tail))
    return found


def holds(lowered: Column, literal: str) -> Column:
    """``contains``, by a tail of the literal that is quicker to search for."""
    tail = rare_tail(literal)
    return lowered.contains(literal) if tail == literal else lowered.contains(tail) & lowered.contains(literal)


def shared_part(literals: list[str]) -> str:
    """The longest part (of four characters at least, else '') that all literals hold; of equally long
    ones the one with the rarest character."""
    first = min(literals, key=len)
    parts = {first[i:j] for i in range(len(first)) for j in range(i + 4, len(first) + 1)}
    held = [p for p in parts if all(p in x for x in literals)]
    return max(held, key=lambda p: (len(p), max(_COMMON.find(c) % (len(_COMMON) + 1) for c in p), p)) if held else ""


def sharing(literals: list[str]) -> list[tuple[str, list[str]]]:
    """The literals in groups that share a part (``shared_part``; '' for a literal alone): a text without it holds none
    of them, so it is searched once for a group."""
    groups: list[list[str]] = []
    for literal in dict.fromkeys(literals):
        group = next((g for g in groups if shared_part([*g, literal])), None)
        if group is None:
            groups.append([literal])
        else:
            group.append(literal)
    return [(shared_part(g) if len(g) > 1 else "", g) for g in groups]


def holds_any(lowered: Column, literals: list[str]) -> Column:
    """Whether the text holds one of the literals."""
    tests = []
    for part, group in sharing(literals):
        found = reduce(lambda a, b: a | b, [holds(lowered, x) for x in group])
        tests.append(lowered.contains(rare_tail(part)) & found if part else found)
    return reduce(lambda a, b: a | b, tests)


def _word_pattern(word: str) -> str:
    """``\\bword\\b`` with the literal in front, where the search for a place begins."""
    return rf"(?U){word}\b(?<=\b{word})"


def regex_any_ci_sql(col: str, pattern: str, lowered: str, hazard: str) -> str:
    """The same test as ``regex_any_ci`` as one SQL expression over named columns (one
    round trip to build instead of one per literal)."""
    def has(x: str) -> str:
        return f"contains(`{lowered}`, {sql_text(x)})"

    def held(x: str) -> str:  # as :func:`holds`
        return has(x) if rare_tail(x) == x else f"({has(rare_tail(x))} AND {has(x)})"

    def held_any(xs: list[str]) -> str:  # as :func:`holds_any`
        tests = [(part, " OR ".join(map(held, group))) for part, group in sharing(xs)]
        return " OR ".join(f"({has(rare_tail(part))} AND ({found}))" if part else found for part, found in tests)

    def like(name: str, java: str) -> str:
        return f"rlike(`{name}`, {sql_text(java)})"
    whole = like(col, ci_pattern(pattern))
    literals, words, rest = settled(pattern)
    tests = [held_any(literals)] if literals else []
    tests += [f"({has(w)} AND {like(lowered, _word_pattern(w))})" for w in words]
    if rest is not None:
        alternatives, forms = lowered_alternatives(rest), held_forms(rest)
        if forms is None and not tests:
            return whole
        if alternatives is not None:
            tests += [f"(({held_any(xs)}) AND {like(lowered, java)})" for xs, java in alternatives]
        else:
            match = like(col, ci_pattern(rest))
            tests.append(match if forms is None else f"(({held_any(forms)}) AND {match})")
    return f"CASE WHEN `{hazard}` THEN {whole} ELSE {' OR '.join(tests)} END"


def regex_any_ci(col: Column | str, pattern: str, lowered: Column | str | None = None,
                 hazard: Column | str | None = None) -> Column:
    """PostgreSQL ``col ~* pattern``: NULL on NULL input, else a boolean. With column
    names for all three inputs the test is built as one SQL expression."""
    if isinstance(col, str) and isinstance(lowered, str) and isinstance(hazard, str):
        return F.expr(regex_any_ci_sql(col, pattern, lowered, hazard))
    col = F.col(col) if isinstance(col, str) else col
    lowered = F.col(lowered) if isinstance(lowered, str) else lowered
    hazard = F.col(hazard) if isinstance(hazard, str) else hazard
    lowered = lowered if lowered is not None else F.lower(col)
    hazard = hazard if hazard is not None else fold_hazard(col)
    whole = col.rlike(ci_pattern(pattern))
    literals, words, rest = settled(pattern)
    tests = [holds_any(lowered, literals)] if literals else []
    tests += [lowered.contains(w) & lowered.rlike(_word_pattern(w)) for w in words]
    if rest is not None:
        alternatives, forms = lowered_alternatives(rest), held_forms(rest)
        if forms is None and not tests:
            return whole
        if alternatives is not None:
            tests += [holds_any(lowered, xs) & lowered.rlike(java) for xs, java in alternatives]
        else:
            match = col.rlike(ci_pattern(rest))
            tests.append(match if forms is None else holds_any(lowered, forms) & match)
    return F.when(hazard, whole).otherwise(reduce(lambda a, b: a | b, tests))


def regex_any(col: Column, pattern: str) -> Column:
    """PostgreSQL ``col ~ pattern`` (case-sensitive)."""
    return col.rlike(cs_pattern(pattern))


def first_group(col: Column, pattern: str, idx: int = 1) -> Column:
    """``(regexp_match(col, pattern))[idx]``: NULL when nothing or an empty group matched. A pattern
    in lower case is searched for only in texts that hold a literal of it."""
    lower = pattern == pattern.lower()
    first, forms = (first_chars(pattern), held_forms(pattern)) if lower else (None, None)
    java = f"(?Us)(?=[{first}])(?:{pg_to_java(pattern)})" if first else cs_pattern(pattern)
    found = F.nullif(F.regexp_extract(col, java, idx), F.lit(""))
    return F.when(holds_any(col, forms), found) if forms else found


def first_match(col: Column, pattern: str) -> Column:
    """Whole first match of a case-sensitive pattern; '' when there is none."""
    return F.regexp_extract(col, cs_pattern(pattern), 0)


def groups_of_match(match: Column, pattern: str, idx: int) -> Column:
    """Group ``idx`` of ``pattern`` re-run, anchored, on an already found match.

    Equal to the group of the first match in the full text when the pattern has no
    context assertions: the search then only scans the short match, not the text.
    """
    anchored = "(?Us)^(?:" + pg_to_java(pattern) + ")"
    return F.nullif(F.regexp_extract(match, anchored, idx), F.lit(""))
