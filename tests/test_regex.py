"""PostgreSQL regex dialect on Spark."""

import pytest
from pyspark.sql import functions as F

from hirelake.functions.regex import ci_pattern, needles, pg_to_java, regex_any_ci
from hirelake.operators import classify as C
from hirelake.sources.taxonomy import taxonomy_rows

TAX = {name: pat for _, name, pat in taxonomy_rows()}


def test_translation():
    assert pg_to_java(r"\yat\y") == r"\bat\b"
    assert pg_to_java(r"\bin\b") == r"\x08in\x08"       # backspace in PostgreSQL
    assert pg_to_java(r"(?=\W|$)") == r"(?=\W|\z)"
    assert ci_pattern("x").startswith("(?iUs)")


def test_needles():
    assert needles(r"\y(senior|sr\.?|lead)\y") == ["senior", "sr", "lead"]
    assert needles(TAX["node_js"]) == ["node"]
    assert needles(r"\yscikit[- ]learn\y|\ysklearn\y") == ["scikit", "sklearn"]
    assert needles(r"a.*") == ["a"]
    assert needles(r"(a|[bc])") is None          # an alternative without literal


CASES = [
    ("ÖSTERREICH", C.COUNTRY_AREA_RULES[0][0], True),
    ("in a team", C.COUNTRY_SNIPPET_RULES[0][0], False),
    ("zusammen arbeiten", C.COUNTRY_SNIPPET_RULES[1][0], True),
    ("100% remote", C.EMPLOYMENT_TEXT_RULES[2][0], False),
    ("100%ig", C.EMPLOYMENT_TEXT_RULES[2][0], True),
    ("C++ dev", TAX["c_plus_plus"], False),
    ("C++dev", TAX["c_plus_plus"], True),
    ("C# & .NET", TAX["c_sharp"], True),
    ("Go lang", TAX["go"], False),
    ("golang", TAX["go"], True),
    ("Sr. Engineer", C.LEVEL_TITLE_RULES[0][0], True),
    ("working language is english", C.LANGUAGE_RULES[0][0], True),
    ("line one\nworking language:\nenglish", C.LANGUAGE_RULES[0][0], True),   # . matches newline
    ("LİNUX admin", TAX["linux"], "same"),        # folding hazard bypasses the pre-filter
    ("ſpark jobs", TAX["spark"], "same"),
    (None, TAX["spark"], None),
]


@pytest.mark.parametrize("text,pattern,expected", CASES)
def test_regex_cases(spark, text, pattern, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(regex_any_ci(F.col("t"), pattern).alias("m")).first()["m"]
    plain = df.select(F.col("t").rlike(ci_pattern(pattern)).alias("m")).first()["m"]
    if expected != "same":
        assert got == expected
    assert got == plain                            # pre-filter never changes the answer


def test_first_characters(spark):
    """The look at the first character leaves every match, folded ones too."""
    from hirelake.functions.regex import first_chars
    assert first_chars(r"\y(sr\.?|lead|100%)\y") == "sl1"
    assert [first_chars(p) for p in (r"s?ap", r"(?<!\w)\.net", r"österreich|at", "(a|b)?c", "a|", ".x")] == [None] * 6
    texts = ["SAP", "ſap", "x sap", "\u212aafka", "K8S", "İt", "it", "ıt", "sapx", "no", "K8s it"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern in (r"\ysap\y|\ykafka\y", r"\y(k8s|it)\y"):
        plain = "(?iUs)" + pg_to_java(pattern)
        assert all(r.a == r.b for r in rows.select(F.col("t").rlike(ci_pattern(pattern)).alias("a"),
                                                   F.col("t").rlike(plain).alias("b")).collect())


def test_settled_alternatives():
    """Literals and whole words are told apart from what only a regex can tell."""
    from hirelake.functions.regex import held_forms, rare_tail, settled
    assert settled(r"(usa|new york|\btx\b|\yat\y)") == (["usa", "new york"], ["at"], r"\btx\b")
    assert settled(r"\y(remote|wfh)\y|100%") == (["100%"], [], r"\y(remote|wfh)\y")
    assert settled("(?i)a|b") == ([], [], "(?i)a|b") and settled("a.b|c+") == ([], [], "a.b|c+")
    assert held_forms(r"\y(full[- ]time|home[- ]?office|100%)\y") == [
        "full-time", "full time", "home-office", "home office", "homeoffice", "100%"]
    assert held_forms("(a|[bc])") is None
    assert [rare_tail(x) for x in ("hourly", "per month", "at", "c1")] == ["urly", "per month", "at", "c1"]


def test_rules_equal_plain_regex(spark):
    """Every rule, by names and by columns, against its whole regex on odd texts."""
    import random
    draw = random.Random(3)
    tables = [getattr(C, n) for n in dir(C) if n.endswith("_RULES") and n != "EMPLOYMENT_FIELD_RULES"]
    patterns = list(dict.fromkeys(p for table in tables for p, _ in table))
    bits = ["at", "AT", "de", "ch", " ", " ", "-", "/", "_", ".", "\n", "x", "1", "\x08", "\x08in\x08", "\u0130", "\u017f", "\u212a", "\u00f6",
            "\u00d6sterreich", "M\u00dcNCHEN", "usa", "Basel", "u\u017fa", "\u0130ndia", "new york", "full/ part-time: full time", "Full-Time", "part time",
            "homeoffice", "home office", "on-site", "on site", "100%", "c1", "german", "required", "per month", "/hr", "hourly", "sr.", "Lead",
            "mid-level", "intern", "internship", "nice to have", "working language", "english", "pr\u00e4senz", "Fran\u212afurt", "wor\u212a from home"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 7))) for _ in range(1500)] + ["", None]
    from hirelake.functions.regex import fold_hazard
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.lower("t").alias("low"), fold_hazard(F.col("t")).alias("hz"))
    for part in (patterns[::2], patterns[1::2]):
        out = rows.select("t", *[c.alias(f"{k}{i}") for i, p in enumerate(part) for k, c in
                                 (("a", F.col("t").rlike(ci_pattern(p))), ("b", regex_any_ci("t", p, "low", "hz")), ("c", regex_any_ci(F.col("t"), p)))])
        for r in out.collect():
            for i, p in enumerate(part):
                assert r[f"a{i}"] == r[f"b{i}"] == r[f"c{i}"], (p, r["t"])


def test_first_group_equals_plain(spark):
    from hirelake.functions.regex import cs_pattern, first_group
    texts = ["in wien, graz", "wiener", "x m\u00fcnchen", "linz_", "frankfurt am main", "Wien", "", None, "\u00f6wien linz"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for p in (C.JOOBLE_CITY_PATTERN, "([A-Z]ien)"):
        out = rows.select(first_group(F.col("t"), p).alias("a"), F.nullif(F.regexp_extract("t", cs_pattern(p), 1), F.lit("")).alias("b"))
        assert all(r.a == r.b for r in out.collect())


def test_alternatives_on_lowered_text(spark):
    """Alternatives of literals run as patterns that begin with a literal; others keep the whole regex."""
    from hirelake.functions.regex import fold_hazard, lowered_alternatives
    assert lowered_alternatives(r"\y(wfh|home[- ]?office)\y|no.{0,3}x") == [
        (["wfh"], r"(?Us)wfh(?<=\bwfh)\b"),
        (["home-office", "home office", "homeoffice"], r"(?Us)home(?<=\bhome)[- ]?office\b"),
        (["no"], "(?Us)no.{0,3}x")]
    for other in (r"\y(sr\.?|lead)\y", r"a?b", r"\wb", "[a-c]d", "Ab", "ıb", r"(?i)ab", "ab+", r"\bin\b", "(ab", "a(b|c)"):
        try:
            assert lowered_alternatives(other) is None, other
        except ValueError:
            assert other == "(ab"
    texts = ["WFH", "xwfh wfh", "wfhx", "äwfh", "wfh́", "HOME OFFICE", "home--office home-office", "homeofficex", "NO12X", "no\nÄßx",
             "no1234x", "homehome office", "İ wfh", "wfK", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.lower("t").alias("low"), fold_hazard(F.col("t")).alias("hz"))
    for p in (r"\y(wfh|home[- ]?office)\y|no.{0,3}x", r"\y(100%|c\yx|on[- ]?site)\y", r"\ywf\y|\y(no.{0,3}x)"):
        for r in rows.select("t", F.col("t").rlike(ci_pattern(p)).alias("a"), regex_any_ci("t", p, "low", "hz").alias("b"),
                             regex_any_ci(F.col("t"), p).alias("c")).collect():
            assert r.a == r.b == r.c, (p, r.t)


def test_tier_limits(spark):
    sizes = [0, 149, 150, 499, 500, 5000]
    rows = spark.createDataFrame([(n, ch * n) for n in sizes for ch in ("x", "ä", "\U0001f600")], "n int, t string")
    for r in rows.select("n", C.description_quality_tier(F.col("t"), F.lit("AT")).alias("tier")).collect():
        assert r.tier == (C.TIER_SHORT if r.n < 150 else C.TIER_PARTIAL if r.n < 500 else C.TIER_VALID)


def test_literals_that_share_a_part(spark):
    """One search settles a text without the part that several literals share."""
    from hirelake.functions.regex import holds_any, shared_part, sharing
    assert sharing(["full-time", "full time", "100%"]) == [("full", ["full-time", "full time"]), ("", ["100%"])]
    assert sharing(["on-site", "on site", "onsite"]) == [("site", ["on-site", "on site", "onsite"])]
    assert shared_part(["at", "ate"]) == "" and shared_part(["hourly", "per hour"]) == "hour"
    texts = ["full moon", "full time", "xfull-timex", "100%", "100 %", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r.m for r in rows.select(holds_any(F.col("t"), ["full-time", "full time", "100%"]).alias("m")).collect()]
    assert found == [False, True, True, True, False, False, None]


def test_other_spaces_collapse(spark):
    """Runs with any of PostgreSQL's spaces become one blank, whatever else the text holds."""
    from hirelake.functions.text import PG_SPACE_CHARS, flatten_whitespace
    spaces = [chr(c) for c in (0x0B, 0x0C, 0x20, 0xA0, 0x1680, 0x2000, 0x2007, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
    texts = [f"{a}x{s}{t}y{b}" for s in spaces for t in spaces for a, b in (("", ""), ("„ä", "€"))] + ["", None, "– –"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    out = rows.select("t", flatten_whitespace(F.col("t")).alias("a"), F.regexp_replace("t", f"[{PG_SPACE_CHARS}]{{2,}}", " ").alias("b"))
    for r in out.collect():
        assert r.a == r.b, repr(r.t)
