import random
import re

from pyspark.sql import functions as F

from hirelake.llm import url_filter as uf

PAGES = "page_id bigint, url string, html string"


def by_hand(url):
    """The contract with regular expressions."""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = []
    for verdict, place in uf.RULES:
        at, rest = place.split("/", 1)
        if (host == at or host.endswith("." + at)) and path.startswith("/" + rest):
            fits.append((len(place), place, verdict))
    low = re.sub("[A-Z]", lambda x: x[0].lower(), url or "")
    edge = r"[0-9a-z\x80-\U0010ffff]"
    hits = [t for t in uf.TERMS
            if re.search(f"(?<!{edge}){t.text}(?!{edge})" if t.whole else t.text, low)]
    strict = sum(t.weight >= 1 for t in hits)
    weight = sum(t.weight for t in hits)
    rule = max(fits, default=(0, None, None))
    return (host, path, rule[1], rule[2] or ("block" if weight >= 1 else "allow"), strict, len(hits) - strict, weight)


HARD = [None, "", "no scheme", "://", "http://", "http://net", "http://net/", "https://a.NET/x", "http://xnet/", "http://net./",
        "http://example.net/en", "http://example.net/en/", "http://b.example.net/en/1?x=/de/", "http://example.com/de/#x",
        "http://example.com?/de/", "http://a.example.com/de/poker/casino", "http://org/fr/", "http://x.org/fr/xxx",
        "http://.net/", "http://..org/fr/", "http://a.b:80/net/", "a://b://net/", "http://x.net:80/", "http://essex.uk/xxxl",
        "http://a.uk/xxx", "http://a.uk/XXX.html", "http://freePORNs.uk/", "http://adult.uk/dating", "http://adult-dating.uk",
        "http://adult.uk/adult?adult", "http://casino1.uk/poker", "http://poker.uk/éxxx", "http://uk/xxxé", "http://uk/\nxxx\n",
        "http://" + "a." * 50_000 + "org/fr/", "http://u" + "k" * 100_000 + "/xxx", "http://a.uk/" + "sex/" * 20_000]


def test_equals_plain_rules(spark):
    draw = random.Random(3)
    parts = ["http", "://", "/", "?", "#", ".", "net", "org", "example", "com", "en", "fr", "de", "xxx", "poker", "SEX", "é", "9", "-"]
    urls = HARD + ["".join(draw.choice(parts) for _ in range(draw.randint(1, 12))) for _ in range(3000)]
    urls += ["http://" + "".join(draw.choice(parts[2:]) for _ in range(draw.randint(1, 12))) for _ in range(3000)]
    pages = spark.createDataFrame([(k, u, "") for k, u in enumerate(urls)], PAGES)
    for r in uf.judge_urls(pages).collect():
        assert tuple(r)[1:] == by_hand(urls[r.page_id]), urls[r.page_id]


def test_longest_rule_and_ties():
    book = uf.Rulebook([uf.Rule("block", "b.a/"), uf.Rule("allow", "a/xy"), uf.Rule("block", "a/"), uf.Rule("allow", "a")])
    assert book.find("c.b.a", "/xy").place == "a/xy"
    assert book.find("c.b.a", "/x").place == "b.a/"
    assert book.find("a", "/x").place == "a/"
    assert book.find("a", "").place == "a"
    assert book.find("", "") is None and uf.Rulebook([]).find("a", "/") is None


def test_vocabulary_alone_and_empty_parameters(spark):
    pages = spark.createDataFrame([(1, "http://x.net/cats", ""), (2, "http://x.net/cats/dogs", "")], PAGES)
    terms = [uf.Term("cats", 0.4, True), uf.Term("dogs", 0.7, True), uf.Term("s", 0.1, True)]
    got = {r.page_id: r.verdict for r in uf.judge_urls(pages, rules=(), terms=terms).collect()}
    assert got == {1: "allow", 2: "block"}
    assert {r.verdict for r in uf.judge_urls(pages, rules=(), terms=()).collect()} == {"allow"}


def test_awkward_rows_and_filter(spark):
    rows = [(None, "http://a.uk/xxx", None), (1, None, "x"), (1, None, "x"), (2, "http://a.net/", ""), (3, "", "y")]
    pages = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit("z") for c in ("host", "rule", "verdict", "_url")})
    got = uf.judge_urls(pages).select("page_id", "verdict").collect()
    assert sorted(map(tuple, got), key=repr) == [(1, "allow"), (1, "allow"), (2, "block"), (3, "allow"), (None, "block")]
    kept = uf.allowed_pages(pages)
    assert kept.columns == pages.columns
    assert sorted(r.page_id for r in kept.collect()) == [1, 1, 3]
    empty = spark.createDataFrame([], PAGES)
    assert uf.judge_urls(empty).collect() == [] and uf.allowed_pages(empty).collect() == []
