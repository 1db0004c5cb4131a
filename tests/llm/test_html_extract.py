import itertools
import math

import pytest

from hirelake.llm import html_extract as he
from hirelake.llm.html_pages import labelled_pages


@pytest.fixture(scope="module")
def model():
    return he.train(None)


def brute_marginals(model, nodes):
    """Marginals by summing over all labelings."""
    total, content = 0.0, [0.0] * len(nodes)
    for labels in itertools.product(he.LABELS, repeat=len(nodes)):
        weight = 0.0
        for k, node in enumerate(nodes):
            parent = labels[node.parent] if k else he.MIXED
            edge = model.edges.get((parent, node.kind)) or model.edges[parent, ""]
            weight += edge[labels[k]] + model._potentials(node)[labels[k]]
        p = math.exp(weight)
        total += p
        for k, y in enumerate(labels):
            content[k] += p * (y == he.CONTENT)
    return [c / total for c in content]


def test_messages_give_exact_marginals(model):
    page = "<div class=post><h1>Title</h1><p>Some words, here.</p><div class=ad>Buy</div></div><footer>x</footer>"
    nodes = he.parse(page)
    assert len(nodes) < 12
    for got, want in zip(model.marginals(nodes), brute_marginals(model, nodes), strict=True):
        assert math.isclose(got, want, rel_tol=1e-6, abs_tol=1e-9)


def test_extracts_article(model):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
      <nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- ad -->
      <div class="ad">Buy this now, it is cheap.</div>
      <article><h1>The title of it</h1><p><b>First   paragraph of the text, long &amp; clear &lt;enough&gt;.<br>
      <p>Second paragraph, which also says
      something in a few words.</article>
      <div id="comments"><p>I liked this article, and so did others here.</p></div>
      <form><label>Mail</label><input><button>Go</button></form><footer>&copy; 2020 all of us</footer></body></html>"""
    assert he.main_text(model, page).split("\n") == [
        "The title of it", "First paragraph of the text, long & clear <enough>.",
        "Second paragraph, which also says something in a few words."]


def test_held_out_composed_pages(model):
    right = wrong = missed = 0
    for page in labelled_pages(80, seed=31):
        nodes = he.parse(page)
        for node, y, p in zip(nodes, he._labels(nodes, article=False), model.marginals(nodes), strict=True):
            if node.tag == "#text":
                right += p > 0.5 and y == he.CONTENT
                wrong += p > 0.5 and y != he.CONTENT
                missed += p <= 0.5 and y == he.CONTENT
    assert right / (right + wrong) > 0.88 and right / (right + missed) > 0.88


def test_awkward_pages(spark, model):
    pages = [(1, "u", None, "x"), (2, "u", "", "x"), (3, None, "no tags, just words in a row here.", "x"),
             (4, "u", "<" * 50_000, "x"), (5, "u", '<a "' * 20_000, "x"), (None, "u", "<div>" * 20_000 + "x", "x"),
             (6, "u", "<p>" + "long text, and more. " * 50_000 + "</p>", "x"), (6, "u", "</p></div><p>", "x")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, text string")
    got = df.select("page_id", he.extract(df, model).alias("t")).collect()
    assert len(got) == len(pages)
    found = {r.page_id: r.t for r in got}
    assert found[1] == found[2] == ""
    assert max(len(r.t) for r in got if r.page_id == 6) == len("long text, and more. " * 50_000) - 1
    empty = spark.createDataFrame([], "page_id bigint, html string")
    assert empty.select(he.extract(empty, he.train(empty))).count() == 0


def test_table_pages(spark):
    """The article of the table's pages is found, word for word, on nearly all of them."""
    import html
    import re
    got = he.op5_html_extract(spark, "/root/testdata/sf0.001").collect()
    raw = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    good = 0
    for r in got:
        article = re.search(r"<article>(.*?)</article>", raw[r.page_id], re.S)[1]
        want = html.unescape(re.sub(r"<[^>]+>", " ", article)).split()
        good += r.text.split() == want
        assert r.n_chars == len(r.text)
    assert good >= 0.98 * len(got)


def test_label_attributes_of_real_pages(spark, model):
    body = """<article><h1>The title of it</h1><p>The price of it is <span data-label="Price">ten of them</span> here,
      and <span data-label="1">not one</span> more, says <span data-label=0>the text</span> of the page.</p></article>"""
    page = f"<html><body><nav><a href='/'>Home</a></nav>{body}</body></html>"
    assert he.main_text(model, page).split("\n") == [
        "The title of it", "The price of it is ten of them here, and not one more, says the text of the page."]
    pages = spark.createDataFrame([(1, page)], "page_id bigint, html string")
    assert pages.select(he.extract(pages, he.train(pages)).alias("t")).first().t.startswith("The title of it")


@pytest.mark.parametrize("before", [
    "<svg viewBox='0 0 1 1'/>", "<math/>", "<iframe src='a' />", "<video src='a'/>", "<script src='x' />",
    "<script src='x' /><script>var a = 'not text';</script>", "<object data='a'/>", "<button />", "<select/>",
    "<button>Go", "<form><button>Go</form>", "<select><option>one<option>two", "<select><optgroup><option>one",
    "<svg><path d='M0'>", "<video src='a'>", "<button>Go<div><button>Stop</button></div>", "<datalist><option>one",
    "<map name='m'><area href='#'>"])
def test_nothing_behind_is_dropped(before):
    page = f"<html><body><div>{before}</div><article><p>First words.</p><p>Last words.</p></article></body></html>"
    parts = [n.parts[0] for n in he.parse(page, marks=False) if n.parts]
    assert parts == ["First words.", "Last words."]


@pytest.mark.parametrize("page", [
    "<html><head><title>T</title><meta charset=utf-8><article><p>First words.</p><p>Last words.</p></article></html>",
    "<head><title>T</title><script>var a;</script>First words.<p>Last words.</p>",
    "<head><link rel=x><svg/><p>First words.<p>Last words.",
    "<head/><p>First words.<p>Last words."])
def test_head_without_end(page):
    assert [n.parts[0] for n in he.parse(page, marks=False) if n.parts] == ["First words.", "Last words."]


def test_closed_elements_are_dropped_whole():
    page = ("<head><title>T</title><style>p{}</style></head><p>First words.</p><button><div>Go</div> on</button>"
            "<select><option>one</option></select><script src=x />not text</script><svg><text>no</text></svg>"
            "<iframe src=http://a/>none</iframe><p>Last words.</p>")
    assert [n.parts[0] for n in he.parse(page, marks=False) if n.parts] == ["First words.", "Last words."]


def test_many_open_dropped_elements_in_linear_time():
    for tag in ("<svg>", "<video/>", "<button>", "<select>", "<noscript>"):
        assert [n.parts[0] for n in he.parse(tag * 50_000 + "<p>Last words.") if n.parts] == ["Last words."]
