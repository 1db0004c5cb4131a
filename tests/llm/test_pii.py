import hashlib
import random
import re

from hirelake.llm import pii


def digits(m):
    return re.sub("[^0-9]", "", m)


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


# Fixed patterns of the four base kinds, in the order that breaks ties.
BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
)


def spans_by_hand(text):
    found = sorted((m.start(), k, m.end(), name) for k, (name, pattern, good) in enumerate(BASE)
                   for m in re.finditer(pattern, text) if good(m[0]))
    return ",".join(f"{name}:{start}:{end}" for start, _, end, name in found)


def base_spans(docs):
    out = []
    for r in pii.find_pii(docs).collect():
        out.append((r.doc_id, r.text, ",".join(f"{x.kind}:{x.s}:{x.e}" for x in r.spans if x.base)))
    return out


def test_random_texts_equal_plain_patterns(documents):
    draw = random.Random(5)
    bits = ["4111 1111 1111 1111", "4111-1111", "5500005555555559", "+49 (30) 123456-78", "+1", "255.255.0.1",
            "256.1.1.1", "0001.2.3.4", "1.2.3.4.5.6.7.8", "a@b.c", "x_y@b.co_d@e.fg", "@", ".", " ", "-", "12", "é", "🙂",
            "+", "(", "word", "\n", "9", "..", "@@", "a@b", "%"]
    rows = [(k, "".join(draw.choice(bits) for _ in range(draw.randint(0, 25))), "en", "a") for k in range(600)]
    for _, text, got in base_spans(documents(rows)):
        assert got == spans_by_hand(text), text


def test_every_document_of_the_table(spark):
    path = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    for r in pii.op8_pii(spark, path).collect():
        want = spans_by_hand(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        counts = {k: want.count(k + ":") for k in ("email", "ip", "card", "phone")}
        assert counts == {k: r[f"n_{k}"] for k in counts}


def test_added_kinds_need_checksum_and_context(documents):
    rows = [(1, "IBAN DE89 3704 0044 0532 0130 00 thanks", "en", "a"), (2, "IBAN DE88 3704 0044 0532 0130 00", "en", "a"),
            (3, "GB82WEST12345698765432", "en", "a"), (4, "his SSN is 078-05-1120.", "en", "a"),
            (5, "build 078-05-1120 of the model", "en", "a")]
    got = {r.doc_id: [(x.kind, r.text[x.s:x.e], x.score) for x in r.spans if not x.base]
           for r in pii.find_pii(documents(rows)).collect()}
    assert got[1][0][:2] == ("iban", "DE89 3704 0044 0532 0130 00") and got[1][0][2] == 1.0
    assert got[3][0][0] == "iban" and got[4][0][:2] == ("ssn", "078-05-1120")
    assert got[2] == [] and got[5] == []


def test_linear_on_junk(documents):
    rows = [(1, "1" * 200_000, "en", "a"), (2, "a" * 200_000 + "@", "en", "a"), (3, "+1" * 50_000, "en", "a"),
            (4, "1." * 60_000, "en", "a"), (5, "+1" + " " * 100_000, "en", "a"), (6, "1 " * 60_000, "en", "a")]
    got = {i: s for i, _, s in base_spans(documents(rows))}
    assert got[1] == got[2] == ""


def test_awkward_rows(awkward, clashing, documents):
    got = pii.find_pii(awkward).collect()
    assert len(got) == awkward.count() and all(not r.spans for r in got)
    assert pii.find_pii(clashing).count() == len(got)
    assert pii.find_pii(documents([])).count() == 0
    red = pii.redact(documents([(1, "mail a@b.co or 10.0.0.1 now", "en", "a")])).collect()
    assert red[0].text == "mail [email] or [ip] now"


def test_places_and_time_with_very_many_matches(documents):
    """Blocks of places join up, and a text of very many matches takes little time."""
    import time

    from hirelake.llm import pii
    for n in (1, 63, 64, 65, 130):
        text = "é" + "".join(f" a{k}@b.cd,x" for k in range(n))
        got = pii.find_pii(documents([(1, text, "en", "a")])).first().spans
        assert [text[x.s:x.e] for x in got] == [f"a{k}@b.cd" for k in range(n)]
    text = " ".join(f"user{k}@host{k}.example.org" for k in range(100_000))
    began = time.time()
    found = pii.find_pii(documents([(1, text, "en", "a")])).selectExpr("size(spans) AS n", "spans[99999].e AS e").first()
    assert (found.n, found.e) == (100_000, len(text))
    print("100,000 addresses:", round(time.time() - began, 1), "s")
    assert time.time() - began < 60
