"""URL filters: host and path rules, then a weighted vocabulary.

Rules allow or block a host with all its subdomains, from a path prefix on; the longest rule
that fits decides. A url without a rule is judged by its words: one Aho-Corasick pass finds
every term of the vocabulary, a boundary check drops terms inside longer words, and the
weights of the distinct terms that stay are added up. A strict term weighs as much as the
limit, so one rejects; soft terms weigh less, so only several distinct ones do.

Every url is judged on its own in the task that read it: there is no shuffle, and only the
automaton and the rules, both parameters, travel to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import ship_by_value, table


class Rule(NamedTuple):
    """``host/path``: fits the host and its subdomains where the path starts with ``/path``."""
    verdict: str
    place: str


class Term(NamedTuple):
    """A lower-case vocabulary entry; a ``whole`` one counts only as a whole word."""
    text: str
    weight: float
    whole: bool


# The rules of the contract.
RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"),
         Rule("allow", "org/fr/"))

LIMIT = 1.0
STRICT, SOFT = 1.0, 0.5
# Strict terms that no ordinary word holds count inside words too.
TERMS = (
    *(Term(t, STRICT, False) for t in ("porn", "hentai", "xvideo", "pharmacyonline", "onlinecasino")),
    *(Term(t, STRICT, True) for t in ("xxx", "milf", "camgirl", "camgirls", "sexcam", "sexcams", "viagra", "cialis",
                                      "warez", "keygen")),
    *(Term(t, SOFT, True) for t in ("adult", "bet", "betting", "casino", "crack", "cracked", "dating", "erotic",
                                    "escort", "escorts", "jackpot", "loan", "loans", "nude", "nudes", "payday",
                                    "pills", "poker", "sex", "sexy", "slots", "torrent", "torrents")),
)

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "host string, path string, rule string, verdict string, n_strict long, n_soft long, weight double"


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    rest = (url or "").partition("://")[2]
    host_end = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    path_end = min((k for k in (rest.find(c, host_end) for c in "?#") if k >= 0), default=len(rest))
    return rest[:host_end].translate(_LOWER), rest[host_end:path_end]


class Rulebook:
    """Looks a host up by its suffixes at label borders, the longest rule first."""

    def __init__(self, rules: Iterable[Rule]) -> None:
        self.by_host: dict[str, list[tuple[str, Rule]]] = {}
        for rule in rules:
            host, slash, path = rule.place.partition("/")
            self.by_host.setdefault(host.translate(_LOWER), []).append((slash + path, rule))
        self.longest = max(map(len, self.by_host), default=0)

    def find(self, host: str, path: str) -> Rule | None:
        fits = []
        at = len(host)
        while True:
            at = host.rfind(".", 0, at)
            if len(host) - at - 1 > self.longest:  # also a suffix that no rule can have
                break
            fits += [rule for prefix, rule in self.by_host.get(host[at + 1:], ()) if path.startswith(prefix)]
            if at < 0:
                break
        return min(fits, key=lambda r: (-len(r.place), r.place, r.verdict), default=None)


class Vocabulary:
    """Aho-Corasick automaton over the terms; ``hits`` gives the distinct ones of a url."""

    def __init__(self, terms: Iterable[Term]) -> None:
        self.automaton = ahocorasick.Automaton()
        for term in terms:
            self.automaton.add_word(term.text, term)
        if len(self.automaton):
            self.automaton.make_automaton()

    @staticmethod
    def _in_word(c: str) -> bool:
        return c.isalnum() if c < "\x80" else True

    def hits(self, url: str | None) -> set[Term]:
        text = (url or "").translate(_LOWER)
        found: set[Term] = set()
        if not len(self.automaton):
            return found
        for last, term in self.automaton.iter(text):
            first = last - len(term.text) + 1
            if term.whole and (first and self._in_word(text[first - 1])
                               or last + 1 < len(text) and self._in_word(text[last + 1])):
                continue
            found.add(term)
        return found


def judge_url(url: str | None, book: Rulebook, words: Vocabulary, limit: float = LIMIT) -> tuple:
    """(host, path, rule, verdict, n_strict, n_soft, weight) of one url."""
    host, path = split_url(url)
    rule, hits = book.find(host, path), words.hits(url)
    weight = sum(t.weight for t in hits)
    strict = sum(t.weight >= limit for t in hits)
    verdict = rule.verdict if rule else "block" if weight >= limit else "allow"
    return host, path, rule.place if rule else None, verdict, strict, len(hits) - strict, weight


def judge_urls(pages: DataFrame, url_col: str = "url", keep: Sequence[str] = ("page_id",),
               rules: Sequence[Rule] = RULES, terms: Sequence[Term] = TERMS, limit: float = LIMIT) -> DataFrame:
    """One row per input row: the ``keep`` columns, then ``host, path, rule, verdict`` and what
    the vocabulary found (``n_strict``, ``n_soft`` distinct terms, ``weight``, their sum).

    The whole url is searched, A-Z lower-cased and not decoded. A neighbour of a whole-word term
    must not be an ASCII letter or digit nor any other non-ASCII character. A null url, or one without ``://``,
    has an empty host and path, no rule, and is judged by its text (null: allowed). Equal rules
    in length are taken in code-point order of host and path. Repeated rows and null ids are
    judged row by row, other columns are not read, an empty table gives no rows. The cost of a
    url is linear in its length.
    """
    kept = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{url_col}`").alias("_url"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1]), COLUMNS])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, words = Rulebook(rules), Vocabulary(terms)
        kinds = (pa.string(),) * 4 + (pa.int64(), pa.int64(), pa.float64())
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        for batch in batches:
            found = [judge_url(u, book, words, limit) for u in batch.column(len(keep)).to_pylist()]
            columns = [pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *names])

    return kept.mapInArrow(judge, schema)


def allowed_pages(pages: DataFrame, url_col: str = "url", rules: Sequence[Rule] = RULES,
                  terms: Sequence[Term] = TERMS, limit: float = LIMIT) -> DataFrame:
    """The rows whose url is allowed, all columns unchanged; cases as in :func:`judge_urls`."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, words = Rulebook(rules), Vocabulary(terms)
        for batch in batches:
            urls = batch.column(batch.schema.names.index(url_col)).to_pylist()
            yield batch.filter(pc.equal(pa.array([judge_url(u, book, words, limit)[3] for u in urls], pa.string()),
                                        "allow"))

    return pages.mapInArrow(keep, pages.schema)


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def _rules_sql(rules: Sequence[Rule]) -> str:
    fits = []
    for rule in rules:
        host, slash, path = rule.place.partition("/")
        fits.append(f"CASE WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash}{path}') "
                    f"THEN {{'place': '{rule.place}', 'verdict': '{rule.verdict}'}} END")
    return ", ".join(fits)


def _terms_sql(terms: Sequence[Term]) -> str:
    edge = r"[^0-9a-z\x{80}-\x{10FFFF}]"
    tests = (f"regexp_matches(low, '(?s)(^|{edge}){t.text}({edge}|$)')" if t.whole else f"contains(low, '{t.text}')"
             for t in terms)
    return " + ".join(f"({x})::BIGINT" for x in tests) or "0::BIGINT"


ORACLE_SQL = f"""
WITH parts AS (
  SELECT page_id, coalesce(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS low,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', ['host', 'path']) AS p
  FROM pages),
split AS (
  SELECT page_id, low, p.path AS path,
         translate(p.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parts),
hits AS (
  SELECT *, {_terms_sql([t for t in TERMS if t.weight >= LIMIT])} AS n_strict,
         {_terms_sql([t for t in TERMS if t.weight < LIMIT])} AS n_soft,
         list_filter([{_rules_sql(RULES)}], lambda x: x IS NOT NULL) AS fits
  FROM split),
judged AS (
  SELECT *, n_strict * {STRICT} + n_soft * {SOFT} AS weight,
         list_sort(list_transform(fits, lambda x: {{'n': -length(x.place), 'place': x.place, 'verdict': x.verdict}}))[1] AS best
  FROM hits)
SELECT page_id, host, path, best.place AS rule,
       coalesce(best.verdict, CASE WHEN weight >= {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       n_strict, n_soft, weight::DOUBLE AS weight
FROM judged"""

ship_by_value(__name__)
