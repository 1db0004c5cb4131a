"""Near-duplicate detection with min-max hashing.

Each permutation of a document's shingles yields two signature values, the minimum and the
maximum, so 64 hash evaluations per shingle give 128 values; they are banded a few to a band.
Documents with equal shingle sets form one class and only class representatives are compared.

Inside a band bucket every member is first compared with the bucket's hub, the member that
shares most buckets with others; links are confirmed on the full shingle sets. After the
connected components of these links only buckets that still hold several components are
looked at again, and there only members of different components: bucket by bucket in pairs
where it has few members, else in blocks, where a task compares two blocks of one bucket and
returns no more links than join components. What is skipped can only be a link inside one
component, so the components are those of all candidate links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import ship_by_value, staged, table

SHINGLE_WORDS = 5
SIMILARITY = 0.8
PERMUTATIONS = 64
BAND_ROWS = 4
CHUNK_BYTES = 1 << 20
# Ids up to this many (16 MB of them) are broadcast to pick texts out of a scan.
BROADCAST_IDS = 2_000_000
# Buckets up to this many members are compared pair by pair, longer ones in blocks of about
# this many members and shingles.
SHORT_BUCKET = 16
BLOCK_MEMBERS = 256
BLOCK_SHINGLES = 1_000_000
_SEED = 0x5EED


def _mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of the distinct word shingles of texts, from the UTF-8 bytes of a whole batch.

    A word's hash is a difference of prefix sums of byte codes times powers of an odd base,
    scaled back by the inverse power, so all words of a batch are hashed at once.
    """

    def __init__(self, words: int) -> None:
        rng = np.random.default_rng(_SEED)
        self.words = words
        self.codes = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
        upper = np.arange(ord("A"), ord("Z") + 1)
        self.codes[upper] = self.codes[upper + 32]
        self.blank = np.zeros(256, dtype=bool)
        self.blank[[0x20, 9, 10, 11, 12, 13]] = True
        self.base = rng.integers(2**40, 2**63, 1, dtype=np.uint64) | np.uint64(1)
        self.inverse = np.array([pow(int(self.base[0]), -1, 1 << 64)], dtype=np.uint64)
        self.multipliers = rng.integers(2**40, 2**63, words, dtype=np.uint64) | np.uint64(1)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.concatenate(([np.uint64(1)], np.repeat(self.base, size - 1))))
            self.down = np.cumprod(np.concatenate(([np.uint64(1)], np.repeat(self.inverse, size - 1))))

    def _chunk(self, data: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        """``data``: bytes of texts, each followed by one blank; ``ends``: after each blank."""
        self._powers(len(data) + 1)
        gap = self.blank[data]
        edge = np.flatnonzero(np.diff(gap, prepend=True))
        first, last = edge[0::2], edge[1::2]
        total = np.concatenate(([np.uint64(0)], np.cumsum(self.codes[data] * self.up[:len(data)])))
        word = _mix64((total[last] - total[first]) * self.down[first] + (last - first).astype(np.uint64))
        k = self.words
        run = np.zeros(max(0, len(word) - k + 1), dtype=np.uint64)
        for i in range(k):
            run += word[i:len(word) - k + 1 + i] * self.multipliers[i]
        run = _mix64(run)
        cuts = np.searchsorted(first, ends)
        low = 0
        for high in cuts:
            n = high - low
            if n >= k:
                yield np.unique(run[low:high - k + 1])
            elif n > 0:
                short = np.zeros(1, dtype=np.uint64)
                for i in range(n):
                    short += word[low + i] * self.multipliers[i]
                yield _mix64(short + np.uint64(n))
            else:
                yield np.zeros(0, dtype=np.uint64)
            low = high

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """One sorted array of distinct shingle hashes per text, in order; null is empty."""
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        if texts.null_count or len(texts) == 0 or texts.buffers()[2] is None:
            texts = pa.array([x or "" for x in texts.to_pylist()], type=pa.large_string())
            offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[:len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
        start = 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES, side="right")) - 1)
            stop = min(stop, len(texts))
            sizes = np.diff(offsets[start:stop + 1])
            ends = np.cumsum(sizes + 1)
            data = np.full(int(ends[-1]), 0x20, dtype=np.uint8)
            place = np.ones(len(data), dtype=bool)
            place[ends - 1] = False
            data[place] = raw[offsets[start]:offsets[stop]]
            yield from self._chunk(data, ends)
            start = stop


class Signer:
    """Min-max signatures of shingle sets, folded into band keys."""

    def __init__(self, permutations: int, rows: int) -> None:
        rng = np.random.default_rng(_SEED + 1)
        self.factor = rng.integers(2**40, 2**63, permutations, dtype=np.uint64) | np.uint64(1)
        self.shift = rng.integers(0, 2**63, permutations, dtype=np.uint64)
        self.rows, self.bands = rows, 2 * permutations // rows
        self.weights = rng.integers(2**40, 2**63, (self.bands, rows), dtype=np.uint64) | np.uint64(1)

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        low = high = None
        for at in range(0, len(shingles), 4096):
            hashed = (shingles[at:at + 4096, None] ^ self.shift) * self.factor
            least, most = hashed.min(axis=0), hashed.max(axis=0)
            low = least if low is None else np.minimum(low, least)
            high = most if high is None else np.maximum(high, most)
        values = np.concatenate((low, high))[:self.bands * self.rows].reshape(self.bands, self.rows)
        folded = (_mix64(values) * self.weights).sum(axis=1, dtype=np.uint64)
        return _mix64(folded + np.arange(self.bands, dtype=np.uint64)).view(np.int64)


SIGNED = "doc_id bigint, t bigint, n bigint, d1 bigint, d2 bigint, bands array<bigint>"


def _sign_batches(words: int, permutations: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(words), Signer(permutations, rows)
        with np.errstate(over="ignore"):
            for batch in batches:
                n, d1, d2, bands = [], [], [], []
                for shingles in shingler.sets(batch.column(1)):
                    n.append(len(shingles))
                    d1.append(int(shingles.sum(dtype=np.uint64).astype(np.int64)))
                    d2.append(int(_mix64(shingles ^ np.uint64(0x9E3779B97F4A7C15))
                                  .sum(dtype=np.uint64).astype(np.int64)))
                    bands.append(signer.keys(shingles) if len(shingles) else [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()), batch.column(2).cast(pa.int64()), pa.array(n, pa.int64()),
                     pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "t", "n", "d1", "d2", "bands"])
    return sign


def _common_shingles(words: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        with np.errstate(over="ignore"):
            for batch in batches:
                both = zip(shingler.sets(batch.column(2)), shingler.sets(batch.column(3)), strict=True)
                sizes = [(len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))) for a, b in both]
                columns = list(zip(*sizes, strict=True)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in columns)],
                    names=["a", "b", "n_a", "n_b", "common"])
    return count


def texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, t, text) of the ids and text hashes, once each, as a table in the shared folder. The
    ids are broadcast up to ``BROADCAST_IDS`` of them; more are joined by shuffling."""
    ids = staged(ids.distinct(), "ids")
    small = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return staged(docs.join(small, ["doc_id", "t"], "left_semi").dropDuplicates(["doc_id", "t"]), "pair-texts")


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """Of pairs of texts (a, ta), (b, tb) those whose full shingle sets reach the similarity."""
    pairs = staged(pairs, "pairs")
    ids = pairs.selectExpr("inline(array(struct(a AS doc_id, ta AS t), struct(b AS doc_id, tb AS t)))")
    texts = texts_of(ids, docs)
    left = texts.select(F.col("doc_id").alias("a"), F.col("t").alias("ta"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("t").alias("tb"), F.col("text").alias("text_b"))
    both = pairs.join(right, ["b", "tb"]).join(left, ["a", "ta"]).select("a", "b", "text_a", "text_b")
    counted = both.mapInArrow(_common_shingles(words), "a bigint, b bigint, n_a bigint, n_b bigint, common bigint")
    percent = round(similarity * 100)
    return counted.where(F.col("common") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("common")) * percent
                         ).select("a", "b")


def _links_in_blocks(words: int, similarity: float):
    """Links between the members of two blocks of one bucket, as few as join the components
    that they join. A pair is looked at in the first band it shares only."""
    percent = round(similarity * 100)

    def find(group: pa.Table) -> pa.Table:
        key, p, q = (group.column(c)[0].as_py() for c in ("key", "p", "q"))
        with np.errstate(over="ignore"):
            sets = list(Shingler(words).sets(group.column("text").combine_chunks()))
        rep, block, label = (group.column(c).to_numpy() for c in ("rep", "block", "label"))
        bands = np.array(group.column("bands").to_pylist(), dtype=np.int64)
        size = np.array([len(s) for s in sets])
        vocabulary, code = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(size)
        seen = np.zeros(len(vocabulary), dtype=bool)
        parent = {int(x): int(x) for x in label}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out: list[tuple[int, int]] = []
        for i in np.flatnonzero(block == p):
            others = np.flatnonzero((block == q) & (label != label[i])
                                    & (np.minimum(size, size[i]) * 100 >= np.maximum(size, size[i]) * percent))
            if p == q:
                others = others[others > i]
            if not len(others):
                continue
            shared = (bands[others] == bands[i]).argmax(axis=1)
            others = others[bands[i][shared] == key]
            if not len(others):
                continue
            own = code[ends[i] - size[i]:ends[i]]
            seen[own] = True
            common = np.array([seen[code[ends[j] - size[j]:ends[j]]].sum() for j in others])
            seen[own] = False
            linked = common * 100 >= (size[others] + size[i] - common) * percent
            for j in others[linked]:
                x, y = root(int(label[i])), root(int(label[j]))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append((int(rep[i]), int(rep[j])))
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return find


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node reachable over edges (a, b), for every node of an edge.

    Alternates two steps until nothing changes: every node hands its larger neighbours to
    its least neighbour, then its smaller ones. Both are one aggregation and one join over
    tables in the shared folder, so a lost executor repeats one step only.
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))

    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "large-star")
        least = smallest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = staged(small.unionByName(least.select("u", F.col("m").alias("v")).where("u <> v")).distinct(),
                       "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                words: int = SHINGLE_WORDS, similarity: float = SIMILARITY,
                permutations: int = PERMUTATIONS, band_rows: int = BAND_ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per input row.

    Words are runs of non-blank characters with A-Z lower-cased; a document's set is its
    distinct shingles of ``words`` words, or its whole word sequence when it has fewer.
    Documents are linked when the Jaccard similarity of their sets is at least ``similarity``
    and grouped by reachability; the least id names the group and is kept. Null, empty and
    blank texts have an empty set and stay alone, as do rows without an id (component null,
    kept). Rows that repeat an id are one document with several texts: each text is compared
    on its own, and a link of any of them is a link of the document, so all its rows are in one
    group. An empty table gives no rows.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(F.col(text_col)).alias("t"))  # tells the texts of one id apart
    signed = staged(narrow.mapInArrow(_sign_batches(words, permutations, band_rows), SIGNED), "signed")
    with_set = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = staged(with_set.groupBy("n", "d1", "d2").agg(
        F.min(F.struct("doc_id", "t")).alias("r"), F.first("bands").alias("bands")).select(
        "n", "d1", "d2", F.col("r.doc_id").alias("rep"), "r.t", "bands"), "classes")
    rows = classes.select("rep", "t", "n", F.explode("bands").alias("key"))
    crowded = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    member = staged(rows.join(crowded, "key"), "members")  # only buckets of two or more

    # hub of a bucket: the member with most company over all its buckets, then the least id
    company = member.groupBy("rep").agg(F.sum("c").alias("company"))
    member = staged(member.join(company, "rep"), "members-company")
    hubs = member.groupBy("key").agg(F.max(F.struct("company", (-F.col("rep")).alias("rep"), "n", "t")).alias("h"))
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * round(similarity * 100)
    star = staged(member.join(hubs, "key").select(
        (-F.col("h.rep")).alias("a"), F.col("h.t").alias("ta"), F.col("h.n").alias("n_a"),
        F.col("rep").alias("b"), F.col("t").alias("tb"), F.col("n").alias("n_b"))
        .where((F.col("a") != F.col("b")) & fits).select("a", "ta", "b", "tb").distinct(), "star")
    links = staged(confirmed(star, narrow, words, similarity), "links")
    labels = staged(components(links), "labels")

    # buckets with several components left: short ones by pairs, long ones in blocks
    labeled = member.join(labels, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "t", "n", F.coalesce("label", "rep").alias("label"))
    left = labeled.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("total"),
                                      (F.min("label") != F.max("label")).alias("several"))
    left = staged(labeled.join(left.where("several"), "key"), "open")
    short = left.where(F.col("c") <= SHORT_BUCKET)
    one = short.select("key", F.col("rep").alias("a"), F.col("t").alias("ta"), F.col("n").alias("n_a"), F.col("label").alias("label_a"))
    two = short.select("key", F.col("rep").alias("b"), F.col("t").alias("tb"), F.col("n").alias("n_b"), F.col("label").alias("label_b"))
    rest = one.join(two, "key").where((F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b")) & fits)
    met = star.selectExpr("least(a, b) AS a", "IF(a < b, ta, tb) AS ta", "greatest(a, b) AS b", "IF(a < b, tb, ta) AS tb")
    rest = rest.select("a", "ta", "b", "tb").distinct().join(met, ["a", "ta", "b", "tb"], "left_anti")
    more = confirmed(rest, narrow, words, similarity)

    long = left.where(F.col("c") > SHORT_BUCKET)
    texts = texts_of(long.select(F.col("rep").alias("doc_id"), "t"), narrow).withColumnRenamed("doc_id", "rep")
    blocks = F.ceil(F.greatest(F.col("c") / BLOCK_MEMBERS, F.col("total") / BLOCK_SHINGLES)).cast("int")
    dealt = long.withColumn("blocks", blocks).withColumn(
        "block", F.expr("cast(pmod(xxhash64(rep), blocks) AS int)"))
    dealt = dealt.join(classes.select("rep", "t", "bands"), ["rep", "t"]).join(texts, ["rep", "t"]).withColumn(
        "other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "key", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
        "rep", "block", "label", "bands", "text")
    more = more.unionByName(dealt.groupBy("key", "p", "q").applyInArrow(
        _links_in_blocks(words, similarity), "a bigint, b bigint"))

    # the classes that hold texts of one id are tied together; a row without words is a class of its own
    owned = with_set.join(classes.select("n", "d1", "d2", "rep"), ["n", "d1", "d2"]).select("doc_id", "n", "rep")
    owned = staged(owned.unionByName(signed.where("n = 0 OR doc_id IS NULL").select(
        "doc_id", "n", F.col("doc_id").alias("rep"))), "owned")
    spread = owned.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("most")).where("a <> most")
    ties = owned.join(spread, "doc_id").select("a", F.col("rep").alias("b"))
    labels = staged(components(links.unionByName(more).unionByName(ties)), "labels")
    grouped = owned.join(labels, F.col("rep") == F.col("node"), "left")
    return grouped.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "rep").alias("component_id")
                          ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows whose document stays; all columns unchanged."""
    gone = near_groups(docs, id_col, text_col, **options).where("NOT kept").select(F.col("doc_id").alias("_gone"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                        F.col(id_col).cast("long").alias("_gone"))
    return whole.join(gone.distinct(), "_gone", "left_anti").select("_doc.*")


def op3_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), words=3, similarity=0.85, band_rows=5)


ship_by_value(__name__)
