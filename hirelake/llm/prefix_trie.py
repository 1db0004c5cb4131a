"""Prefix trie of conversations by vertical bitmaps.

Turns are dealt to shards: ascending ranges of conversation ids of about ``rows_per_shard``
turns. A shard indexes (position, turn) to the bitset of its conversations that have that
turn there; depth first, a node's bitset is intersected with the postings of the next
position, each intersection that is not empty is a child, its popcount the members. Members
that end at a node are the intersection with the bitset of conversations of that length.

A node of the whole trie is the sequence of turns from the root, named by a chained digest,
so shards agree on names and their counts are added up by name; no shard needs another one's
conversations. Texts never leave the scan: a turn is its digest and its number of words.

Sums over subtrees need no walk over the whole trie. Each node is owned by its smallest
member, so the nodes that one conversation owns are the end of its path, and a node lies in
the subtree of u exactly if its owner is a member of u and it is not above u. A second pass
over the shards adds up, over the members of each node, what those members own; what the
node's own owner owns above it is taken off again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.llm.common import crc32_sql, ship_by_value, staged, table, word_count

GROUP = 20
MOST_BORROWED = 3
ROWS_PER_SHARD = 20_000
# A turn's digest keeps half of SHA-256, a node's name is a 128-bit digest: with 1e12 nodes two
# differ in name with a probability above 1 - 1e-14.
DIGEST_HEX = 32
ROOT = b"\0" * 16


class Stretch(NamedTuple):
    """Consecutive turns of one conversation: from ``depth`` (named ``key``) on; ``ends`` if
    its last turn is the conversation's last."""
    conv_id: int
    depth: int
    key: bytes
    turns: list[tuple[bytes, int]]
    ends: bool
    sums: tuple[int, int]


def child_key(key: bytes, digest: bytes) -> bytes:
    return hashlib.blake2b(key + digest, digest_size=16).digest()


def _bits(members: int) -> Iterator[int]:
    """Numbers of the set bits, ascending."""
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


class Shard:
    """Vertical bitmaps over stretches, one bit each in ascending order of conv_id."""

    def __init__(self, stretches: list[Stretch]) -> None:
        self.stretches = stretches
        self.postings: dict[tuple[int, bytes], int] = {}
        self.stop: dict[int, int] = {}
        self.ended: dict[int, int] = {}
        self.starts: dict[tuple[int, bytes], int] = {}
        for i, s in enumerate(stretches):
            bit = 1 << i
            for k, (digest, _) in enumerate(s.turns, s.depth + 1):
                self.postings[k, digest] = self.postings.get((k, digest), 0) | bit
            last = s.depth + len(s.turns)
            self.stop[last] = self.stop.get(last, 0) | bit
            if s.ends:
                self.ended[last] = self.ended.get(last, 0) | bit
            self.starts[s.depth, s.key] = self.starts.get((s.depth, s.key), 0) | bit

    def nodes(self) -> Iterator[tuple[bytes, bytes | None, int, int, int, int]]:
        """(key, parent key, depth, members, words of the last turn, members that end), depth
        first; a stretch that goes on from an earlier shard does not repeat its first node."""
        for (depth, key), members in self.starts.items():
            waiting = [(key, None, depth, members, 0)]
            while waiting:
                key, parent, depth, members, words = waiting.pop()
                if parent is not None or depth == 0:
                    yield key, parent, depth, members, words, members & self.ended.get(depth, 0)
                rest = members & ~self.stop.get(depth, 0)
                while rest:
                    s = self.stretches[(rest & -rest).bit_length() - 1]
                    digest, n = s.turns[depth - s.depth]
                    child = rest & self.postings[depth + 1, digest]
                    rest &= ~child
                    waiting.append((child_key(key, digest), key, depth + 1, child, n))


def stretches(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[Stretch]]:
    """Shards of about ``limit`` rows from rows sorted by (conv_id, pos): whole conversations,
    but for one that is longer than a shard, which goes on in the next."""
    held: list[Stretch] = []
    rows, now = 0, None
    for batch in batches:
        for conv, pos, digest, words, *sums in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv != now.conv_id:
                if now is not None:
                    held.append(now._replace(ends=True))
                if rows >= limit:
                    yield held
                    held, rows = [], 0
                now = Stretch(conv, 0, ROOT, [], False, tuple(sums) or (0, 0))
            elif rows >= limit and len(now.turns) >= limit:
                yield [*held, now]
                key = now.key
                for done, _ in now.turns:
                    key = child_key(key, done)
                held, rows = [], 0
                now = Stretch(conv, now.depth + len(now.turns), key, [], False, now.sums)
            rows += 1
            if pos:  # position 0 only tells that the conversation is there
                now.turns.append((digest, words))
    if now is not None:
        yield [*held, now._replace(ends=True)]


_FOUND = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                    ("n", pa.int64()), ("words", pa.int64()), ("ends", pa.list_(pa.int64()))])
_ADDED = pa.schema([("key", pa.binary()), ("words", pa.int64()), ("leaves", pa.int64())])
_HASHED = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
FOUND = "key binary, parent binary, depth long, conv_id long, n long, words long, ends array<long>"


def _batch(columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def first_turns(turns: DataFrame, group: int = GROUP, most: int = MOST_BORROWED) -> DataFrame:
    """Rebuilt conversations from (conv_id, pos, digest, words): of conversation c the first h
    turns come from c - c % group, the rest are its own from the h-th on; h = crc32(c) % (most + 1).
    Positions may skip numbers; each conversation has one row with pos 0 and no digest."""
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(most + 1)
    convs = turns.where("pos = 1").select("conv_id", borrowed.alias("h"))
    marks = convs.select("conv_id", F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("digest"),
                         F.lit(0).cast("long").alias("words"))
    wanted = convs.where("h > 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
                                         F.explode(F.sequence(F.lit(1), F.col("h").cast("int"))).alias("pos"))
    lent = turns.where(F.col("pos") <= most).withColumnRenamed("conv_id", "base")
    taken = wanted.join(lent, ["base", "pos"]).select("conv_id", "pos", "digest", "words")
    own = turns.where(F.col("pos") > borrowed).select("conv_id", "pos", "digest", "words")
    return marks.unionByName(taken).unionByName(own)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words) of every turn; pos counts from 1 by turn, null first."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_turn"),
        F.unhex(F.substring(F.sha2(content, 256), 1, DIGEST_HEX)).alias("digest"), word_count(text).alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("_turn").asc_nulls_first(), "digest")
    return turns.select("conv_id", F.row_number().over(order).alias("pos"), "digest", "words")


def _ranged(rows: DataFrame) -> DataFrame:
    """Ranges of conversation ids, each sorted by conversation and position."""
    return rows.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "pos")


def trie_nodes(rebuilt: DataFrame, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """Every shard's nodes: ``FOUND`` columns; ``ends`` are the members that end there."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in stretches(batches, rows_per_shard):
            ids = [s.conv_id for s in shard]
            rows = [(key, parent, depth, ids[(members & -members).bit_length() - 1], members.bit_count(), words,
                     [ids[i] for i in _bits(ends)] if ends else None)
                    for key, parent, depth, members, words, ends in Shard(shard).nodes()]
            yield _batch([list(c) for c in zip(*rows)] or [[] for _ in _FOUND], _FOUND)

    return _ranged(rebuilt).mapInArrow(find, FOUND)


def subtree_sums(rebuilt: DataFrame, owners: DataFrame, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """Per node (key): the sums over its members of ``owned`` and ``leaf`` of ``owners``."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in stretches(batches, rows_per_shard):
            heavy = sum(1 << i for i, s in enumerate(shard) if s.sums[0])
            leaf = sum(1 << i for i, s in enumerate(shard) if s.sums[1])
            rows = [(key, sum(shard[i].sums[0] for i in _bits(members & heavy)), (members & leaf).bit_count())
                    for key, _, _, members, _, _ in Shard(shard).nodes()]
            yield _batch([list(c) for c in zip(*rows)] or [[] for _ in _ADDED], _ADDED)

    # only the row at position 0 needs its conversation's sums: it comes first
    marks = rebuilt.where("pos = 0").join(owners, "conv_id", "left").select(
        "conv_id", "pos", "digest", "words", F.coalesce("owned", F.lit(0)).alias("owned"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"))
    rest = rebuilt.where("pos > 0").select("*", F.lit(0).cast("long").alias("owned"), F.lit(0).cast("long").alias("leaf"))
    found = _ranged(marks.unionByName(rest)).mapInArrow(add, "key binary, words long, leaves long")
    return found.groupBy("key").agg(F.sum("words").alias("words_below"), F.sum("leaves").alias("n_leaves"))


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's comma-joined ids, from lists sorted by (key, first id): a list
    is hashed as it comes, so a node of any size needs no more memory than one list."""
    key, state = None, None
    for batch in batches:
        keys, hashes = [], []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = ",".join(map(str, ids)).encode()
            if k == key:
                state.update(b"," + text)
                continue
            if key is not None:
                keys.append(key)
                hashes.append(state.hexdigest())
            key, state = k, hashlib.sha256(text)
        yield _batch([keys, hashes], _HASHED)
    if key is not None:
        yield _batch([[key], [state.hexdigest()]], _HASHED)


def prefix_trie(conversations: DataFrame, group: int = GROUP, most_borrowed: int = MOST_BORROWED,
                rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations (see :func:`first_turns`):
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Reads the columns ``conv_id, turn, role, text``. Turns are ordered by ``turn``, null first;
    equal ones by the digest of role and text, so repeated rows are turns of their own and reruns
    agree. A null role or text is empty, rows with a null conv_id belong to no conversation and are
    left out, other columns are not read, a table without conversations gives no node (not even a
    root). A conversation longer than a shard is read on from shard to shard.
    """
    turns = staged(numbered_turns(conversations), "trie-turns")
    rebuilt = staged(first_turns(turns, group, most_borrowed), "trie-rebuilt")
    found = staged(trie_nodes(rebuilt, rows_per_shard), "trie-found")
    nodes = staged(found.groupBy("key").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n").alias("n_convs"), F.min("words").alias("words")), "trie-nodes")

    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    counted = counted.withColumn("_saved", (F.col("n_convs") - 1) * F.col("words"))
    above = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    counted = staged(counted.withColumn("_above", F.coalesce(F.sum("_saved").over(above), F.lit(0))), "trie-counted")

    owners = counted.groupBy("conv_id").agg(
        F.sum("_saved").alias("owned"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    sums = subtree_sums(rebuilt, owners, rows_per_shard)
    lists = found.where("ends IS NOT NULL").select("key", "ends")
    ends = (lists.repartition("key").sortWithinPartitions("key", F.col("ends")[0])
            .mapInArrow(_hash_ends, "key binary, ends_sha256 string"))
    whole = counted.join(sums, "key").join(ends, "key", "left").select(
        "conv_id", "depth", "parent", "n_convs", "n_children", "n_leaves",
        (F.col("words_below") - F.col("_above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return whole.join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


# Prefixes are named by their joined digests here; owners and subtrees are joined on paths.
ORACLE_SQL = f"""
WITH read AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, digest, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos
  FROM (SELECT conv_id, turn, left(sha256(octet_length(encode(role)) || ':' || role || text), {DIGEST_HEX}) AS digest,
               len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM read) t),
convs AS (
  SELECT conv_id, conv_id - conv_id % {GROUP} AS base, {crc32_sql("conv_id::VARCHAR")} % {MOST_BORROWED + 1} AS h
  FROM (SELECT DISTINCT conv_id FROM turns) c),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.digest, t.words FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.digest, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
path AS (
  SELECT conv_id, row_number() OVER w AS depth, words, string_agg(digest, '') OVER w AS prefix FROM rebuilt
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS depth FROM path GROUP BY 1),
ended AS (
  SELECT prefix, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM path
  JOIN lengths USING (conv_id, depth) GROUP BY 1),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words FROM path GROUP BY ALL),
children AS (
  SELECT left(prefix, (depth - 1) * {DIGEST_HEX}) AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (prefix)),
below AS (
  SELECT p.prefix, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
  FROM counted v JOIN path p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, o.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM counted n JOIN below b USING (prefix) LEFT JOIN ended e USING (prefix)
LEFT JOIN nodes o ON n.depth > 0 AND o.prefix = left(n.prefix, (n.depth - 1) * {DIGEST_HEX})"""

ship_by_value(__name__)
