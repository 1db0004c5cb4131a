"""Best-fit packing of documents into fixed-size sequences, under conflicts.

Documents are dealt by hash into shards of about ``rows_per_shard`` rows; every shard is
packed on its own, largest piece first. Bins are kept in order of residual room and carry two
bitmaps, the sources and the duplicate clusters they hold. A piece goes to the bin with the
least room that fits; while that bin holds its source or cluster the search goes on to the
successor, so the bin found is the tightest compatible one, or else a new one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.common import ship_by_value, table, word_count

CAPACITY = 2048
ROWS_PER_SHARD = 4000


class Bins:
    """Open bins in ascending order of residual room, with source and cluster bitmaps."""

    def __init__(self, capacity: int, sources: int) -> None:
        self.capacity = capacity
        self.room = np.zeros(1024, dtype=np.int64)   # ascending; the first `count` are in use
        self.order = np.zeros(1024, dtype=np.int64)  # bin of each room
        self.count = 0
        self.total = 0
        self.sources = np.zeros((1024, sources // 64 + 1), dtype=np.uint64)
        self.clusters: list[int] = []
        self.held: list[int] = []

    def _new(self) -> int:
        if self.total == len(self.sources):
            self.sources = np.concatenate((self.sources, np.zeros_like(self.sources)))
        self.clusters.append(0)
        self.held.append(0)
        self.total += 1
        return self.total - 1

    def _settle(self, at: int, bin_: int, room: int) -> None:
        """Put a bin at its place by room; ``at``: where it stood, or the end if it is new."""
        to = int(np.searchsorted(self.room[:at], room))
        self.room[to + 1:at + 1] = self.room[to:at].copy()
        self.order[to + 1:at + 1] = self.order[to:at].copy()
        self.room[to], self.order[to] = room, bin_

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, position in it) of a piece; ``cluster`` -1: it conflicts with no other."""
        word, bit = source // 64, np.uint64(1 << source % 64)
        start = int(np.searchsorted(self.room[:self.count], size))
        free = np.flatnonzero((self.sources[self.order[start:self.count], word] & bit) == 0)
        found = -1
        for k in free:
            if cluster < 0 or not self.clusters[self.order[start + k]] >> cluster & 1:
                found = start + int(k)
                break
        if found < 0:
            if self.count == len(self.room):
                self.room = np.concatenate((self.room, np.zeros_like(self.room)))
                self.order = np.concatenate((self.order, np.zeros_like(self.order)))
            bin_, found, room = self._new(), self.count, self.capacity
            self.count += 1
        else:
            bin_, room = int(self.order[found]), int(self.room[found])
        self._settle(found, bin_, room - size)
        self.sources[bin_, word] |= bit
        if cluster >= 0:
            self.clusters[bin_] |= 1 << cluster
        self.held[bin_] += 1
        return bin_, self.held[bin_] - 1

    def full(self) -> int:
        """A bin that one whole piece fills."""
        bin_ = self._new()
        self.held[bin_] = 1
        return bin_


PACKED = ("bin_id bigint, position int, doc_id bigint, part int, start_word bigint, n_words bigint, source string, "
          "bin_words bigint")


def _pack_shard(capacity: int):
    def pack(shard: pa.Table) -> pa.Table:
        number = shard.column("shard")[0].as_py()
        ids, sizes = shard.column("id").to_pylist(), shard.column("size").to_pylist()
        sources = shard.column("source").to_pylist()
        clusters, times = np.unique(shard.column("cluster").to_numpy(), return_counts=True)
        repeated = {int(c): k for k, c in enumerate(clusters[times > 1])}
        cluster = [repeated.get(c, -1) for c in shard.column("cluster").to_pylist()]
        names = {s: k for k, s in enumerate(sorted(set(sources), key=lambda s: (s is None, s or "")))}
        bins = Bins(capacity, len(names))
        out = []  # (bin, position, row, part, start, words)
        rest = []
        for k, size in enumerate(sizes):
            whole, left = divmod(size, capacity)
            out += [(bins.full(), 0, k, part, part * capacity, capacity) for part in range(whole)]
            if left:
                rest.append((-left, ids[k] is None, ids[k] or 0, cluster[k], k, whole))
        for negative, _, _, group, k, part in sorted(rest):
            bin_, position = bins.place(-negative, names[sources[k]], group)
            out.append((bin_, position, k, part, part * capacity, -negative))
        words = np.zeros(bins.total + 1, dtype=np.int64)
        for bin_, _, _, _, _, n in out:
            words[bin_] += n
        first = number << 32
        empty = [k for k, size in enumerate(sizes) if not size]
        columns = list(zip(*[(first + b, position, ids[k], part, start, n, sources[k], int(words[b]))
                             for b, position, k, part, start, n in out],
                           *[(None, None, ids[k], 0, 0, 0, sources[k], None) for k in empty], strict=True))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64())
        fields = ("bin_id", "position", "doc_id", "part", "start_word", "n_words", "source", "bin_words")
        return pa.table({f: pa.array(c, t) for f, c, t in zip(fields, columns, kinds, strict=True)})
    return pack


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         cluster_col: str | None = None, capacity: int = CAPACITY,
         rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """One row per piece: ``bin_id, position, doc_id, part, start_word, n_words, source,
    bin_words``.

    A document longer than ``capacity`` words is cut into whole pieces, which fill a bin each,
    and a last one, which is packed. No bin holds two pieces of one source or of one duplicate
    cluster (``cluster_col``; by default equal texts). Null and blank texts have no words and
    get one row with null bin; a null source is a source of its own; rows without an id or
    that repeat one are packed like others; an empty table gives no rows.
    """
    shards = max(1, math.ceil(docs.count() / rows_per_shard))
    cluster = F.col(cluster_col) if cluster_col else F.xxhash64(text_col)
    items = docs.select(F.col(id_col).cast("long").alias("id"), word_count(F.col(text_col)).alias("size"),
                        F.col(source_col).cast("string").alias("source"),
                        F.coalesce(cluster.cast("long"), F.lit(0)).alias("cluster"),
                        F.pmod(F.xxhash64(F.lit("pack"), F.col(id_col), F.col(text_col)), F.lit(shards)).alias("shard"))
    return items.groupBy("shard").applyInArrow(_pack_shard(capacity), PACKED)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


ship_by_value(__name__)
