"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs, each hashed to a digest, and every digest is entered into three
cells of a block of 32 (count, xor of digests, xor of checks); the number of blocks grows with
the paragraphs. Two sketches are subtracted cell by cell, and cells that hold a single
digest are peeled until nothing is left, which yields exactly the digests that differ. Blocks
where peeling gets stuck are tried again: the digests of those blocks alone are entered into
new sketches with another seed and more cells a digest, until every block is peeled.

Everything about one document is row-wise SQL on arrays. Digests are dealt to blocks by one
sort and each block has a fixed size, so long texts cost time in proportion to their paragraphs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelake.llm.common import staged, table

# A paragraph ends at a line end, or at the first sentence end from this many characters on.
MIN_PARAGRAPH = 240
PARAGRAPHS = rf"[^\n]{{{MIN_PARAGRAPH},}}?[.!?](?=[\x20\n]|\z)|[^\n]+"
CELLS = 32
THIRDS = ((0, 11), (11, 11), (22, 10))  # first cell and number of cells of each of the three hashes
ROUNDS = 32
PARAGRAPHS_PER_BLOCK = 12
# Retries have blocks for that many paragraphs of both texts. A try leaves fewer than one block in
# a hundred, so two or three are used; the job fails rather than pass over a block that all leave.
RETRY_PER_BLOCK = 4
RETRIES = 24
# Ranges of ids that the search for the next document works on: about this many rows each.
ROWS_PER_RANGE = 4000
FINE_BINS = 65_536

ZERO = "named_struct('n', 0, 'k', 0L, 'h', 0L)"


def paragraph_digests(text: Column) -> Column:
    """Distinct 64-bit digests of the non-blank paragraphs."""
    found = F.filter(F.regexp_extract_all(text, F.lit(PARAGRAPHS), F.lit(0)), lambda p: F.trim(p) != "")
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(p)))


def _blocks(keys: str, per_block: int) -> str:
    """Power of two: blocks for that many paragraphs."""
    return f"cast(shiftleft(1, cast(ceil(log2(greatest(1.0D, {keys} / {float(per_block)}D))) AS int)) AS int)"


def _once(value: str, name: str, use: str) -> str:
    """``use`` with ``name`` bound to a value that is computed once."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def _block_of(key: str, blocks: str, seed: str) -> str:
    return f"cast(pmod(xxhash64({key}, {seed}), {blocks}) AS int)"


def _cells_of(key: str, seed: str) -> str:
    return ", ".join(f"'c{i}', cast({first} + pmod(shiftright(xxhash64({key}, {seed}), {20 + 12 * i}), {size}) AS int)"
                     for i, (first, size) in enumerate(THIRDS))


def _dealt(keys: str, blocks: str, seed: str) -> str:
    """Entries of digests (block, cells and check) by block. They are sorted together with one
    mark for the head of each block and cut at the marks."""
    entries = (f"transform({keys}, k -> named_struct('b', {_block_of('k', blocks, seed)}, 'own', 1, 'k', k, "
               f"'h', xxhash64(k, 77), {_cells_of('k', seed)}))")
    marks = (f"transform(sequence(0, {blocks} - 1), b -> named_struct('b', b, 'own', 0, 'k', 0L, 'h', 0L, "
             f"'c0', -1, 'c1', -1, 'c2', -1))")
    cut = ("transform(heads, (p, j) -> slice(sorted, p + 1, coalesce(get(heads, j + 1), size(sorted) + 1) - p - 1))")
    heads = "filter(sequence(1, size(sorted)), i -> get(sorted, i - 1).own = 0)"
    return (f"CASE WHEN {blocks} = 1 THEN array({entries}) ELSE "
            f"{_once(f'sort_array(concat({entries}, {marks}))', 'sorted', _once(heads, 'heads', cut))} END")


def _hit(e: str, c: str) -> str:
    return f"({e}.c0 = {c} OR {e}.c1 = {c} OR {e}.c2 = {c})"


def _sketch(keys: str, blocks: str, seed: str) -> str:
    """Blocks of cells."""
    cell = (f"aggregate(filter(own, e -> {_hit('e', 'c')}), {ZERO}, "
            f"(a, e) -> named_struct('n', a.n + 1, 'k', a.k ^ e.k, 'h', a.h ^ e.h))")
    return f"transform({_dealt(keys, blocks, seed)}, own -> transform(sequence(0, {CELLS - 1}), c -> {cell}))"


def _folded(sketch: str, blocks: str) -> str:
    """The sketch with fewer blocks: a block is the sum of those with its number modulo blocks."""
    add = "named_struct('n', x.n + y.n, 'k', x.k ^ y.k, 'h', x.h ^ y.h)"
    return (f"CASE WHEN size({sketch}) = {blocks} THEN {sketch} ELSE transform(sequence(0, {blocks} - 1), j -> "
            f"aggregate(sequence(j, size({sketch}) - 1, {blocks}), array_repeat({ZERO}, {CELLS}), "
            f"(s, i) -> zip_with(s, get({sketch}, i), (x, y) -> {add}))) END")


def _peeled(a: str, b: str, seed: str) -> str:
    """Subtract and peel: per block struct(pos, neg, left), the numbers of digests in one sketch
    only, ``left`` true where peeling got stuck."""
    pure = (f"array_distinct(transform(filter(s.cells, x -> abs(x.n) = 1 AND x.h = xxhash64(x.k, 77)), "
            f"x -> named_struct('k', x.k, 'n', x.n, 'h', x.h, {_cells_of('x.k', seed)})))")
    out = (f"named_struct('cells', transform(s.cells, (x, c) -> aggregate(filter(p, e -> {_hit('e', 'c')}), x, "
           "(y, e) -> named_struct('n', y.n - e.n, 'k', y.k ^ e.k, 'h', y.h ^ e.h))), "
           "'pos', s.pos + cast(size(filter(p, e -> e.n = 1)) AS bigint), "
           "'neg', s.neg + cast(size(filter(p, e -> e.n = -1)) AS bigint), 'go', size(p) > 0)")
    step = f"CASE WHEN NOT s.go THEN s ELSE {_once(pure, 'p', out)} END"
    start = ("named_struct('cells', zip_with(u, v, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, "
             "'h', x.h ^ y.h)), 'pos', 0L, 'neg', 0L, 'go', true)")
    block = (f"aggregate(sequence(1, {ROUNDS}), {start}, (s, r) -> {step}, s -> named_struct('pos', s.pos, "
             "'neg', s.neg, 'left', exists(s.cells, x -> x.n <> 0 OR x.k <> 0L)))")
    return f"zip_with({a}, {b}, (u, v) -> {block})"


def _settled(diffs: str, keys_a: str, keys_b: str, seed: str, pos: str, neg: str) -> str:
    """State after a try: what its peeled blocks add, and the digests of its stuck blocks."""
    def left(keys: str) -> str:
        return f"filter({keys}, k -> get({diffs}, {_block_of('k', f'size({diffs})', seed)}).left)"

    def found(side: str) -> str:
        return f"aggregate({diffs}, 0L, (n, x) -> n + IF(x.left, 0L, x.{side}))"
    stuck = f"exists({diffs}, x -> x.left)"
    none = "cast(array() AS array<bigint>)"
    return (f"named_struct('a', IF({stuck}, {left(keys_a)}, {none}), 'b', IF({stuck}, {left(keys_b)}, {none}), "
            f"'pos', {pos} + {found('pos')}, 'neg', {neg} + {found('neg')}, 'stuck', {stuck})")


def _retried(state: str) -> str:
    """The state after tries with new seeds, until no block is stuck."""
    blocks = _blocks("(size(t.a) + size(t.b))", RETRY_PER_BLOCK)
    diffs = _peeled(_sketch("t.a", "w", "q"), _sketch("t.b", "w", "q"), "q")
    step = _once(blocks, "w", _once(diffs, "d", _settled("d", "t.a", "t.b", "q", "t.pos", "t.neg")))
    return (f"CASE WHEN NOT {state}.stuck THEN {state} ELSE aggregate(sequence(1, {RETRIES}), {state}, "
            f"(t, q) -> CASE WHEN t.stuck THEN {step} ELSE t END) END")


def _written(sketch: str, keys: str) -> str:
    """Paragraph count, number of blocks, then the cells in order; an empty cell is a dash."""
    cell = ("CASE WHEN x.n = 0 AND x.k = 0L THEN '-' ELSE concat(x.n, '.', lower(hex(x.k)), '.', "
            "lower(hex(x.h))) END")
    return f"concat(size({keys}), ':', size({sketch}), ':', array_join(transform(flatten({sketch}), x -> {cell}), ','))"


def with_sketch(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the digests ``k_<name>`` of a text column and their sketch ``s_<name>``."""
    keys, blocks = f"k_{name}", f"b_{name}"
    df = df.withColumn(keys, paragraph_digests(F.col(text)))
    df = df.withColumn(blocks, F.expr(_blocks(f"size({keys})", PARAGRAPHS_PER_BLOCK)))
    return df.withColumn(f"s_{name}", F.expr(_sketch(keys, blocks, "0")))


def with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Add the Jaccard likeness of two texts' paragraph sets, from their sketches alone: the
    counts and the recovered differences. Two empty sets are alike (1)."""
    fold = f"least(b_{a}, b_{b})"
    df = df.withColumn("_diffs", F.expr(_peeled(_folded(f"s_{a}", fold), _folded(f"s_{b}", fold), "0")))
    df = df.withColumn("_first", F.expr(_settled("_diffs", f"k_{a}", f"k_{b}", "0", "0L", "0L")))
    df = df.withColumn("_diff", F.expr(_retried("_first")))
    union = f"(size(k_{a}) + _diff.neg)"
    same = f"(size(k_{a}) - _diff.pos)"
    return df.withColumn(out, F.expr(
        f"CASE WHEN _diff.stuck THEN cast(raise_error('sketches not peeled after {RETRIES} tries') AS double) "
        f"WHEN {union} = 0 THEN 1.0D ELSE cast({same} AS double) / {union} END")).drop("_diffs", "_first", "_diff")


def with_next_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(doc_id, text, next_text): the text of the next document by id, the first's for the last.

    Ids are counted in ``FINE_BINS`` equal ranges, neighbouring ranges are joined to about
    ``rows_per_range`` rows, and each is ordered on its own with the first document of the
    range after it as guest. So texts are shuffled once and no task holds more than a range.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ends = base.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = (0, 0) if ends[0] is None else ends
    width = max(1, -(-(high - low + 1) // FINE_BINS))
    fine = F.coalesce(F.floor((F.col("doc_id") - low) / width).cast("int"), F.lit(-1))
    bins = base.groupBy(fine.alias("_fine")).agg(F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("_least"))
    before = Window.orderBy("_fine").rowsBetween(Window.unboundedPreceding, -1)
    ranges = staged(bins.withColumn("_range", F.floor(
        F.coalesce(F.sum("_n").over(before), F.lit(0)) / rows_per_range).cast("long")), "ranges")  # FINE_BINS rows at most
    starts = ranges.groupBy("_range").agg(F.min("_least").alias("_first")).where("_first IS NOT NULL")
    everywhere = Window.partitionBy(F.lit(1))
    guests = starts.select(F.col("_first"), F.coalesce(F.lag("_range").over(Window.orderBy("_range")),
                                                       F.max("_range").over(everywhere)).alias("_range"))
    ranged = base.withColumn("_fine", fine).join(F.broadcast(ranges.select("_fine", "_range")), "_fine")
    hosts = ranged.select("_range", "doc_id", "text", F.lit(False).alias("_guest"))
    visit = base.join(F.broadcast(guests), F.col("doc_id") == F.col("_first"))
    visit = visit.groupBy("_range", "doc_id").agg(F.min("text").alias("text"))  # one row where an id repeats
    rows = hosts.unionByName(visit.withColumn("_guest", F.lit(True)))
    order = Window.partitionBy("_range").orderBy("_guest", "doc_id", "text")
    led = rows.withColumn("next_text", F.coalesce(F.lead("text").over(order), F.lit("")))
    return led.where("NOT _guest").select("doc_id", "text", "next_text")


def op7_paragraph_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text. Null texts are empty; rows
    without an id come first in order; rows that repeat an id follow each other by text; an
    empty table gives no rows."""
    rows = with_next_text(table(spark, sf_dir, "documents"))
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("half", F.expr("cast(n_chars DIV 2 AS int)"))
    rows = rows.withColumn("edited", F.expr(
        "concat(substring(text, 1, cast(n_chars AS int) - half), substring(next_text, 1, half))"))
    for name, text in (("text", "text"), ("edited", "edited"), ("next", "next_text")):
        rows = with_sketch(rows, text, name)
    rows = with_likeness(rows, "text", "edited", "near_edited")
    rows = with_likeness(rows, "text", "next", "near_next")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       F.expr(_written("s_text", "k_text")).alias("fingerprint"),
                       F.expr(_written("s_edited", "k_edited")).alias("edited_fingerprint"),
                       "near_edited", "near_next")
