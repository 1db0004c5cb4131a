import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hirelake.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def by_hand(rows):
    """The contract in plain Python: prefixes as tuples of (role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x[2] for x in sorted(turns)] for c, turns in own.items()}
    built = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - conv % 20 if conv >= 0 else conv + -conv % 20
        built[conv] = tuple(own.get(base, [])[:h] + own[conv][h:])
    members, children = defaultdict(list), defaultdict(set)
    for conv in sorted(built):
        for d in range(len(built[conv]) + 1):
            members[built[conv][:d]].append(conv)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].add(prefix)
    saved, leaves, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in children[p])
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        ends = ",".join(str(c) for c in members[p] if len(built[c]) == len(p))
        out.append((members[p][0], len(p), members[p[:-1]][0] if p else None, len(members[p]), len(children[p]),
                    leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def drawn(seed, n=120):
    draw = random.Random(seed)
    rows = []
    for conv in draw.sample(range(-30, 300), n):
        turns = [(draw.choice("ua"), draw.choice(["hi", "hi you", "", "a  b\tc", "ü"])) for _ in range(draw.randint(1, 6))]
        if draw.random() < 0.3:
            turns = [("u", "hi"), ("a", "one two three"), ("u", "bye")]
        rows += [(conv, t, *turn) for t, turn in enumerate(turns)]
    return rows


@pytest.mark.parametrize("shard", [3, 50, 20_000])
def test_equals_plain_trie(spark, shard):
    rows = drawn(shard)
    # one conversation far longer than a shard, a copy of its start, and awkward rows
    rows += [(1000, t, "u", f"turn {t % 7}") for t in range(70)] + [(1003, t, "u", f"turn {t % 7}") for t in range(40)]
    rows += [(None, 0, "u", "no conversation"), (2000, None, None, "first"), (2000, 1, "u", None), (2000, 1, None, None),
             (2001, 1, "a", "tie"), (2001, 1, "a", "tie"), (2001, 1, "u", "tie"), (2020, None, None, None)]
    random.Random(1).shuffle(rows)
    got = pt.prefix_trie(spark.createDataFrame(rows, SCHEMA), rows_per_shard=shard)
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(rows)


def test_turnless_conversation_is_a_member_of_the_root_only(spark):
    turnless = next(c for c in range(21, 39) if zlib.crc32(str(c).encode()) % 4 >= 1)
    rows = pt.prefix_trie(spark.createDataFrame([(turnless, 0, "u", "lost")], SCHEMA)).collect()
    assert [tuple(r)[:7] for r in rows] == [(turnless, 0, None, 1, 0, 1, 0)]
    assert rows[0].ends_sha256 == hashlib.sha256(str(turnless).encode()).hexdigest()


def test_hot_first_turn_and_copies(spark):
    rows = [(c, 0, "s", "the same start") for c in range(600)] + [(c, 1, "u", f"own {c}" if c % 3 else "copy") for c in range(600)]
    got = pt.prefix_trie(spark.createDataFrame(rows, SCHEMA), rows_per_shard=100)
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(rows)


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pt.prefix_trie(empty).collect() == []
    rows = drawn(5, 30)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("x") for c in ("pos", "digest", "words", "depth", "key", "parent", "base", "h", "n", "ends", "_turn")})
    assert sorted(map(tuple, pt.prefix_trie(frame).collect()), key=repr) == by_hand(rows)
