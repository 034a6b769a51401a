from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from formweave.llm.prefix_trie import PRIME, placed_turns, prefix_trie
from formweave.llm.slot_table import SlotTable
from formweave.session import work_dir

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    """All nodes by plain dictionaries of turn tuples."""
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        head = own.get(c - (abs(c) % 100) * (1 if c >= 0 else -1), [])
        rebuilt[c] = head[:h] + own[c][h:]
    members, kids = {}, {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        below = kids.get(k, [])
        leaves[k] = sum(leaves[c] for c in below) if below else 1
        saved[k] = sum(saved[c] for c in below) + ((len(members[k]) - 1) * len(k[-1][1]) if k else 0)
    return sorted([(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids.get(k, [])), leaves[k], saved[k],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(k)).encode()).hexdigest())
                   for k, m in members.items()], key=str)


def nodes(df, **options):
    return sorted([tuple(r) for r in prefix_trie(df, **options).collect()], key=str)


def odd_conversations():
    rng = random.Random(1)
    rows = []
    for c in range(300):
        if c == 200:
            continue            # heads of 201 .. 299 are absent
        for t in range(rng.choice([1, 2, 3, 5, 8]) if c % 100 else rng.choice([1, 4, 7])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "hello", ""])))
    rows += [(5, None, None, None)] * 30                                       # ties, nulls, repeats
    rows += [(c, i, "u", f"x{i % 3}") for c in (7, 8) for i in range(500)]     # hot conversations, alike to the end
    rows += [(None, 1, "u", "z"), (-3, 1, "u", "q"), (-103, 2, "é", "ü"), (9, 99, "u", "long " * 100_000)]
    return rows


@pytest.mark.parametrize("options", [
    {}, {"shard_nodes": 20, "range_rows": 100, "block_turns": 7}, {"shard_nodes": 3, "range_rows": 50, "block_turns": 1}])
def test_nodes_equal_brute_force_whatever_the_shards(spark, options):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as depth", "'x' as mark", "2 as level", "3 as frag")
    assert nodes(df, **options) == brute(rows)


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert nodes(df) == brute(rows)


def test_no_conversations(spark):
    assert nodes(spark.createDataFrame([], SCHEMA)) == []
    assert nodes(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []


def test_places_and_digests_carry_over_ranges(spark):
    rows = [(c, t, "u", f"t{t}") for c in (1, 2) for t in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    one = sorted(map(tuple, placed_turns(df, work_dir(spark, "one"), 1000).collect()))
    many = sorted(map(tuple, placed_turns(df, work_dir(spark, "many"), 7).collect()))
    assert one == many and [r[1] for r in many] == list(range(1, 41)) * 2
    assert all(int.from_bytes(r[3], "big") < PRIME for r in many)


def test_slot_table_is_minimal_and_verified():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    keys[1::2, 0] = keys[::2, 0]                        # halves may agree, keys do not
    table = SlotTable(keys)
    assert sorted(table.slots(keys)) == list(range(5000))
    foreign = rng.integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    assert (table.slots(foreign) == -1).all()
    assert len(SlotTable(keys[:0]).slots(foreign)) == 5000
    with pytest.raises(ValueError):
        SlotTable(keys[[0, 0]])
