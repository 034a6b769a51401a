from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from llm_util import lower, tokens  # noqa: F401

from formweave.llm.components import connected_components
from formweave.llm.set_join import HASHES, SURE, _compare_nodes, link_sets, near_duplicates


def brute(rows, k):
    sets = {}
    for i, t in rows:
        w = tokens(t)
        sets[i] = {tuple(w[j:j + k]) for j in range(max(len(w) - k + 1, 1))} if w else set()
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_same_as_all_pairs(documents):
    want = brute([(r.doc_id, r.text) for r in documents.collect()], 4)
    assert len({c for _, c in want.values()}) < len(want)
    assert result(near_duplicates(documents, k=4)) == want


def test_large_nodes_and_clusters_give_the_same(documents):
    want = brute([(r.doc_id, r.text) for r in documents.collect()], 4)
    assert result(near_duplicates(documents, k=4, leaf_rows=2, block_rows=3)) == want


def test_odd_rows(spark, odd_rows):
    rows = near_duplicates(odd_rows, k=4).collect()
    assert len(rows) == odd_rows.count()
    got = {r.doc_id: r for r in rows}
    assert [got[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)] == [1, 1, 1, 4, 5, 6, 7, 7, 9, 9]
    assert [got[i].n_shingles for i in (4, 5, 6, 7)] == [0, 0, 0, 1]
    assert got[None].component_id is None and got[None].kept
    assert near_duplicates(odd_rows.limit(0)).collect() == []


def test_link_sets_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(30):
        base = rng.choice(200, 30, replace=False)
        sets = [np.unique(np.concatenate((base[rng.random(30) > 0.12], rng.integers(0, 200, 2)))).astype(np.uint64)
                for _ in range(25)]
        label = list(range(25))
        for i, j in itertools.combinations(range(25), 2):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                label = [label[i] if x == label[j] else x for x in label]
        mine = list(range(25))
        for i, j in link_sets(np.arange(25), sets, 80):
            mine = [mine[i] if x == mine[j] else x for x in mine]
        assert [label.index(x) for x in label] == [mine.index(x) for x in mine]


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 1), (7, 7), (None, 2), (8, 9)], "a bigint, b bigint")
    got = {r.id: r.component for r in connected_components(edges).collect()}
    assert got == {1: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8}
    assert connected_components(edges.limit(0)).collect() == []


def test_signatures_rule_out_no_pair_at_the_threshold():
    """Signatures of a pair at 0.8 that agree in 38 of 64 coordinates (one
    pair in ten thousand does so or worse) still propose it."""
    marks = np.arange(2 * HASHES, dtype=np.int32).reshape(2, HASHES)
    marks[1, :38] = marks[0, :38]
    lists = pa.ListArray.from_arrays(pa.array([0, HASHES, 2 * HASHES], pa.int32()), pa.array(marks.ravel()))
    rows = pa.RecordBatch.from_arrays([pa.array([1, 1]), pa.array([5, 6]), lists], ["node", "rep", "marks"])
    assert [e for b in _compare_nodes(iter([rows])) for e in zip(*b.to_pydict().values())] == [(5, 6)]
    missed = sum(math.comb(HASHES, i) * 0.8 ** i * 0.2 ** (HASHES - i) for i in range(math.ceil(SURE * HASHES)))
    assert missed < 2e-6
