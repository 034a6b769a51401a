from __future__ import annotations

import math
from collections import defaultdict

import duckdb
import pytest
from llm_util import WORD
from pyspark.sql import functions as F

from formweave.llm import mixing
from formweave.llm.mixing import mix_sources, source_targets, sums_before
from formweave.llm.queries import ORACLES, op7_mix

SMALL = "/root/testdata/sf0.001"


def shares(sizes):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, capped = {}, set()
    left = 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in capped]
        rest = left - sum(2 * sizes[s] for s in capped)
        target = {s: 2 * sizes[s] if s in capped else rest * weight[s] / sum(weight[x] for x in open_) for s in order}
        over = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


def check(df, rows):
    sizes, docs = defaultdict(int), defaultdict(list)
    for doc_id, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
        docs[doc_id].append((len(WORD.findall(text or "")), source))
    want = shares(sizes)
    got = df.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((i is None, i or 0, n) for i in docs for n, _ in docs[i])
    taken = defaultdict(int)
    for r in got:
        (source,) = {s for n, s in docs[r.doc_id] if n == r.size and sizes[s] == r.source_size}
        assert math.isclose(r.target, want[source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    return got


def rows_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]


def test_query(spark, documents):
    first = check(op7_mix(spark, SMALL), rows_of(documents))
    assert sorted(first) == sorted(op7_mix(spark, SMALL).collect())


def test_many_ranges_give_the_same(documents, monkeypatch):
    one = sorted(mix_sources(documents).collect())
    monkeypatch.setattr(mixing, "RANGE_ROWS", 9)
    assert sorted(mix_sources(documents.repartition(6)).collect()) == one


def test_oracle_agrees(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want = con.execute(ORACLES["op7_mix"])
    names = [d[0] for d in want.description]
    df = op7_mix(spark, SMALL)
    assert sorted(names) == sorted(df.columns)
    assert sorted(want.fetchall()) == sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1, None: 50}, {"a": 0, "b": 0}, {"a": 5}, {None: 7, "é": 0, "z": 900}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in source_targets(df).collect()}
    want = shares(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


def test_heavier_documents_come_first(spark):
    df = spark.createDataFrame([(i, "a b", "s" if i % 2 else "t", 10.0 if i % 4 < 2 else 0.1) for i in range(2000)],
                               "doc_id bigint, text string, source string, good double")
    taken = mix_sources(df, F.col("good"), weights=(1, 1), share=0.6).join(df, "doc_id").groupBy("good").agg(F.sum("taken").alias("n"))
    n = {r.good: r.n for r in taken.collect()}
    assert n[10.0] > 3 * n[0.1]


def test_sums_before(spark):
    df = spark.range(50).select((F.col("id") % 3).alias("g"), "id")
    got = sums_before(df, [F.col("g"), F.col("id")], {"s": F.col("id")}, by="g", parts=7).collect()
    assert {r.id: r.s for r in got} == {i: sum(range(i % 3, i, 3)) for i in range(50)}


def test_odd_rows(spark, odd_rows):
    rows = rows_of(odd_rows)
    check(mix_sources(odd_rows), rows)
    assert mix_sources(odd_rows.limit(0)).collect() == []
    some = odd_rows.withColumn("source", F.when(F.col("doc_id") > 5, "s"))
    check(mix_sources(some, F.when(F.col("doc_id") == 2, F.lit(-1.0))), rows_of(some))
