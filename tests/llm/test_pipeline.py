from __future__ import annotations

from collections import defaultdict

import pytest
from llm_util import WORD
from test_mixing import shares
from test_set_join import brute

import corpus_pipeline
from formweave.llm.queries import op2_toxicity

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SMALL).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes
        rows = df.collect()
        assert len({r.doc_id for r in rows}) == len(rows) and all(r.n_chars == len(r.text) for r in rows)


def test_toxic_documents_go_and_others_stay(spark, steps):
    toxic = {r.doc_id for r in op2_toxicity(spark, SMALL).collect() if r.predicted == 1}
    before, after = texts(steps[0]), texts(steps[1])
    assert toxic and after == {i: t for i, t in before.items() if i not in toxic}


def test_line_dedup_only_takes_lines(steps):
    before, after = texts(steps[1]), texts(steps[2])
    changed = {i for i in before if after.get(i) != before[i]}
    assert changed and len(changed) < len(before) / 2
    for i in changed:
        left = iter(before[i].split("\n"))
        assert all(line in left for line in after.get(i, before[i].split("\n")[0]).split("\n"))


def test_one_of_each_near_group_stays(steps):
    before, after = texts(steps[2]), texts(steps[3])
    assert after == {i: before[i] for i, (_, c) in brute(before.items(), 5).items() if i == c}
    assert len(after) < len(before)


def test_no_passage_is_left(spark, steps):
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before, after = texts(steps[3]), texts(steps[4])
    held = {i for i, t in before.items() if any(x in t for x in items)}
    assert held and not held & set(after)
    assert len(before) - len(after) <= len(held) + 3


def test_mix(spark, steps):
    size, source = defaultdict(int), {}
    for r in steps[4].collect():
        size[r.source] += len(WORD.findall(r.text))
        source[r.doc_id] = r.source
    want, taken = shares(size), defaultdict(int)
    for r in steps[5].collect():
        assert r.size == len(WORD.findall(r.text)) and 0 < r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in size)
    again = sorted((r.doc_id, r.taken) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert again == sorted((r.doc_id, r.taken) for r in steps[5].collect())


def test_odd_rows(spark, odd_rows):
    docs = odd_rows.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[1:]:
        stage(spark, docs.limit(0), SMALL).collect()
        rows = stage(spark, docs, SMALL).collect()
        assert {1, 7} <= {r.doc_id for r in rows} if stage is not corpus_pipeline.mixing else rows
    kept = corpus_pipeline.near_dedup(spark, docs, SMALL).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["1", "4", "5", "6", "7", "9", "11", "None"])
