from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from llm_util import lower

from formweave.llm.arrays import slices
from formweave.llm.decontaminate import Passages, align, contaminated, find_passages, normal_form, remove_contaminated
from formweave.llm.queries import op5_decontamination

SMALL = "/root/testdata/sf0.001"


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", lower(text))


def edits(passage, text):
    """Fewest edits of the passage against any part of the text."""
    passage, text = (np.array([ord(c) for c in x]) for x in (passage, text))
    row, steps = np.zeros(len(text) + 1), np.arange(len(text) + 1)
    for c in passage:
        new = np.append(row[0] + 1, np.minimum(row[1:] + 1, row[:-1] + (text != c)))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def brute(documents, items):
    out = {}
    for d, text in documents:
        for i, passage in items:
            p = plain(passage).strip()
            budget = min(int(0.1 * len(p)), (len(p) - 7) // 7)
            e = edits(p, plain(text))
            if e <= budget:
                out[d, i] = e
    return out


def test_same_as_aligning_everything(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in documents.collect()][:120]
    rng = random.Random(3)
    for n in range(30):                    # edited passages inside other texts
        i, passage = rng.choice(items)
        for _ in range(rng.choice([0, 3, int(0.06 * len(passage)), int(0.12 * len(passage))])):
            at = rng.randrange(len(passage))
            passage = passage[:at] + rng.choice(["", "x", passage[at] + "e", "\n" + passage[at]]) + passage[at + 1:]
        host = rng.choice(rows[:120])[1]
        at = rng.randrange(len(host))
        rows.append((10_000 + n, host[:at] + passage.upper() + host[at:]))
    want = brute(rows, items)
    assert len({d for d, _ in want if d >= 10_000}) > 12
    got = contaminated(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3),
                       spark.createDataFrame(items, "item_id bigint, text string"), block_bytes=2000).collect()
    assert {(r.doc_id, r.item_id): r.edits for r in got} == want
    texts, passages = dict(rows), dict(items)
    for r in got:
        part = plain(texts[r.doc_id][r.start:r.end])
        assert edits(plain(passages[r.item_id]).strip(), part) == r.edits


def test_query_finds_every_verbatim_passage(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in op5_decontamination(spark, SMALL).collect()}
    assert got >= {(d.doc_id, i.item_id) for d in documents for i in items if i.text in d.text}


def test_align():
    a = np.array([ord(c) for c in "abcdefghij"], np.uint32)
    t = np.array([ord(c) for c in "xxabcdXefgijyy"], np.uint32)
    assert align(a, t, 0, 4, 2) == (2, 2, 12)
    assert align(a, t, 0, 4, 1) is None
    assert align(a, a[:5], 0, 2, 3) is None


def test_passage_at_the_segment_border():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)]
    passage = " ".join(rng.choice(words) for _ in range(40))
    filler = " ".join(rng.choice(words) for _ in range(30_000))
    index = Passages([1], [passage])
    for at in (65_300, 65_500, 65_536, 131_000):
        text = filler[:at] + " " + passage + " " + filler[at:]
        _, data, offsets = next(slices([pa.RecordBatch.from_arrays([pa.array(["x", text])], ["text"])]))
        assert find_passages(index, data, offsets) == [(1, 0, 0, at + 1, at + 1 + len(passage))]


def test_normal_form():
    _, data, offsets = next(slices([pa.RecordBatch.from_arrays([pa.array(["A\n\t É b", "", " ", " z"])], ["text"])]))
    code, bounds, origin = normal_form(data, offsets)
    assert ["".join(map(chr, code[a:b])) for a, b in zip(bounds, bounds[1:])] == ["a É b", "", " ", " z"]
    assert origin.tolist() == [0, 1, 4, 5, 6, 0, 0, 1]


def test_odd_rows(spark, odd_rows):
    clash = odd_rows.withColumnsRenamed({"node": "item_id", "score": "mark", "size": "start"})
    items = spark.createDataFrame([(1, "alpha3 alpha4 ALPHA5  alpha6 alpha7", 1), (None, "w7x7 w8x8 w9x9", 2), (3, None, 3), (4, "", 4),
                                   (5, "ab", 5), (5, "one two", 6)], "item_id int, text string, doc_id int")
    got = sorted(((r.doc_id, r.item_id) for r in contaminated(clash, items).collect()), key=str)
    assert got == sorted([(i, 1) for i in (1, 2, 2, 3, None)] + [(9, None), (10, None), (7, 5), (8, 5)], key=str)
    left = remove_contaminated(clash, items)
    assert left.columns == clash.columns
    assert sorted(r.doc_id for r in left.collect()) == [4, 5, 6, 11]
    assert contaminated(clash.limit(0), items).collect() == contaminated(clash, items.limit(0)).collect() == []
    assert remove_contaminated(clash, items.limit(0)).count() == clash.count()
