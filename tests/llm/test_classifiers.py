from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from formweave.llm import quality, toxicity
from formweave.llm.queries import op1_quality, op2_toxicity
from formweave.llm.quality import quality_scores
from formweave.llm.toxicity import toxicity_scores

MEDIUM = "/root/testdata/sf0.01"


def fold(i, modulus):
    return zlib.crc32(str(i).encode()) % modulus


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable"))
    pos, neg = (label == 1).sum(), (label == 0).sum()
    return (order[label == 1].sum() - pos * (pos - 1) / 2) / (pos * neg)


@pytest.mark.parametrize("query, column, modulus, remainder, threshold", [
    (op1_quality, "quality", 5, 0, 0.3), (op2_toxicity, "toxic", 3, 1, 0.7)])
def test_held_out_accuracy(spark, query, column, modulus, remainder, threshold):
    rows = query(spark, MEDIUM).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    same = {}
    for r in rows:
        assert r.held_out == (fold(r.doc_id, modulus) == remainder)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
        assert abs(same.setdefault(texts[r.doc_id], r.score) - r.score) < 1e-5   # only the text counts
    unseen = [r for r in rows if r.held_out and r.doc_id in labels]
    score, label = np.array([r.score for r in unseen]), np.array([labels[r.doc_id] for r in unseen])
    assert auc(score, label) > 0.93
    assert ((score >= threshold) == label).mean() > 0.93


def numeric(loss, array, at, step=1e-3):
    held = array[at]
    array[at] = held + step
    high = loss()
    array[at] = held - step
    low = loss()
    array[at] = held
    return (high - low) / (2 * step)


def test_convolution_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in quality.start_parameters().items()}
    data = rng.integers(0, 256, 900).astype(np.uint8)
    offsets, label, weight = np.array([0, 0, 5, 600, 900]), np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 1])
    _, grads = quality.gradients(p, data, offsets, label, weight)
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        want = numeric(lambda: quality.gradients(p, data, offsets, label, weight)[0], p[name], at, 1e-4)
        assert abs(g[at] - want) < 0.02 * abs(want) + 1e-4, name


def test_chunks_cover_every_position():
    rng = np.random.default_rng(1)
    size = [0, 1, 4, 5, 63, 64, 65, 255, 256, 257, 5000]
    offsets = np.cumsum([0, *size])
    padded, unused, chunks, first = quality.layout(rng.integers(1, 256, offsets[-1]).astype(np.uint8), offsets)
    used = set(np.flatnonzero(padded.reshape(-1, quality.UNIT).any(axis=1)) // quality.BLOCK)
    assert used <= set(chunks.ravel())
    for i in range(len(size)):
        mine = chunks[first[i]:first[i + 1]]
        assert all(set(a) & set(b) for a, b in zip(mine, mine[1:]))


def test_recurrent_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in toxicity.start_parameters().items()}
    x, label = rng.standard_normal((7, 5, toxicity.INPUTS)), np.array([1.0, 0, 1, 0, 1])
    mask = np.arange(7)[:, None] < np.array([7, 3, 1, 0, 5])
    x = x * mask[:, :, None]

    def loss():
        s = toxicity.sigmoid(toxicity.forward(p, x, mask))
        return -(label * np.log(s) + (1 - label) * np.log(1 - s)).sum()

    keep = {}
    grads = toxicity.backward(p, keep, toxicity.sigmoid(toxicity.forward(p, x, mask, keep)) - label)
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        want = numeric(loss, p[name], at, 1e-5)
        assert abs(g[at] - want) < 1e-3 * abs(want) + 1e-6, name


def test_windows_cover_all_words():
    start, length, begin = toxicity.windows(np.cumsum([0, 0, 1, 48, 49, 84, 85, 400]))
    for n, lo, hi, first in zip([0, 1, 48, 49, 84, 85, 400], begin, begin[1:], np.cumsum([0, 0, 1, 48, 49, 84, 85])):
        assert start[lo] == first and start[hi - 1] + length[hi - 1] == first + n
        assert all(start[i + 1] < start[i] + length[i] for i in range(lo, hi - 1))


def test_a_toxic_word_anywhere_in_a_long_text_counts():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(300)]

    def text(n, bad):
        w = [vocabulary[i] for i in rng.integers(0, 300, n)]
        for k in range(bad):
            w[rng.integers(0, n)] = ["vileword", "foulword,", "VILEWORD!"][k % 3]
        return " ".join(w)

    train = [text(120, 3 * (i % 2)) for i in range(200)]
    model = toxicity.train(pa.array(train), np.arange(200) % 2.0)
    asked = [text(2000, 0) + " vileword" * 2 + " " + text(2000, 0), text(4000, 0), ""]
    _, data, offsets = next(toxicity.slices([pa.RecordBatch.from_arrays([pa.array(asked)], ["text"])]))
    score = toxicity.score_texts(model, data, offsets)
    assert score[0] > 0.7 > score[1] and 0 <= score[2] <= 1


@pytest.mark.parametrize("scores, column", [(quality_scores, "quality"), (toxicity_scores, "toxic")])
def test_odd_rows(spark, odd_rows, scores, column):
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (4, 0, 0), (9, None, 1), (None, 1, 1), (7, 3, 1), (99, 0, 0)],
                                   "doc_id bigint, quality int, toxic int")
    for held in (F.col("doc_id") == 2, F.lit(None).cast("boolean"), F.lit(True)):
        rows = scores(odd_rows, labels, held).collect()
        assert len(rows) == odd_rows.count()
        assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
        assert len({round(r.score, 6) for r in rows if r.doc_id in (4, 5)}) == 1
    assert scores(odd_rows.limit(0), labels, F.lit(False)).collect() == []
    assert len(scores(odd_rows, labels.limit(0), F.lit(False)).collect()) == odd_rows.count()


def peak_mb(call):
    tracemalloc.start()
    try:
        out = call()
        return out, tracemalloc.get_traced_memory()[1] / (1 << 20)
    finally:
        tracemalloc.stop()


def long_text(n_bytes, seed=3):
    rng = np.random.default_rng(seed)
    letters = rng.integers(97, 123, n_bytes).astype(np.uint8)
    spaces = np.cumsum(rng.integers(2, 9, n_bytes // 2))
    letters[spaces[spaces < n_bytes]] = 0x20
    return letters


def test_blocks_of_a_huge_text_are_pooled_piece_by_piece():
    p = quality.start_parameters()
    data, offsets = long_text(60_000), np.array([0, 0, 5, 9_000, 60_000])
    padded, unused, chunks, first = quality.layout(data, offsets)
    most = quality.responses(p, padded, unused).max(axis=1)
    for many in (1, 3, 10_000):
        assert np.allclose(quality.block_maxima(p, padded, unused, many), most, rtol=1e-4, atol=1e-4)
    whole = quality.head(p, most[chunks].max(axis=1), first)["score"]
    assert np.allclose(quality.score_texts(p, data, offsets), whole, atol=1e-5)
    huge = long_text(32 << 20)
    _, mb = peak_mb(lambda: quality.score_texts(p, huge, np.array([0, len(huge)])))
    assert mb < 700


def test_windows_of_a_huge_text_are_those_of_its_pieces():
    rng = np.random.default_rng(4)
    model = {"net": toxicity.start_parameters(),
             "tables": {t: rng.standard_normal(1 << toxicity.TABLE_BITS).astype(np.float32) for t in toxicity.TABLES}}
    for n in (400, 3_000, 20_011, 50_000):
        data = long_text(n, n)
        whole = toxicity.score_texts(model, data, np.array([0, n]), n)
        for size in (300, 1_000, 7_000):
            parts = list(toxicity.pieces(data, size))
            assert len(parts) > 1 or n < 2 * size + 600
            assert np.allclose(toxicity.score_texts(model, data, np.array([0, n]), size), whole, atol=1e-6)
            n_windows = [len(toxicity.windows(toxicity.word_keys(x, np.array([0, len(x)]))["first"])[0]) for x in (data, *parts)]
            assert n_windows[0] == sum(n_windows[1:])
    for blank in (np.full(5_000, 0x20, np.uint8), np.full(5_000, 97, np.uint8)):
        assert len(list(toxicity.pieces(blank, 100))) == 1
    huge = long_text(16 << 20)
    _, mb = peak_mb(lambda: toxicity.score_texts(model, huge, np.array([0, len(huge)])))
    assert mb < 400
