from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_util import tokens
from pyspark.sql import functions as F

from formweave.llm.arrays import slices
from formweave.llm.automaton import BITS, END, ORDER, SYMBOLS, compile_automaton, grams
from formweave.llm.language_model import WORDS, _classes, _tokens, frequent_words, lm_scores, train


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def classes(texts, frequent):
    _, data, offsets = next(slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])]))
    tokens_, at = _tokens(data, offsets)
    return _classes(tokens_, frequent), at


def pack(symbols):
    out = 0
    for s in symbols:
        out = out << BITS | int(s)
    return out


def counted(streams, least=1):
    """Kept grams by order, counted plainly."""
    orders = []
    for k in range(1, ORDER + 1):
        n = Counter()
        for s in streams:
            s = [END] * (ORDER - 1) + list(s)
            n.update(tuple(s[i - k + 1:i + 1]) for i in range(ORDER - 1, len(s)))
        c, kinds = Counter(), Counter()
        for g, x in n.items():
            c[g[:-1]] += x
            kinds[g[:-1]] += 1
        rows = sorted((pack(g), x, c[g[:-1]], kinds[g[:-1]]) for g, x in n.items() if x >= least or k == 1)
        orders.append(tuple(np.array([r[i] for r in rows], np.int64) for i in range(4)))
    return orders


TEXTS = ["the cat sat on the mat", "the cat ate the rat", "a Cat  sat\ton été", "", "the the the", None]
STREAMS = [[2, 3, 4, 5, 2, 0, 1], [2, 3, 0, 2, 0, 1], [6, 3, 4, 5, 0, 1], [1], [2, 2, 2, 1], [1]]


def test_grams():
    offsets = np.cumsum([0, *map(len, STREAMS)])
    want = [pack(([END] * (ORDER - 1) + s)[i:i + ORDER]) for s in STREAMS for i in range(len(s))]
    assert grams(np.concatenate(STREAMS), offsets).tolist() == want


def test_every_state_sums_to_one():
    for least in (1, 2):
        model = compile_automaton(counted(STREAMS, least))
        every = np.arange(SYMBOLS)
        for state in range(len(model.fail)):
            _, weight = model.step(np.full(SYMBOLS, state), every)
            assert abs((10 ** weight).sum() - 1) < 1e-4


def test_traversal_is_the_backoff_recursion():
    orders = counted(STREAMS, 1)
    table = [{int(g): (int(n), int(c), int(t)) for g, n, c, t in zip(*o)} for o in orders]
    seen = [{g >> BITS: (c, t) for g, (n, c, t) in tab.items()} for tab in table]

    def p(history, symbol, k):          # interpolated Witten-Bell, straight from the counts
        if k == 0:
            return 1 / SYMBOLS
        context = pack(history[-(k - 1):]) if k > 1 else 0
        if context not in seen[k - 1]:
            return p(history, symbol, k - 1)
        c, t = seen[k - 1][context]
        n = table[k - 1].get(context << BITS | symbol, (0,))[0]
        return (n + t * p(history, symbol, k - 1)) / (c + t)

    model = compile_automaton(orders)
    asked = STREAMS + [[2, 0, 4, 5, 6, 3, 7, 2, 0, 1], [99, 0, 1], [2, 3, 4] * 100 + [1]]
    offsets = np.cumsum([0, *map(len, asked)])
    got = model.score(np.concatenate(asked), offsets, segment=16)
    for stream, score in zip(asked, got):
        s = [END] * (ORDER - 1) + stream
        want = sum(math.log10(p(s[:i], s[i], ORDER)) for i in range(ORDER - 1, len(s)))
        assert abs(score - want) < 1e-3 * max(1, abs(want))


def base(rows):
    train_rows = [t for i, t in rows if not held(i)]
    c = Counter(w for t in train_rows for w in [*tokens(t), None])
    n, v = sum(c.values()), len(c)
    out = {}
    for i, t in rows:
        toks = [*tokens(t), None]
        out.setdefault(i, []).append((held(i), len(toks), sum(c[w] > 0 for w in toks), n,
                                      round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in toks), 6)))
    return {i: sorted(x) for i, x in out.items()}


def scores(df, **kw):
    rule = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    return lm_scores(df, rule, **kw).collect()


def test_scores(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = scores(documents.repartition(5), bucket_bytes=50_000)
    want = base(rows)
    for r in got:
        assert want[r.doc_id] == [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))]
    unseen = [r for r in got if r.held_out]
    assert len(got) == len(rows) and unseen
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_spark_counts_are_the_plain_counts(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)
    frequent = frequent_words(df)
    stream, at = classes(TEXTS, frequent)
    want = compile_automaton(counted([stream[a:b] for a, b in zip(at, at[1:])], 2))
    got = train(df, frequent)
    stream, at = classes(TEXTS + ["a dog"], frequent)
    assert len(frequent) == 9
    assert np.allclose(want.score(stream, at), got.score(stream, at))


def test_odd_rows(spark, odd_rows):
    rows = [(r.doc_id, r.text) for r in odd_rows.collect()]
    got = {}
    for r in scores(odd_rows):
        got.setdefault(r.doc_id, []).append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)))
        assert r.score < 0
    assert {i: sorted(x) for i, x in got.items()} == base(rows)
    assert scores(odd_rows.limit(0)) == []
    assert all(r.train_tokens == 0 and r.base_score == 0 for r in lm_scores(odd_rows, F.lit(True)).collect())


def test_every_ngram_counts(spark):
    """The scores are the Witten-Bell recursion over all n-grams of words,
    also those seen once, however many words and buckets there are."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(2500)]
    rows = [(i, " ".join(["of the", rng.choice(vocabulary)] * 3 + rng.choices(vocabulary, k=rng.randint(0, 40))))
            for i in range(300)]
    rows += [(i + 300, " ".join(t.split()[2:] + ["of the"])) for i, t in rows[:60]]
    n, c, t = Counter(), Counter(), Counter()
    for i, text in rows:
        s = [None] * (WORDS - 1) + tokens(text) + [None]
        if not held(i):
            n.update(tuple(s[j - k:j + 1]) for j in range(WORDS - 1, len(s)) for k in range(WORDS))
    for g, x in n.items():
        c[g[:-1]] += x
        t[g[:-1]] += 1
    assert t[()] > SYMBOLS                      # more words than the classes of the small automaton

    def p(history, word):
        below = p(history[1:], word) if history else 1 / (t[()] + 1)
        return (n[(*history, word)] + t[history] * below) / (c[history] + t[history]) if c[history] else below

    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for bucket_bytes, block_bytes in ((1 << 10, 8 << 20), (16 << 20, 8 << 20), (1 << 14, 1 << 10)):
        got = {r.doc_id: r.score for r in scores(df, bucket_bytes=bucket_bytes, block_bytes=block_bytes)}
        for i, text in rows:
            s = [None] * (WORDS - 1) + tokens(text) + [None]
            want = sum(math.log10(p(tuple(s[j - WORDS + 1:j]), s[j])) for j in range(WORDS - 1, len(s)))
            assert abs(got[i] - want) < 1e-6 * abs(want), i
