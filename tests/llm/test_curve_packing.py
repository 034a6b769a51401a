from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from formweave.llm import curve_packing
from formweave.llm.curve_packing import (Encoder, Projection, curve_order, hilbert_key, merge_ranks,
                                            pack_documents, sequence_ends, write_tokens)
from formweave.session import work_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")
MODEL = Tokenizer.from_file(PATH)
MODEL.encode_special_tokens = True


def ids_of(text):
    return np.array(MODEL.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check(pieces, texts, length=2048):
    """``texts``: doc_id -> list of texts with that id."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        docs[p.doc_id].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    sizes = {}
    for s, parts in sequences.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        sizes[s] = at
    assert sorted(sizes) == list(range(len(sizes)))
    assert all(n == length or (n < length and n & (n - 1) == 0) for n in sizes.values())
    assert sum(n < length for n in sizes.values()) <= length.bit_length()
    assert set(docs) == set(texts)
    for doc, found in docs.items():
        wanted = [ids_of(t) for t in texts[doc]]
        if len(wanted) == 1:
            at = 0
            for start, n, crc, total in sorted(found):
                assert start == at and total == len(wanted[0])
                assert crc == zlib.crc32(wanted[0][at:at + n].tobytes())
                at += n
            assert at == len(wanted[0])
        else:
            assert sum(f[1] for f in found) == sum(len(w) for w in wanted)


def test_given_documents_in_many_ranges(spark, documents):
    texts = {r.doc_id: [r.text] for r in documents.collect()}
    check(pack_documents(documents, part_tokens=20_000).collect(), texts)
    check(pack_documents(documents, length=64).collect(), texts, 64)


def test_odd_rows(spark, odd_rows):
    rows = odd_rows.collect()
    texts = defaultdict(list)
    for r in rows:
        texts[r.doc_id].append(r.text)
    check(pack_documents(odd_rows).collect(), texts)
    assert pack_documents(odd_rows.limit(0)).collect() == []


def test_copies_are_neighbours(spark):
    rng = np.random.default_rng(5)
    words = [f"word{i}" for i in range(3000)]
    groups = [" ".join(rng.choice(words, 80)) for _ in range(40)]
    df = spark.createDataFrame([(i, groups[i % 40]) for i in range(400)], "doc_id bigint, text string")
    tokens = write_tokens(df, work_dir(spark, "tokens"), PATH)
    ordered = curve_order(tokens, work_dir(spark, "curve"), part_tokens=1000)
    order = [r.doc_id % 40 for r in ordered.orderBy("part", "before").collect()]
    assert len(list(itertools.groupby(order))) == 40


def test_hilbert_curve_visits_every_point_by_single_steps():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        keys = hilbert_key(points, bits)
        assert sorted(keys) == list(range(1 << axes * bits))
        assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_similar_documents_lie_near():
    project = Projection(50257)
    rng = np.random.default_rng(1)
    near, far = [], []
    for _ in range(50):
        a, b = rng.integers(0, 50000, 300), rng.integers(0, 50000, 300)
        edited = np.concatenate((a[:280], rng.integers(0, 50000, 20)))
        near.append(np.abs(project(a) - project(edited)).mean())
        far.append(np.abs(project(a) - project(b)).mean())
    assert np.mean(near) < 0.4 * np.mean(far)


def test_tail_is_cut_into_powers_of_two():
    assert sequence_ends(2048 * 3 + 1500, 2048) == [7168, 7424, 7552, 7616, 7632, 7640, 7644]
    assert sequence_ends(4096, 2048) == [] and sequence_ends(1, 2048) == [1]


SPACES = st.sampled_from([" ", "  ", "\n", "\n\n ", "\t", " \t", " ", "　 ", "\x1c", "\x85", "\r\n"])
WORDS = st.sampled_from(["it's", "don't,", "x1", "Größe", "...", "日本語", "<|endoftext|>", "\U0001F600", "'ll", "1234", "é"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(SPACES, WORDS, st.text(max_size=4)), max_size=30).map("".join))
def test_ids_by_words_and_blocks_are_the_ids_of_the_whole(text):
    assert ENCODER(text).tolist() == ids_of(text)[:-1].tolist()


ENCODER = Encoder(PATH)


def test_blocks_of_long_texts(monkeypatch):
    monkeypatch.setattr(curve_packing, "BLOCK_CHARS", 5)
    for text in ("one two  three\n\nfour\tfive 'll six " * 50, "x" * 3000, " " * 300, "a \tb " * 40):
        assert ENCODER(text).tolist() == ids_of(text)[:-1].tolist()


def test_given_texts_have_the_ids_of_the_library(documents):
    for r in documents.collect():
        ENCODER.check(r.text)
        assert ENCODER(r.text).tolist() == ids_of(r.text)[:-1].tolist()


def test_other_files_run_in_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert merge_ranks(path) is None and len(merge_ranks(PATH)) == 50256
    model = Tokenizer.from_file(path)
    assert Encoder(path)("Some words, and more.").tolist() == model.encode("Some words, and more.", add_special_tokens=False).ids
