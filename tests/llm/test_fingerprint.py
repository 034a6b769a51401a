from __future__ import annotations

import hashlib

from llm_util import tokens
from test_set_join import brute

from formweave.llm.fingerprint import edited_fingerprints, fingerprints, likeness, similar_documents


def shingle_set(text):
    w = tokens(text)
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def check(df, rows_per_part):
    rows = sorted(((r.doc_id, r.text or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = sorted(edited_fingerprints(df, rows_per_part).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    off = []
    want = {}
    for n, (i, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + following[:quarter]
        want.setdefault(i, []).append((len(text), hashlib.sha256(edited.encode()).hexdigest()))
        if len([r for r in rows if r[0] == i]) == 1:
            a, b = shingle_set(text), shingle_set(edited)
            off.append(abs(got[n].near_edited - (len(a & b) / len(a | b) if a | b else 1.0)))
    for i, w in want.items():
        assert sorted(w) == sorted((r.n_chars, r.edited_sha256) for r in got if r.doc_id == i)
    for r in got:
        assert likeness(r.fingerprint, r.edited_fingerprint) == r.near_edited
    assert max(off) < 0.3 and sum(off) / len(off) < 0.06
    return got


def test_edited_texts_over_many_ranges(documents):
    got = check(documents, 7)
    texts = {r.doc_id: r.text for r in documents.collect()}
    by_text = {}
    for r in got:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def test_odd_rows(odd_rows):
    check(odd_rows, 3)
    check(odd_rows, 1000)
    assert edited_fingerprints(odd_rows.limit(0)).collect() == []
    alone = edited_fingerprints(odd_rows.where("doc_id = 7")).collect()
    assert [r.near_next for r in alone] == [1.0]
    prints = {r.doc_id: r.fingerprint for r in fingerprints(odd_rows).collect()}
    assert prints[4] == prints[5] == prints[6] != prints[7] == prints[8]


def test_banded_join_finds_the_near_copies(documents, odd_rows):
    want = {i: c for i, (_, c) in brute([(r.doc_id, r.text) for r in documents.collect()], 5).items()}
    linked = {i: c for i, c in want.items() if list(want.values()).count(c) > 1}
    assert {r.doc_id: r.component for r in similar_documents(documents).collect()} == linked
    assert {r.doc_id for r in similar_documents(odd_rows).collect()} == {1, 2, 3, 7, 8, 9, 10}
