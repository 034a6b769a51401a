from __future__ import annotations

import hashlib
import random

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from formweave.llm import chat
from formweave.llm.chat import (CONTROL, conversation_digests, escape, format_conversations, format_turn, parse_turn,
                                unescape)
from formweave.llm.queries import ORACLES, op3_chat

SMALL = "/root/testdata/sf0.001"
PIECES = st.lists(st.sampled_from([*CONTROL, "\\", "<", "[", "|", "|>", "a", "é", "\n", *[c[0] + "\\" + c[1:] for c in CONTROL]]),
                  max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(PIECES, PIECES)
def test_escape_is_reversible_and_leaves_no_control_string(role, text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROL)
    assert parse_turn(format_turn(role, [{"kind": "text", "text": text}])["formatted"]) == (role, text)


def digests(rows):
    """The contract, stated plainly."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(t or "" for _, _, role, t in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def as_dict(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    sample = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", sample), (-1, 1, "assistant", sample)]
    assert as_dict(op3_chat(spark, SMALL)) == digests(rows)


def test_oracle_agrees(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SMALL}/conversations.parquet'")
    want = con.execute(ORACLES["op3_chat"])
    names = [d[0] for d in want.description]
    df = op3_chat(spark, SMALL)
    assert sorted(names) == sorted(df.columns)
    assert sorted(want.fetchall()) == sorted(tuple(r[n] for n in names) for r in df.collect())


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (1, None, None, "x"), (None, 0, "user", "a"),
            (None, 0, "assistant", "<|end|>" * 3), (2, 0, "assistant", "z" * 500_000), (2, 1, "<|end|>", "\\")]
    rows += [(3, i, random.Random(i).choice(["user", "assistant"]), f"t{i}") for i in range(1500)]
    df = spark.createDataFrame([(*r, 1, "p", "f") for r in rows],
                               "conv_id bigint, turn int, role string, text string, position int, formatted string, kind string")
    assert as_dict(conversation_digests(format_conversations(df))) == digests(rows)
    assert conversation_digests(format_conversations(df.limit(0))).collect() == []


def test_parts(spark):
    def part(kind, **kw):
        return tuple({"kind": kind, **kw}.get(n) for n in ("kind", "text", "uri", "width", "height", "seconds", "pages"))

    df = spark.createDataFrame([
        (1, 0, "user", [part("text", text="see <|image|> two words"), part("image", uri="a.png", width=1024, height=513),
                        part("audio", uri="b.wav", seconds=2.0)]),
        (1, 1, "assistant", [part("document", uri=None, pages=3), part("note", text="ok"), part("text")]),
        (2, 0, "assistant", None)], f"conv_id int, turn int, role string, parts array<{chat.PART}>")
    rows = sorted(format_conversations(df).collect(), key=lambda r: (r.conv_id, r.position))
    whole = "".join(r.formatted for r in rows if r.conv_id == 1)
    assert [a.kind for r in rows for a in r.attachments] == ["image", "audio", "document"]
    assert [a.tokens for r in rows for a in r.attachments] == [85 * 4, 50, 900]
    for r in rows[:2]:
        for a in r.attachments:
            assert whole[a.at:].startswith(chat.PLACEHOLDERS[a.kind])
    assert [r.n_tokens for r in rows] == [4 + 340 + 50, 901, 0]
    assert whole[rows[1].loss_start:rows[1].loss_end] == "<|document|>ok"
    assert rows[2].loss_start == rows[2].loss_end > 0 or rows[2].formatted == "<|turn|>assistant<|text|><|end|>"
