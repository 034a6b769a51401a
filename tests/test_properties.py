"""Randomized checks of the column functions against plain-Python statements
of the same rules (hundreds of generated values per Spark job)."""

from __future__ import annotations

import json
import random
import re
from pathlib import PurePosixPath

from pyspark.sql import functions as F

from formweave.functions.names import base_name, checkbox_code
from formweave.functions.paths import stem, subject_from_second_token
from formweave.functions.subject_id import RELATION_LABELS, parse_subject_id
from formweave.operators.validate import is_number_ndp

N = 400


def rand_str(rnd, alphabet, lo=0, hi=10):
    return "".join(rnd.choice(alphabet) for _ in range(rnd.randint(lo, hi)))


def run(spark, values, col_fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["r"] for r in df.select("i", col_fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_batch_subject_rule_random(spark):
    rnd = random.Random(11)
    names = [rand_str(rnd, "ab") + "_" + rand_str(rnd, "12FDMPx", 1, 8) + "_" + rand_str(rnd, "z.") for _ in range(N)]
    want = [n.split("_")[1].rstrip("P").rstrip("M").rstrip("D").rstrip("F") for n in names]
    assert run(spark, names, subject_from_second_token) == want


def test_stem_random(spark):
    rnd = random.Random(12)
    names = [rand_str(rnd, "ab.", 1, 8) for _ in range(N)]
    names = [n for n in names if n not in (".", "..")]
    assert run(spark, names, stem) == [PurePosixPath(n).stem for n in names]


def test_checkbox_names_random(spark):
    rnd = random.Random(13)
    names = [rand_str(rnd, "ab_", 1, 12) for _ in range(N)]
    got_base = run(spark, names, base_name)
    got_code = run(spark, names, checkbox_code)
    for n, b, c in zip(names, got_base, got_code):
        parts = n.split("___")
        assert b == parts[0]
        assert c == (parts[1].replace("_", "-") if len(parts) > 1 else None)


def test_decimals_random(spark):
    rnd = random.Random(14)
    vals = [rand_str(rnd, "0123456789.-+a", 0, 8) for _ in range(N)] + [None]

    def rule(v, n):
        if v is None:
            return True
        sign = v[1:] if v[:1] in "+-" else v
        left, dot, right = sign.partition(".")
        if not left.isdigit() or not left.isascii():
            return False
        return not dot or (right.isdigit() and len(right) == n)
    for n in (1, 2, 4):
        assert run(spark, vals, lambda c: is_number_ndp(c, n)) == [rule(v, n) for v in vals]


def test_subject_id_random(spark):
    rnd = random.Random(15)
    ids = [rand_str(rnd, "0123456789.", 0, 7) for _ in range(N)]
    got = run(spark, ids, lambda c: F.to_json(parse_subject_id(c)))
    for v, g in zip(ids, got):
        g = json.loads(g)
        parts = v.split(".")
        if len(parts) == 1:
            want = {"proband_id": v, "relation": "proband", "valid": True}
        elif len(parts) == 2:
            want = {"proband_id": parts[0], "relation_code": parts[1], "valid": parts[1] != "1"}
            if parts[1] in RELATION_LABELS:
                want["relation"] = RELATION_LABELS[parts[1]]
        else:
            want = {"valid": False}
        assert g == want, (v, g)


def test_logic_variable_count_random(spark):
    from formweave.functions.logic import logic_variables
    rnd = random.Random(16)
    logics, want = [], []
    for _ in range(N):
        k = rnd.randint(0, 4)
        vars_ = []
        text = []
        for j in range(k):
            name = rand_str(rnd, "abc_1", 1, 5)
            code = f"({rnd.randint(0, 9)})" if rnd.random() < 0.3 else ""
            event = f"[ev{j}]" if rnd.random() < 0.3 else ""
            text.append(f"{event}[{name}{code}] {rnd.choice(['=', '<>', '>='])} '{rnd.randint(0, 9)}'")
            vars_.append((f"ev{j}:" if event else "") + name + code)
        logics.append(f" {rnd.choice(['and', 'or'])} ".join(text))
        want.append(vars_)
    got = run(spark, logics, logic_variables)
    assert got == want
    assert all(re.fullmatch(r"[\w:()]+", v) for vs in got for v in vs)


def plain_tokens(text):
    """Branching-logic tokens by a hand-written reader, character by character."""
    ops = ("<>", ">=", "<=", "!=", "=", "<", ">")
    word = re.compile(r"\w+(\.\w+)*", re.ASCII)
    literal = re.compile(r"[+-]?\.?\w+(\.\w+)*", re.ASCII)
    variable = re.compile(r"\[\w+(\(-?\w+(\.\w+)?\))?\]\s*", re.ASCII)

    def quoted(at):
        if at < len(text) and text[at] in "'\"" and text.find(text[at], at + 1) > 0:
            return text.find(text[at], at + 1) + 1
        return None

    out, at = [], 0
    while at < len(text):
        op = next((o for o in ops if text.startswith(o, at)), None)
        if op:
            start = at + len(op)
            while start < len(text) and text[start] in " \t\n\r\f\v":
                start += 1
            m = literal.match(text, start)
            end = quoted(start) or (m.end() if m else None)
            if end:
                value = text[start:end]
                out.append(("comparison", op, value[1:-1] if value[0] in "'\"" else value))
                at = end
            else:
                out.append(("operator", op, op))
                at += len(op)
        elif quoted(at):
            out.append(("string", None, text[at + 1:quoted(at) - 1]))
            at = quoted(at)
        elif variable.match(text, at):
            names = []
            while m := variable.match(text, at):
                names.append(m.group().strip()[1:-1])
                at = m.end()
            out.append(("variable", None, ":".join(names)))
        elif m := word.match(text, at):
            w = m.group()
            out.append(("gate", None, w.lower()) if w.lower() in ("and", "or", "not") else ("word", None, w))
            at = m.end()
        else:
            if text[at] in "()":
                out.append(("paren", None, text[at]))
            at += 1
    return out


def test_logic_tokens_random(spark):
    from formweave.functions.logic import logic_tokens
    rnd = random.Random(18)
    bits = ["[a]", "[b(1)]", "[c(-2)]", "[ev] ", "[", "]", "'", '"', " ", "and", " OR ", "=", "<", ">", "!", "<>", ">=",
            "-1.5", "+2", ".5", "3.", "x_1", "(", ")", "é", "'q [z] = 1'", '""', "not"]
    logics = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(4 * N)]
    got = run(spark, logics, logic_tokens)
    for text, tokens in zip(logics, got):
        assert [tuple(t) for t in tokens] == plain_tokens(text), text
