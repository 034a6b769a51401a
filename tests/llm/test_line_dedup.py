from __future__ import annotations

import random
import re
from collections import defaultdict

from llm_util import tokens

from formweave.llm.line_dedup import drop_recurring_lines, line_templates, recurring_lines

PASSAGE = " ".join(f"passage{'abcdefgh'[i % 8]}{'xyz'[i % 3]}{chr(97 + i // 8)}" for i in range(60))


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(800)]

    def line(k):
        return " ".join(rng.choice(vocabulary) for _ in range(k)).capitalize()

    docs = {}
    for i in range(n):
        lines = [line(rng.randint(6, 25)) for _ in range(rng.randint(4, 9))]
        if i % 5 == 0:
            lines.insert(rng.randint(0, len(lines)), PASSAGE)
        if i % 4 == 0:
            lines.append(f"Posted on 2021-0{1 + i % 9}-1{i % 10} by the editors of this page")
        if i % 6 == 0:
            user = rng.choice(vocabulary)
            lines.insert(0, f"This long notice was sent to the member called {user} because they asked us to do so")
        docs[i] = lines
    docs[n] = docs[n + 1] = docs[n + 2] = docs[n + 3] = docs[1]                  # copies
    docs[n + 4] = docs[2][:-1] + [line(9)]                                       # a near copy
    return docs


def test_templates_go_and_documents_stay(spark):
    docs = corpus()
    df = spark.createDataFrame([(i, "\n".join(x), "en") for i, x in docs.items()], "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in drop_recurring_lines(df.repartition(5)).collect()}
    seen = defaultdict(int)
    for i, lines in docs.items():
        want = []
        for x in lines:
            kind = "passage" if x == PASSAGE else "post" if x.startswith("Posted") else "notice" if x.startswith("This long") else None
            seen[kind] += 1
            if kind is None or seen[kind] == 1:
                want.append(x)
        assert got[i].text == "\n".join(want), i
        assert got[i].dropped_lines == len(lines) - len(want) and got[i].lang == "en"


def test_real_lines(documents):
    """Exact recurrence, stated plainly, on whole given texts: whatever is
    dropped recurs elsewhere, and no line of unrelated documents is left."""
    rows = {r.doc_id: r.text for r in documents.collect()}

    def masked(words):
        numbers = [bool(re.search("[0-9]", w)) for w in words]
        return tuple("*" if n and 2 * sum(numbers) <= len(words) else w for n, w in zip(numbers, words))
    mask = {i: [masked(tokens(x)) for x in t.split("\n")] for i, t in rows.items()}
    where = defaultdict(set)
    for i, lines in mask.items():
        for x in lines:
            where[x].add(i)
    dropped = 0
    for r in recurring_lines(documents).collect():
        for k in r.drop:
            x = mask[r.doc_id][k]
            dropped += 1
            assert len(x) >= 4 and (len(where[x]) >= 3 or len(x) >= 5) and min(where[x] | {r.doc_id}) <= r.doc_id
    assert dropped
    after = defaultdict(int)
    for r in drop_recurring_lines(documents).collect():
        for x in set(r.text.split("\n")):
            after[x] += 1
    for text in {x for t in rows.values() for x in t.split("\n")}:
        holders = [i for i, t in rows.items() if text in t.split("\n")]
        others = {i: frozenset(rows[i].split("\n")) - {text} for i in holders}
        if len(tokens(text)) >= 4 and len(text) >= 24 and len(holders) >= 4 and not set.intersection(*map(set, others.values())) \
                and all(not (others[a] & others[b]) for a in holders for b in holders if a < b):
            assert after[text] <= 1, text


def plain_templates(rows):
    """The rule of ``line_templates``, said line by line."""
    def keys(tokens):
        n = len(tokens)
        if n < 10:
            return [(p, tokens[:p] + tokens[p + 1:]) for p in range(2, n)]
        k = min(n // 5 + 1, 8)
        at = [2 + i * (n - 2) // k for i in range(k + 1)]
        return [(i, tokens[at[i]:at[i + 1]]) for i in range(k)]
    rank = {(leaf, exact): (min(n, 32767), exact) for leaf, exact, n, _ in rows}
    token = {(leaf, exact): t for leaf, exact, _, t in rows}
    groups = defaultdict(list)
    for line, t in token.items():
        if len(t) >= 5:
            for key in keys(t):
                groups[line[0], len(t), key].append(line)
    best = {}
    for lines in groups.values():
        top = max(lines, key=rank.get)
        for x in lines:
            alike = sum(a == b for a, b in zip(token[x], token[top])) >= 0.8 * len(token[x])
            if x != top and alike and (x not in best or rank[top] > rank[best[x]]):
                best[x] = top
    return {(x[1], top[1]) for x, top in best.items() if x not in set(best.values())}


def test_templates_equal_the_plain_rule(spark):
    rng = random.Random(11)
    rows, exact = [], 0
    for leaf, n in enumerate((4, 5, 6, 8, 9, 10, 14, 23, 45, 70)):
        bases = [bytes(rng.randrange(5) for _ in range(n)) for _ in range(6)]
        seen = set()
        for _ in range(60):
            t = bytearray(rng.choice(bases))
            for _ in range(rng.randint(0, n // 4 + 1)):
                t[rng.randrange(2, n)] = rng.randrange(5)
            if bytes(t) not in seen:
                seen.add(bytes(t))
                exact += 1
                rows.append((leaf, exact, rng.choice((1, 1, 2, 9, 40000)), bytes(t)))
    df = spark.createDataFrame(rows, "leaf bigint, exact bigint, n bigint, tokens binary")
    want = plain_templates(rows)
    assert len(want) > 100
    assert {tuple(r) for r in line_templates(df.repartition(4)).collect()} == want
    assert line_templates(df.limit(0)).collect() == []


def test_short_lines_and_large_leaves_have_variable_fields(spark):
    """One name in a line of eight tokens, and two fields in a leaf of
    thousands of lines; other lines of the same leaf stay."""
    rng = random.Random(5)

    def word():
        return "".join(rng.choice("abcdefghijklmnop") for _ in range(8))

    docs = {i: [f"Photo by {word()} for the press agency today",
                f"This note went to {word()} and also to {word()} because both of them had asked us"]
            + [" ".join(["This", "note"] + [word() for _ in range(14)]) for _ in range(200)] for i in range(15)}
    df = spark.createDataFrame([(i, "\n".join(x)) for i, x in docs.items()], "doc_id bigint, text string")
    got = {r.doc_id: r.text.split("\n") for r in drop_recurring_lines(df).collect()}
    assert got == {i: x if i == 0 else x[2:] for i, x in docs.items()}


def test_odd_rows(spark, odd_rows):
    clash = odd_rows.withColumnsRenamed({"node": "template", "score": "mark", "cluster": "line", "component": "dropped_lines"})
    rows = drop_recurring_lines(clash).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows) == \
        sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd_rows.collect())
    assert set(clash.columns) == set(rows[0].asDict())
    assert drop_recurring_lines(clash.limit(0)).collect() == []
    texts = ["", "\n\n", None, "a line that is long enough to count here\n\n\nx"] * 2
    texts += [f"own words number {c} {c}{c} of text\nthe same line that is in many documents now\n" for c in "abcdef"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in drop_recurring_lines(df).collect()}
    assert [got[i] for i in range(8)] == texts[:8]
    assert sum("same line" in got[i] for i in range(8, 14)) == 1 and all(got[i].endswith("text\n") for i in range(9, 14))


def test_int_ids(spark):
    df = spark.createDataFrame([(i, f"own words number {c} {c}{c} of text\nthe same line that is in many documents now")
                                for i, c in enumerate("abcdef")], "doc_id int, text string")
    got = drop_recurring_lines(df)
    assert got.dtypes[0] == ("doc_id", "int") and sum(r.dropped_lines for r in got.collect()) == 5


def test_copies_and_long_notices_keep_no_recurring_line(spark):
    """A line of unrelated documents goes however many copies one of them
    has, and so does a notice of ten lines beside three own lines."""
    rng = random.Random(7)

    def own(k, words=12):
        return [" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(words)) for _ in range(k)]

    line, notice = "the same line that is in many documents now", own(10)
    docs = [own(6) + [line] for _ in range(8)]
    docs += [docs[3]] * 12                                    # more copies than unrelated documents
    copied = len(docs)
    docs += [own(3) + notice for _ in range(8)]
    df = spark.createDataFrame([(i, "\n".join(x)) for i, x in enumerate(docs)], "doc_id bigint, text string")
    got = {r.doc_id: r.text.split("\n") for r in drop_recurring_lines(df).collect()}
    assert [i for i in got if line in got[i]] == [0]
    assert all(got[i] == [x for x in docs[i] if x != line] for i in range(1, copied))   # copies keep all else
    assert [i for i in got if set(notice) & set(got[i])] == [copied]
    assert all(got[i] == docs[i][:3] for i in range(copied + 1, len(docs)))


def test_rows_of_numbers_are_told_apart_by_their_numbers(spark):
    """Tables, logs and price lists stay; an equal row in three documents goes."""
    rng = random.Random(4)

    def row():
        return " ".join(f"{rng.random() * 1000:.4f}" for _ in range(6))

    docs = {i: [row() for _ in range(3)] for i in range(12)}
    same = row()
    for i in (2, 5, 9):
        docs[i].append(same)
    df = spark.createDataFrame([(i, "\n".join(x)) for i, x in docs.items()], "doc_id bigint, text string")
    got = {r.doc_id: r.text.split("\n") for r in drop_recurring_lines(df).collect()}
    assert got == {i: x[:3] + ([same] if i == 2 else []) for i, x in docs.items()}
