from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from formweave.llm.merkle import climb, index_in_group, manifest
from formweave.llm.queries import held_out
from formweave.session import work_dir

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(digests, arity):
    levels = [digests]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([H(*level[i:i + arity]) for i in range(0, len(level), arity)])
    return levels


def proof(levels, i, arity):
    out = []
    for level in levels[:-1]:
        first = i - i % arity
        run = level[first:first + arity]
        out.append(("".join(run[:i - first]), "".join(run[i - first + 1:])))
        i //= arity
    return out


def brute(rows, arity=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, H(*[field(v) for v in r])))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {g: tree([d for _, d in groups[g]], arity) for g in langs}
    top = tree([trees[g][-1][0] for g in langs], arity)
    out = []
    for k, g in enumerate(langs):
        for i, (r, leaf) in enumerate(groups[g]):
            steps = proof(trees[g], i, arity) + proof(top, k, arity)
            found = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                found[3] += 1
            folded = H(*[field(v) for v in found])
            for left, right in steps:
                folded = H(left, folded, right)
            out.append((r[0], leaf, trees[g][-1][0], top[-1][0], H(*[a + b for a, b in steps]), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def proofs(df, **options):
    return sorted([tuple(r) for r in manifest(df, tampered=held_out(7, 0), **options).collect()], key=str)


ODD = ([(1, None, None, 3, "x"), (1, None, None, 3, "x"), (None, "a", "en", None, None), (2, "", "en", 5, ""),
        (3, "b", "", 5, "é"), (7, "q", "zz", None, "t"), (70, "long", "zz", 5, "wort " * 200_000)]
       + [(i, "s", "b", i, f"t{i}") for i in range(23)])


@pytest.mark.parametrize("options", [{}, {"block_levels": 1, "range_rows": 4}, {"block_levels": 2, "arity": 3}])
def test_proofs_equal_brute_force(spark, options):
    df = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "1 as idx", "'x' as grp", "2 as width", "'y' as leaf")
    assert proofs(df, **options) == brute(ODD, options.get("arity", 2))


def test_given_documents_and_which_rows_fail(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = proofs(documents, block_levels=3)
    assert got == brute(rows)
    assert [r[0] for r in got if not r[6]] == [r[0] for r in got if zlib.crc32(str(r[0]).encode()) % 7 == 0]


def test_lone_leaf_and_empty_table(spark):
    one = spark.createDataFrame([(4, "s", "en", 2, "ab")], SCHEMA)
    (row,) = manifest(one).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof_sha256 == H()
    assert manifest(one.limit(0)).collect() == []


def test_every_level_halves(spark):
    rows = spark.range(100).select(F.lit("g").alias("grp"), F.col("id").alias("doc_id"),
                                   F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"))
    placed = index_in_group(rows, [F.col("grp"), F.col("doc_id")], 9)
    assert sorted(r.idx for r in placed.collect()) == list(range(100))
    levels, roots = climb(placed, work_dir(spark, "climb"))
    assert [level.count() for level in levels] == [100, 50, 25, 13, 7, 4, 2]
    assert [r.height for r in roots.collect()] == [7]
