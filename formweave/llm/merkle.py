"""Merkle manifest of a dataset by sibling-shift self-joins.

Every group of rows is a tree over its leaves in order, and the group roots
are the leaves of one more tree.  A level is a table ``(grp, idx, width,
digest)``.  Each level is equijoined with itself on computed sibling indices
(``idx ^ 1`` for pairs; ``slot + 1 .. slot + arity - 1`` modulo the arity
otherwise); its slot-zero rows then hold all digests of their run and emit
the parents.  All groups climb together, so there are as many levels as the
largest group needs, and each halves the rows.

Proofs: the siblings of the lower ``BLOCK_LEVELS`` levels are brought together
by blocks of 2**BLOCK_LEVELS leaves, with the siblings of the block's
ancestors, which come down level by level through joins of few rows.  So no
table ever holds a whole proof for every leaf.  Positions in a group are
prefix sums over ranges, not a window over the group.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.llm.arrays import with_id
from formweave.llm.mixing import sums_before
from formweave.session import ensure_checkpoint_dir, work_dir

ARITY = 2
BLOCK_LEVELS = 9
RANGE_ROWS = 200_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field_text(column: Column) -> Column:
    """A value as its byte count, a colon and itself; ``-`` for null."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 in hex of all values of a row."""
    return F.sha2(F.concat(*[field_text(c) for c in columns]).cast("binary"), 256)


def index_in_group(rows: DataFrame, order: list[Column], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add ``idx``, the row's place in its group ``grp`` by ``order`` (which
    begins with ``grp``), and ``width``, the group's size."""
    rows = rows.checkpoint()
    n = rows.count()
    placed = sums_before(rows, order, {"idx": F.lit(1).cast("bigint")}, by="grp", parts=1 + n // range_rows)
    widths = rows.groupBy("grp").agg(F.count("*").alias("width"))
    joined = placed.alias("r").join(widths.alias("w"), F.col("r.grp").eqNullSafe(F.col("w.grp")))
    return joined.select("r.*", "w.width")


def sibling_join(level: DataFrame, arity: int = ARITY) -> DataFrame:
    """``grp, idx, width, digest, s1 .. s(arity-1)`` for the nodes of groups
    that still have several: ``sJ`` is the digest of the sibling J slots on
    (around the run), null where the last run has none."""
    nodes = level.where("width > 1")
    out = nodes
    for shift in range(1, arity):
        slot = F.pmod("idx", F.lit(arity))
        sibling = (F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2
                   else F.col("idx") - slot + F.pmod(slot + F.lit(shift), F.lit(arity)))
        other = nodes.select(F.col("grp").alias("_grp"), F.col("idx").alias("_idx"), F.col("digest").alias(f"s{shift}"))
        out = (out.withColumn("_at", sibling)
               .join(other, F.col("_grp").eqNullSafe(F.col("grp")) & (F.col("_idx") == F.col("_at")), "left")
               .drop("_grp", "_idx", "_at"))
    return out


def parents(joined: DataFrame, arity: int = ARITY) -> DataFrame:
    """The next level: one node for every slot-zero row."""
    run = F.concat(F.col("digest"), *[F.coalesce(F.col(f"s{j}"), F.lit("")) for j in range(1, arity)])
    return joined.where(F.pmod("idx", F.lit(arity)) == 0).select(
        "grp", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(width + {arity - 1}) div {arity}").alias("width"),
        F.sha2(run.cast("binary"), 256).alias("digest"))


def climb(leaves: DataFrame, folder: str, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """Build all levels over ``leaves`` (``grp, idx, width, digest``).

    Returns the joined levels (see :func:`sibling_join`), each written below
    ``folder``, and the roots: ``grp, height, digest``."""
    spark = leaves.sparkSession
    levels, roots = [], []
    level = leaves.select("grp", "idx", "width", "digest")
    widest = leaves.agg(F.max("width")).first()[0] or 0
    while True:
        roots.append(level.where("width = 1").select("grp", F.lit(len(levels)).alias("height"), "digest"))
        if widest <= 1:
            break
        path = f"{folder}/{len(levels)}"
        sibling_join(level, arity).write.parquet(path)
        joined = spark.read.parquet(path)
        levels.append(joined)
        level = parents(joined, arity)
        widest = (widest + arity - 1) // arity
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return levels, out


def _step(arity: int) -> Column:
    """A joined row as a step of a proof: what stands before and after."""
    slot = F.pmod("idx", F.lit(arity))
    side = {True: [], False: []}
    for k in range(arity):
        found = F.coalesce(*[F.when(F.pmod(slot + F.lit(j), F.lit(arity)) == k, F.col(f"s{j}"))
                             for j in range(1, arity)], F.lit(""))
        side[True].append(F.when(slot > k, found).otherwise(""))
        side[False].append(F.when(slot < k, found).otherwise(""))
    return F.struct(F.concat(*side[True]).alias("l"), F.concat(*side[False]).alias("r"))


STEPS = "array<struct<l:string,r:string>>"


def descend(levels: list[DataFrame], roots: DataFrame, down_to: int, arity: int) -> DataFrame:
    """``grp, idx, steps, ...`` for the nodes of level ``down_to`` (and for
    lower group roots, whose idx is 0): ``steps`` leads from the node to the
    top.  ``roots`` has ``grp, height, steps`` and any further columns."""
    more = [c for c in roots.columns if c not in ("grp", "height", "steps")]
    start = roots.withColumn("idx", F.lit(0).cast("bigint"))
    done = start.where(F.col("height") <= down_to).select("grp", "idx", "steps", *more)
    here = start.where(F.col("height") > down_to).where(f"height >= {len(levels)}").select("grp", "idx", "steps", *more)
    for at in range(len(levels) - 1, down_to - 1, -1):
        above = here.alias("a")
        below = levels[at].select("grp", "idx", F.expr(f"idx div {arity}").alias("up"), _step(arity).alias("step")).alias("b")
        here = below.join(above, F.col("a.grp").eqNullSafe(F.col("b.grp")) & (F.col("a.idx") == F.col("b.up"))).select(
            "b.grp", "b.idx", F.concat(F.array("b.step"), "a.steps").alias("steps"), *[f"a.{c}" for c in more])
        if at > down_to:
            here = here.unionByName(start.where(F.col("height") == at).select("grp", "idx", "steps", *more))
    return here.unionByName(done) if len(levels) > down_to else done


def _fold(blocks: int, arity: int, carried: list[str]):
    """Proofs of one block of leaves: its rows of all lower levels, one row
    with the steps above it, and the leaves with what they carry."""
    def proofs(table: pa.Table) -> pa.Table:
        steps: dict[tuple[int, int], tuple[str, str]] = {}
        leaves, above, root, subroot = [], [], None, None
        for r in table.to_pylist():
            if r["kind"] == 0:
                steps[r["level"], r["idx"]] = (r["l"], r["r"])
            elif r["kind"] == 1:
                above, root, subroot = [(s["l"], s["r"]) for s in r["steps"]], r["root"], r["subroot"]
            else:
                leaves.append(r)
        out = {c: [] for c in [*carried, "subroot", "root", "proof_sha256", "folded_root"]}
        for leaf in leaves:
            at, path = leaf["idx"], []
            for level in range(blocks):
                if (level, at) not in steps:
                    break
                path.append(steps[level, at])
                at //= arity
            path += above
            folded = leaf["checked"]
            for left, right in path:
                folded = hashlib.sha256(f"{left}{folded}{right}".encode()).hexdigest()
            for c in carried:
                out[c].append(leaf[c])
            out["subroot"].append(subroot)
            out["root"].append(root)
            out["proof_sha256"].append(hashlib.sha256("".join(a + b for a, b in path).encode()).hexdigest())
            out["folded_root"].append(folded)
        return pa.table({c: pa.array(v, pa.int64() if c == "doc_id" else pa.string()) for c, v in out.items()})
    return proofs


def merkle_proofs(leaves: DataFrame, arity: int = ARITY, block_levels: int = BLOCK_LEVELS,
                  range_rows: int = RANGE_ROWS) -> DataFrame:
    """Proof of every leaf: ``doc_id, leaf, subroot, root, proof_sha256,
    folded_root``.

    ``leaves`` has ``grp`` (string), ``doc_id``, ``leaf`` and ``checked``, the
    digest the proof is folded from.  Leaves of a group are in order of
    doc_id (null first), then leaf; groups in order of their name (null
    first, by UTF-8 bytes).  Equal rows are leaves of their own; an empty
    table gives no rows."""
    spark = leaves.sparkSession
    ensure_checkpoint_dir(spark)
    folder = work_dir(spark, "merkle")
    index_in_group(leaves.select("grp", "doc_id", "leaf", "checked"),
                   [F.col("grp"), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("checked")],
                   range_rows).write.parquet(f"{folder}/leaves")
    placed = spark.read.parquet(f"{folder}/leaves")
    levels, subroots = climb(placed.withColumnRenamed("leaf", "digest"), f"{folder}/groups", arity)
    subroots.write.parquet(f"{folder}/subroots")
    subroots = spark.read.parquet(f"{folder}/subroots")

    top = index_in_group(subroots.select(F.lit("top").alias("grp"), F.col("grp").alias("name"), "digest"),
                         [F.col("grp"), F.col("name").asc_nulls_first()], range_rows)
    top.write.parquet(f"{folder}/top")
    top = spark.read.parquet(f"{folder}/top")
    upper, roots = climb(top, f"{folder}/upper", arity)
    roots = roots.select("grp", "height", F.array().cast(STEPS).alias("steps"), F.col("digest").alias("root"))
    down = descend(upper, roots, 0, arity)
    down.join(top.select("idx", "name", F.col("digest").alias("subroot")), "idx").select(
        F.col("name").alias("grp"), "steps", "root", "subroot").write.parquet(f"{folder}/down")
    down = spark.read.parquet(f"{folder}/down")
    tops = down.alias("d").join(subroots.alias("s"), F.col("d.grp").eqNullSafe(F.col("s.grp"))).select("d.*", "s.height")

    block = F.expr(f"idx div {arity ** block_levels}")
    above = descend(levels, tops, block_levels, arity).select(
        "grp", F.col("idx").alias("block"), F.lit(1).alias("kind"), "steps", "root", "subroot")
    parts = above.unionByName(
        placed.select("grp", block.alias("block"), F.lit(2).alias("kind"), "idx", "doc_id", "leaf", "checked"),
        allowMissingColumns=True)
    for at, level in enumerate(levels[:block_levels]):
        step = level.select("grp", "idx", _step(arity).alias("s")).select(
            "grp", F.expr(f"idx div {arity ** (block_levels - at)}").alias("block"), F.lit(0).alias("kind"),
            F.lit(at).alias("level"), "idx", "s.l", "s.r")
        parts = parts.unionByName(step, allowMissingColumns=True)
    return parts.groupBy("grp", "block").applyInArrow(
        _fold(block_levels, arity, ["doc_id", "leaf"]),
        "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string")


def manifest(documents: DataFrame, group: str = "lang", fields: tuple[str, ...] = FIELDS,
             tampered: Column | None = None, arity: int = ARITY, block_levels: int = BLOCK_LEVELS,
             range_rows: int = RANGE_ROWS) -> DataFrame:
    """A Merkle manifest of ``documents``, with a check of every row.

    A leaf is the SHA-256 of the ``fields`` of a row; leaves of one ``group``
    value form a tree, and the group roots the tree of the dataset.  Returns
    ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``:
    ``proof_sha256`` digests the row's siblings from its leaf to the root, and
    ``folded_root`` is computed from the leaf as found and these siblings.
    Where ``tampered`` is true, the row is found with one more in ``n_chars``
    (a null stays).

    Nulls in any field have their own mark, so they differ from empty texts;
    a null group is a group.  Other columns are ignored, equal rows are leaves
    of their own, a lone leaf is its group's root, and an empty table gives no
    rows."""
    rows = with_id(documents, *[F.col(f) for f in fields if f != "doc_id"])
    changed = [(F.col(f) + F.when(tampered, 1).otherwise(0)) if f == "n_chars" and tampered is not None else F.col(f)
               for f in fields]
    leaf = leaf_digest([F.col(f) for f in fields])
    checked = F.when(tampered, leaf_digest(changed)).otherwise(F.col("leaf")) if tampered is not None else F.col("leaf")
    leaves = (rows.withColumn("leaf", leaf).withColumn("checked", checked)
              .select(F.col(group).cast("string").alias("grp"), "doc_id", "leaf", "checked"))
    out = merkle_proofs(leaves, arity, block_levels, range_rows)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
