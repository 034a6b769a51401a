"""Mixing sources to target weights, in DataFrame functions only.

Efraimidis-Spirakis sampling: every document draws the key ``-ln(u) / w``
from a hash of its id and its quality weight; in order of keys, a source's
documents are a weighted sample without replacement at every length.
Prefix sums over that order cut the sample at the source's word budget,
after as many complete epochs as the budget holds.

No window runs over a source or over the whole table: rows are dealt to
ranges of (source, key), sums run inside a range, and only one row per
range (and source) is summed across ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formweave.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
RANGE_ROWS = 100_000


def sums_before(rows: DataFrame, order: list[Column], sums: dict[str, Column], by: str | None = None,
                parts: int = 1) -> DataFrame:
    """Add to each row the sums over all rows before it in ``order`` (with
    ``by``, the first column of the order: over those with an equal value).

    The rows are sorted into ``parts`` ranges, which are written, so that a
    range is the same whenever it is read again."""
    placed = rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    keys = ["_part"] + ([by] if by else [])
    totals = placed.groupBy(*keys).agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    across = (Window.partitionBy(by) if by else Window.partitionBy()).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    totals = totals.select(*keys, *[F.coalesce(F.sum(f"_{n}").over(across), F.lit(0)).alias(f"_{n}") for n in sums])
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(n) for n, c in sums.items()])
    joined = rows.alias("r").join(totals.alias("t"), [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys])
    return joined.select(*[F.col(f"r.`{c}`") for c in placed.columns if c != "_part"],
                         *[(F.col(f"r.`{n}`") + F.col(f"t._{n}")).alias(n) for n in sums])


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``share`` times all words; a target stops at ``most`` times its source's
    size, and the excess is shared again by weight among the others.  That
    is one water level: in order of size by weight, every source whose cap
    lies below the level left for it and all later ones is at its cap."""
    n = sources.count()
    parts = 1 + n // RANGE_ROWS
    ranked = sums_before(sources, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)}, parts=parts)
    kind = F.pmod("rank", F.lit(len(weights)))
    ranked = ranked.select("source", "source_size", F.element_at(F.array(*[F.lit(w) for w in weights]), (kind + 1).cast("int")).alias("w"))
    level = sums_before(ranked.withColumn("fill", F.col("source_size") / F.col("w")),
                        [F.col("fill").asc(), F.col("source").asc_nulls_last()],
                        {"sizes": F.col("source_size"), "weights": F.col("w")}, parts=parts)
    all_words, all_w = ranked.agg(F.sum("source_size"), F.sum("w")).first()
    level = level.withColumn("level", (share * F.lit(all_words) - most * F.col("sizes")) / (F.lit(all_w) - F.col("weights")))
    found = level.where(most * F.col("source_size") > F.col("level") * F.col("w")).agg(F.min_by("level", "fill")).first()[0]
    return ranked.select("source", "source_size",
                         F.least(most * F.col("source_size"), F.lit(found or 0.0) * F.col("w")).alias("target"))


def quality_weight() -> Column:
    """A plain quality weight from ``text`` and ``size``: texts whose mean word
    length is far from five characters weigh less.  Always above 0."""
    return F.lit(1.0) / (F.lit(1.0) + F.abs(F.length("text") / F.greatest("size", F.lit(1)) - F.lit(5.0)))


def mix_sources(documents: DataFrame, weight: Column | None = None, weights: tuple[int, ...] = (3, 1, 2),
                share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """One row per row of ``documents`` (``doc_id``, ``text``, ``source``):
    ``doc_id, size, source_size, target, taken``.

    ``size`` is the number of words; ``target`` the words its source should
    give (see ``source_targets``) and ``taken`` those the mix takes of this
    document.  A source first gives all its documents once for every time its
    size fits into the target; what is left is taken in order of the sampling
    keys, and the document at the end of the budget is cut to the words that
    are still missing.  So a source's taken words are its target, rounded
    down, and no document exceeds ``most`` times its size.

    ``weight`` is a positive quality weight over the columns of ``documents``
    and ``size``; null or not positive weights count as very small.  The keys
    come from a hash of ``doc_id`` and ``seed``, so reruns agree; equal keys
    are ordered by doc_id and size, rows equal in these are interchangeable.
    Null texts have size 0; null sources are one source; null doc_ids share
    one key.  Sources without words have target 0.  Other columns are
    ignored; an empty table gives no rows."""
    ensure_checkpoint_dir(documents.sparkSession)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    unit = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")).cast("binary")), 1, 13), 16, 10)
    rows = documents.withColumn("size", size)
    heavy = F.coalesce(weight if weight is not None else quality_weight(), F.lit(0.0))
    key = -F.log((unit.cast("double") + 0.5) / float(1 << 52)) / F.greatest(heavy, F.lit(1e-9))
    rows = rows.select("doc_id", F.col("source").cast("string").alias("source"), "size", key.alias("key")).checkpoint()
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size")).checkpoint()
    targets = source_targets(sources, weights, share, most)
    n = rows.count()
    order = [F.col("source").asc_nulls_last(), F.col("key").asc(), F.col("doc_id").asc(), F.col("size").asc()]
    spread = sums_before(rows, order, {"before": F.col("size")}, by="source", parts=1 + n // RANGE_ROWS)
    joined = spread.alias("d").join(targets.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    epochs = F.coalesce(F.floor(F.col("s.target") / F.when(F.col("s.source_size") > 0, F.col("s.source_size"))), F.lit(0))
    left = F.floor("s.target") - epochs * F.col("s.source_size") - F.col("d.before")
    return joined.select("d.doc_id", "d.size", "s.source_size", "s.target",
                         (epochs * F.col("d.size") + F.greatest(F.lit(0), F.least("d.size", left))).cast("bigint").alias("taken"))
