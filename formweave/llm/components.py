"""Connected components of a graph given as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.session import remove_folder, work_dir

#: Spark removes the shuffle files of a query when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(rows: DataFrame, name: str = "rows") -> tuple[DataFrame, str]:
    """Write rows as Parquet below the session's shared folder and read them
    again: cuts the lineage as ``checkpoint()`` does, in a fraction of its
    space.  What the write shuffled goes as soon as it is done.  Returns the
    rows and their folder, which may be removed when nothing reads them any
    more."""
    spark = rows.sparkSession
    folder = work_dir(spark, name)
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        rows.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(rows.schema).parquet(folder), folder


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _to_minimum(edges: DataFrame, strict: bool) -> DataFrame:
    """One star step on edges ``u > v`` (both directions are looked at when
    ``strict``): every neighbour is linked to the smallest vertex around u."""
    if strict:   # large star: larger neighbours of u go to the minimum around u
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:        # small star: u and its smaller neighbours go to their minimum
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        moved = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
    return moved.where("u > v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every vertex of ``edges`` (columns ``a``, ``b``,
    bigint): the smallest vertex reachable from it.

    Alternates the large-star and small-star steps until nothing changes.
    Each step is a map-side combined minimum and a join, so a vertex with
    very many neighbours is never gathered in one task, and every round is
    written, and the one before it removed.  Nulls and self-loops are ignored; repeated
    edges count once.  An empty graph gives no rows.
    """
    spark = edges.sparkSession
    now, folder = cut(edges.where("a <> b")
                      .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before, size = None, _summary(now)
    while size != before:
        new, next_folder = cut(_to_minimum(_to_minimum(now, True), False), "edges")
        before, size = size, _summary(new)
        remove_folder(spark, folder)
        now, folder = new, next_folder
    return (now.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .union(now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct())
