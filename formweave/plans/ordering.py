"""Order-dependent operators that stay distributed.

A window ``partitionBy(form).orderBy(ord)`` puts a whole form in one task,
and ``orderBy(ord)`` without a partition puts everything in one task.  A
dictionary derived from a large table can hold a third of its rows in one
form, so both helpers split the order key into fixed-width buckets
(``ord >> bits``): every window runs over at most ``2**bits`` rows, and
only a per-bucket summary (one row per bucket) crosses bucket borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formweave.session import remove_folder, work_dir

DEFAULT_BUCKET_BITS = 20  # 1,048,576 order values per bucket


def _bucket(order: str, bits: int) -> Column:
    return F.shiftright(F.col(order), bits)


def _join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join on ``on`` with nulls equal; the columns of ``left``, then the others of ``right``."""
    side = right.select(*[F.col(c).alias(f"_right_{c}") if c in on else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_right_{c}"))
    return left.join(side, condition, how).drop(*[f"_right_{c}" for c in on])


def forward_fill(df: DataFrame, value: str, group: list[str], order: str,
                 out: str | None = None, bits: int = DEFAULT_BUCKET_BITS) -> DataFrame:
    """Last non-null ``value`` at or before each row, within ``group``, in ``order``.

    Rows whose group key is null are left as they are (never filled from
    another group).  ``order`` must be unique within a group.
    """
    out = out or value
    b = "_ff_bucket"
    rows = df.withColumn(b, _bucket(order, bits))
    local_w = (Window.partitionBy(*group, b).orderBy(order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_ff_local", F.last(value, ignorenulls=True).over(local_w))

    # One row per (group, bucket): the local fill of the bucket's last row is
    # the bucket's last marker.  Whole rows are compared and the join below is
    # null-safe, so neither pruning nor an added null filter makes this side
    # differ from the other: both read one exchange of the same scan.
    summary = (rows.groupBy(*group, b).agg(F.max_by(F.struct(*rows.columns), F.col(order)).alias("_ff_row"))
               .select(*group, b, F.col("_ff_row._ff_local").alias("_ff_last")))
    carry_w = Window.partitionBy(*group).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*group, b, F.last("_ff_last", ignorenulls=True).over(carry_w).alias("_ff_carry"))

    joined = _join_null_safe(rows, summary, [*group, b], "left")
    group_known = F.lit(True)
    for g in group:
        group_known = group_known & F.col(g).isNotNull()
    filled = F.when(group_known, F.coalesce(F.col("_ff_local"), F.col("_ff_carry"))).otherwise(F.col(value))
    keep = [c for c in df.columns if c != out]
    return joined.select(*keep, filled.alias(out))


def global_position(df: DataFrame, order: str, out: str = "pos",
                    bits: int = DEFAULT_BUCKET_BITS) -> DataFrame:
    """Zero-based position of each row in ``order`` (unique) over the whole frame.

    Counts per bucket are summed into offsets on a table of one row per
    bucket; positions inside a bucket come from a window over that bucket.
    """
    b = "_gp_bucket"
    rows = df.withColumn(b, _bucket(order, bits))
    in_bucket = Window.partitionBy(b).orderBy(order)
    rows = rows.withColumn("_gp_row", F.row_number().over(in_bucket))
    # The last row of a bucket holds its count (whole rows, as above).
    counts = (rows.groupBy(b).agg(F.max_by(F.struct(*rows.columns), F.col("_gp_row")).alias("_gp_last"))
              .select(b, F.col("_gp_last._gp_row").alias("_gp_n")))
    # One row per bucket: a global window over this table is small.
    offsets = counts.select(
        b, F.coalesce(F.sum("_gp_n").over(Window.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0)).alias("_gp_off"))
    return (_join_null_safe(rows, offsets, [b], "inner")
            .withColumn(out, F.col("_gp_off") + F.col("_gp_row") - 1)
            .drop(b, "_gp_off", "_gp_row"))


def range_position(rows: DataFrame, by: list[str], order: list[str], out: str = "pos",
                   range_rows: int = 1_000_000) -> DataFrame:
    """Zero-based place of each row among those with equal ``by``, in ``order``
    (any sortable columns; ties are placed one after the other).

    The rows are sorted into ranges of about ``range_rows``, written to the
    session's shared folder so that a range stays the same, and counted: a
    window runs over at most one range, and one row per range and group is
    summed across ranges.  So neither a large group nor a single one is
    gathered in a task.
    """
    spark = rows.sparkSession
    folder = work_dir(spark, "ranges")
    source = f"{folder}/rows"
    rows.write.parquet(source)          # the sampling of the ranges reads it again
    rows = spark.read.parquet(source)
    parts = 1 + rows.count() // range_rows
    (rows.repartitionByRange(parts, *by, *order).withColumn("_rp_part", F.spark_partition_id())
     .write.parquet(f"{folder}/placed"))
    placed = spark.read.parquet(f"{folder}/placed")
    remove_folder(spark, source)
    key = ["_rp_part", *by]
    before = Window.partitionBy(*by).orderBy("_rp_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*key).agg(F.count("*").alias("_rp_n"))
    offsets = counts.select(*key, F.coalesce(F.sum("_rp_n").over(before), F.lit(0)).alias("_rp_before"))
    inside = placed.withColumn("_rp_row", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return (_join_null_safe(inside, offsets, key, "inner")
            .withColumn(out, F.col("_rp_before") + F.col("_rp_row") - 1).drop("_rp_part", "_rp_row", "_rp_before"))
