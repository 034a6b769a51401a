"""S16, AG4: categories as dense codes.

The categories of a column are its distinct values in order of their code
points; a value's code is its place among them, from 0, and a missing value
has the code -1.  The dictionary of all columns is one table: distinct values
come from one scan, and their places from ranges of the sorted values, so a
column with very many values (free text) is sorted by many tasks.  Encoding
and decoding are joins with that table, which Spark broadcasts if it is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.plans.ordering import range_position

NULL_CODE = -1


def value_dictionary(df: DataFrame, columns: list[str], range_rows: int = 1_000_000) -> DataFrame:
    """``(column_name, value, code)``: the categories of ``columns`` as text."""
    stacked = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(stacked)).where("value is not null").distinct()
    return range_position(values, ["column_name"], ["value"], out="code", range_rows=range_rows)


def encode(df: DataFrame, columns: list[str], dictionary: DataFrame) -> DataFrame:
    """``df`` with the codes of ``columns`` in place of their values.  A value
    that the dictionary lacks is an error: it would become a missing one."""
    out = df
    for c in columns:
        side = dictionary.where(F.col("column_name") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        found = (F.when(F.col(c).isNull(), F.lit(NULL_CODE)).when(F.col("_code").isNotNull(), F.col("_code"))
                 .otherwise(F.raise_error(F.concat(F.lit(f"{c} has a value without a code: "), F.col(c).cast("string")))))
        out = (out.join(side, F.col(c).cast("string") == F.col("_value"), "left")
               .withColumn(c, found.cast("bigint")).drop("_value", "_code"))
    return out


def decode(df: DataFrame, columns: list[str], dictionary: DataFrame) -> DataFrame:
    """The values (as text) of the codes in ``columns``."""
    out = df
    for c in columns:
        side = dictionary.where(F.col("column_name") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        out = out.join(side, F.col(c) == F.col("_code"), "left").withColumn(c, F.col("_value")).drop("_value", "_code")
    return out
