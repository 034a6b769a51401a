"""Branching-logic graph.

Every field without logic hangs below ``start``; every variable its logic
references points to it.  Edges are a distributed ``(src, dst, label)``
table; duplicates collapse in one ``distinct`` (hashing on the whole
edge, so a variable referenced by many fields spreads over tasks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.functions.logic import has_logic, logic_tokens, logic_values, logic_variables

# Fixed value: the root node.
START = "start"


def raw_edges(dd: DataFrame) -> DataFrame:
    """G1: ``(field_name, branch_logic)``."""
    return dd.select(F.col("field").alias("field_name"), F.col("logic").alias("branch_logic"))


def split_by_logic(dd: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fields without logic, fields with logic."""
    return dd.filter(~has_logic(F.col("logic"))), dd.filter(has_logic(F.col("logic")))


def top_level_edges(dd: DataFrame) -> DataFrame:
    """``start -> field`` for fields without logic."""
    top, _ = split_by_logic(dd)
    return top.select(F.lit(START).alias("src"), F.col("field").alias("dst"), F.lit("").alias("label"))


def lower_edges(dd: DataFrame) -> DataFrame:
    """G3 + G5: ``variable -> field`` for each variable in the field's logic."""
    _, lower = split_by_logic(dd)
    return lower.select(F.explode(logic_variables(F.col("logic"))).alias("src"),
                        F.col("field").alias("dst"), F.lit("").alias("label"))


def build_graph(dd: DataFrame) -> DataFrame:
    """All unique edges (G2 and G5 from one scan of the dictionary)."""
    logic, field = F.col("logic"), F.col("field")

    def edge(src):
        return F.struct(src.alias("src"), field.alias("dst"), F.lit("").alias("label"))

    edges = (F.when(has_logic(logic), F.transform(logic_variables(logic), edge))
             .otherwise(F.array(edge(F.lit(START)))))
    return dd.select(F.inline(edges)).distinct()


def logic_value_table(dd: DataFrame) -> DataFrame:
    """``(field, pos, value)`` for each compared value in the logic."""
    _, lower = split_by_logic(dd)
    return lower.select("field", F.posexplode(logic_values(F.col("logic"))).alias("pos", "value")) \
        .select("field", F.col("pos").cast("bigint").alias("pos"), "value")


def logic_token_table(dd: DataFrame) -> DataFrame:
    """``(field, pos, kind, op, text)``: every token of every field's logic."""
    _, lower = split_by_logic(dd)
    return lower.select("field", F.posexplode(logic_tokens(F.col("logic"))).alias("pos", "t")) \
        .select("field", F.col("pos").cast("bigint").alias("pos"), "t.kind", "t.op", "t.text")
