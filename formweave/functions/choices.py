"""Choice-list parsing as column expressions.

A choice list reads ``'0, No | 1, Yes | 2, Black, or AA'``: items split on
``|``, each item is ``code, label``; the code is a run of digits and minus
signs, the label is the rest of the item (commas included), right-trimmed.
The parse stays inside Spark: ``split`` + ``transform`` produce an array of
items per dictionary row, so no shuffle is needed to keep the last label of
a duplicated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default choice list of a yes/no field, and the patterns
# of one choice item.
YESNO_CHOICES = "0, No | 1, Yes"
ITEM_CODE_RE = r"^\s*([-0-9]+)\s*,"
ITEM_LABEL_RE = r"(?s)^\s*[-0-9]+\s*,\s*(.*?)\s*$"
ITEM_VALID_RE = r"(?s)^\s*[-0-9]+\s*,\s*\S"
STRICT_CODE_RE = r"^[+-]?[0-9]+$"


def is_null_text(c: Column) -> Column:
    """Null, or the text ``nan`` in any case (how a missing cell prints)."""
    return c.isNull() | (F.upper(c) == F.lit("NAN"))


def default_yesno(ftype: Column, choices: Column) -> Column:
    """A ``yesno`` field without a choice list gets ``0, No | 1, Yes``."""
    return F.when((ftype == "yesno") & is_null_text(choices), F.lit(YESNO_CHOICES)).otherwise(choices)


def parse_items(choices: Column) -> Column:
    """All items of a choice list as ``array<struct<pos, item, code, label, valid, blank>>``."""
    items = F.split(choices, r"\|")

    def one(x, i):
        return F.struct(
            i.alias("pos"),
            x.alias("item"),
            F.regexp_extract(x, ITEM_CODE_RE, 1).alias("code"),
            F.regexp_extract(x, ITEM_LABEL_RE, 1).alias("label"),
            x.rlike(ITEM_VALID_RE).alias("valid"),
            (F.trim(x) == F.lit("")).alias("blank"),
        )

    return F.transform(items, one)


def sorted_valid_items(parsed: Column) -> Column:
    """Valid items as ``array<struct<code, pos, label>>`` in order of code and
    position.  Select it under a name before :func:`last_of_code`, so that
    the list is parsed and sorted once."""
    return F.array_sort(F.transform(F.filter(parsed, lambda p: p["valid"]),
                                    lambda p: F.struct(p["code"].alias("code"), p["pos"].alias("pos"), p["label"].alias("label"))))


def last_of_code(items: Column) -> Column:
    """From sorted items the last one of each code (last wins)."""
    return F.filter(items, lambda p, i: ~F.coalesce(F.get(items, i + 1)["code"] == p["code"], F.lit(False)))


def malformed_items(parsed: Column) -> Column:
    """Items that are neither blank nor ``code, label`` (reported by V5)."""
    return F.filter(parsed, lambda p: ~p["valid"] & ~p["blank"])


def parse_items_strict(choices: Column) -> Column:
    """S18 items: exactly one comma per item, integer code, trimmed label."""
    items = F.split(choices, r"\|")

    def one(x, i):
        parts = F.split(F.trim(x), ",")
        code_txt = F.trim(F.get(parts, 0))
        ok = (F.size(parts) == 2) & code_txt.rlike(STRICT_CODE_RE)
        return F.struct(
            i.alias("pos"),
            F.when(ok, code_txt.try_cast("bigint")).alias("code"),
            F.when(ok, F.trim(F.get(parts, 1))).alias("label"),
            ok.alias("valid"),
        )

    return F.transform(items, one)
