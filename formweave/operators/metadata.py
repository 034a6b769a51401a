"""Operators over the (prepared) dictionary: choices, validation bounds,
field map, counts, positions and field subsets.

All of them are distributed plans: a dictionary derived from a big table
can be big, so nothing here collects.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.functions import choices as ch
from formweave.functions.casts import DATE_VTYPES, NUMERIC_VTYPES, typed_bound_num, typed_bound_ts
from formweave.functions.names import base_name
from formweave.plans.ordering import global_position


# --- P-ops on metadata ---------------------------------------------------

def choice_fields(dd: DataFrame) -> DataFrame:
    """Not ``calc`` (null type kept) and a choice list present."""
    return dd.filter(F.coalesce(F.col("ftype") != "calc", F.lit(True)) & F.col("choices").isNotNull())


def required_fields(dd: DataFrame) -> DataFrame:
    """P10: fields marked required (``y``)."""
    return dd.filter(F.col("required") == "y").select("ord", "field")


def date_fields(dd: DataFrame) -> DataFrame:
    """Fields whose validation type starts with ``date``."""
    return dd.filter(F.col("vtype").startswith("date")).select("ord", "field", "vtype")


def fields_by_names(dd: DataFrame, names: DataFrame | Iterable[str], spark: SparkSession | None = None,
                    name_col: str = "name") -> DataFrame:
    """Dictionary rows of the given export column names (by base name).

    ``names`` is a frame with a ``name`` column or a list of names.
    """
    if not isinstance(names, DataFrame):
        spark = spark or dd.sparkSession
        names = spark.createDataFrame([(n,) for n in names], f"{name_col} string")
    bases = names.select(base_name(F.col(name_col)).alias("field")).distinct()
    return dd.join(bases, on="field", how="left_semi")


def field_position(dd: DataFrame, out: str = "pos") -> DataFrame:
    """Zero-based position of each field in dictionary order."""
    return global_position(dd, order="ord", out=out)


def fields_by_span(dd: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """Fields at positions ``[start, end)``."""
    pos = field_position(dd)
    cond = F.col("pos") >= start
    if end is not None:
        cond = cond & (F.col("pos") < end)
    return pos.filter(cond)


def fields_by_type(dd: DataFrame) -> DataFrame:
    """Each field with a flag telling checkbox from the rest."""
    return dd.select("ord", "field", F.coalesce(F.col("ftype") == "checkbox", F.lit(False)).alias("is_checkbox"))


def type_counts(dd: DataFrame) -> DataFrame:
    """AG1: number of fields per field type, most frequent first; null types not counted."""
    return (dd.filter(F.col("ftype").isNotNull()).groupBy("ftype")
            .agg(F.count(F.lit(1)).alias("n_fields"))
            .orderBy(F.col("n_fields").desc(), F.col("ftype")))


def field_subset(dd: DataFrame, names: DataFrame | Iterable[str] | None = None,
                 start: int | None = None, end: int | None = None) -> dict[str, DataFrame]:
    """P13-P15 + AG1 bundle: the dictionary rows behind export column names
    (or a position span), their type counts, all fields, checkbox fields
    and the other fields, each as a lazy frame."""
    if names is not None:
        sub = fields_by_names(dd, names)
    elif start is not None:
        sub = fields_by_span(dd, start, end).drop("pos")
    else:
        sub = dd
    flags = fields_by_type(sub)
    return {
        "dd": sub,
        "type_counts": type_counts(sub),
        "fields": sub.select("ord", "field"),
        "checkboxes": flags.filter("is_checkbox").select("ord", "field"),
        "not_checkboxes": flags.filter("not is_checkbox").select("ord", "field"),
    }


# --- N6 / S17 / S18: choice tables ----------------------------------------

def choice_table(dd: DataFrame) -> DataFrame:
    """Tall ``(field, code, label)`` table of every choice field.

    Duplicate codes keep the last label; malformed items are left out here
    and reported by :func:`malformed_choices`.  No shuffle: the parse and
    the de-duplication happen inside each dictionary row.
    """
    items = choice_fields(dd).select("field", ch.sorted_valid_items(ch.parse_items(F.col("choices"))).alias("_items"))
    return items.select("field", F.inline(ch.last_of_code(F.col("_items")))).select("field", "code", "label")


def malformed_choices(dd: DataFrame) -> DataFrame:
    """V5 input: items of a choice list that are not ``code, label``."""
    parsed = ch.parse_items(F.col("choices"))
    return (choice_fields(dd)
            .select("field", F.inline(ch.malformed_items(parsed)))
            .select("field", F.col("pos").cast("bigint").alias("pos"), "item"))


def choice_table_strict(dd: DataFrame) -> DataFrame:
    """Strict parse; integer codes, one comma per item.

    A field with any unparsable item yields no rows (the strict parser
    fails for the whole list); duplicate codes keep the last label.
    """
    parsed = ch.parse_items_strict(F.col("choices"))
    ok = choice_fields(dd).select("field", parsed.alias("_all")).filter(F.forall("_all", lambda p: p["valid"]))
    items = ok.select("field", ch.sorted_valid_items(F.col("_all")).alias("_items"))
    return items.select("field", F.inline(ch.last_of_code(F.col("_items")))).select("field", "code", "label")


# --- N7 -------------------------------------------------------------------

def validation_table(dd: DataFrame, missing_types: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """``(field, vtype, vmin, vmax, min_num, max_num, min_ts, max_ts)``.

    Rows with no validation information are dropped, then the listed fields
    get the given type (the Registry lists its lab fields as ``number``);
    bounds are typed by the validation type, an uncastable bound is null.
    """
    vtype = F.col("vtype")
    listed = F.lit(False)
    for typ, fields in (missing_types or {}).items():
        fields = list(fields)
        if fields:
            hit = F.col("field").isin(*fields)
            vtype = F.when(hit, F.lit(typ)).otherwise(vtype)
            listed = listed | hit
    any_info = F.col("vtype").isNotNull() | F.col("vmin").isNotNull() | F.col("vmax").isNotNull()
    v = dd.filter(any_info | listed).select("field", vtype.alias("vtype"), "vmin", "vmax")
    return v.select(
        "field", "vtype", "vmin", "vmax",
        typed_bound_num(F.col("vtype"), F.col("vmin")).alias("min_num"),
        typed_bound_num(F.col("vtype"), F.col("vmax")).alias("max_num"),
        typed_bound_ts(F.col("vtype"), F.col("vmin")).alias("min_ts"),
        typed_bound_ts(F.col("vtype"), F.col("vmax")).alias("max_ts"),
    )


# --- U4 -------------------------------------------------------------------

def field_map(dd: DataFrame) -> DataFrame:
    """U4: ``(key, value)``: name -> label and label -> name in one map.

    Later entries win: all name entries first, then label entries, each in
    dictionary order.  Null keys are left out.  One aggregate with
    map-side combine, so a label shared by many fields does not pile up.
    """
    entries = F.array(
        F.struct(F.col("field").alias("key"), F.col("label").alias("value"), F.lit(0).alias("dir"), F.col("ord")),
        F.struct(F.col("label").alias("key"), F.col("field").alias("value"), F.lit(1).alias("dir"), F.col("ord")))
    both = dd.select(F.inline(entries)).filter(F.col("key").isNotNull())  # one scan, two entries per row
    return both.groupBy("key").agg(F.max_by("value", F.struct("dir", "ord")).alias("value"))


__all__ = [
    "choice_fields", "required_fields", "date_fields", "fields_by_names", "field_position",
    "fields_by_span", "fields_by_type", "field_subset", "type_counts", "choice_table", "malformed_choices",
    "choice_table_strict", "validation_table", "field_map", "NUMERIC_VTYPES", "DATE_VTYPES",
]
