"""Validation (V1-V8, AG5).

Row checks are column expressions.  A report counts, in one grouped
aggregate per export, the cells ``(field, rule)`` that rows fail.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formweave.functions.casts import DATE_VTYPES, cast_date, has_numeric_bounds, kept_code_text, known_code
from formweave.operators.metadata import malformed_choices
from formweave.plans.compiled import CompiledDictionary

# Validation kinds read as numbers.
NUMERIC_KINDS = ("integer", "number")


class ValidationError(ValueError):
    """A value check failed (V7, V8)."""


def is_number_ndp(c: Column, decimals: int) -> Column:
    """V1: integer part, and exactly ``decimals`` decimals when a dot is present.

    Null passes.
    """
    pattern = rf"^[+-]?[0-9]+(\.[0-9]{{{int(decimals)}}})?$"
    return F.coalesce(c.cast("string").rlike(pattern), F.lit(True))


def parse_vtype(vtype: Column) -> Column:
    """V2: ``number_1dp`` -> ``struct<kind: 'number', decimals: 1>``."""
    return F.struct(
        F.regexp_replace(vtype, r"_[0-9]+dp.*$", "").alias("kind"),
        F.regexp_extract(vtype, r"_([0-9]+)dp", 1).try_cast("int").alias("decimals"),
    )


def py_parse_vtype(vtype: str | None) -> tuple[str | None, int | None]:
    """Driver-side twin of :func:`parse_vtype`."""
    import re
    if vtype is None:
        return None, None
    m = re.search(r"_([0-9]+)dp", vtype)
    return re.sub(r"_[0-9]+dp.*$", "", vtype), (int(m.group(1)) if m else None)


def in_range(c: Column, lo=None, hi=None) -> Column:
    """V3: inside ``[lo, hi]``; a null bound is open, a null value passes."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return F.coalesce(cond, F.lit(True))


# Up to this many cells are summed side by side in one aggregate; a wider
# report counts the numbers of the cells that rows fail.
SUMMED_CELLS = 96


def _tall(df: DataFrame, cells: list[tuple[str, str, Column]]) -> DataFrame:
    """``(field, rule, n_bad)`` of all cells, zeros included, from one scan.

    Few cells are conditional counts of one aggregate, one row a task.  With
    many (thousands of columns), each row gives the numbers of the cells it
    fails, which are counted with map-side combine: the plan then has one
    grouped count however many fields and rules there are.  Both give the
    same rows.
    """
    spark = df.sparkSession
    if not cells:
        return spark.createDataFrame([], "field string, rule string, n_bad bigint")
    if len(cells) <= SUMMED_CELLS:
        row = df.agg(*[F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(cells)])
        return row.select(F.inline(F.array(*[
            F.struct(F.lit(f).alias("field"), F.lit(r).alias("rule"), F.col(f"n{i}").alias("n_bad"))
            for i, (f, r, _) in enumerate(cells)])))
    failed = F.array(*[F.when(bad, F.lit(i)) for i, (_, _, bad) in enumerate(cells)])
    # The array is a column of its own: an expression inside ``explode`` is
    # interpreted, one that is projected is compiled and shares what its cells
    # repeat, unless it has a lambda function (``array_compact`` is one); so the
    # nulls of cells that pass are dropped after it.  The outer form keeps Spark
    # from filtering by the whole array first.
    counts = (df.select(failed.alias("cells")).select(F.explode_outer("cells").alias("cell"))
              .where(F.col("cell").isNotNull()).groupBy("cell").agg(F.count("*").alias("n")))
    names = spark.createDataFrame([(i, f, r) for i, (f, r, _) in enumerate(cells)], "cell int, field string, rule string")
    return (names.join(counts, "cell", "left")
            .select("field", "rule", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_bad")))


def numeric_bounds(validation: DataFrame, columns: list[str]) -> dict[str, tuple]:
    """Typed numeric bounds (N7) of the given export columns, on the driver.

    Bounded by the export's width, like the metadata compile.
    """
    rows = validation.filter(F.col("field").isin(*columns)).select("field", "min_num", "max_num").collect()
    return {r["field"]: (r["min_num"], r["max_num"]) for r in rows}


def range_report(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """V3 report: ``(field, n_values, n_out_of_range)`` for numeric bounds."""
    aggs, names = [], []
    for i, (c, (lo, hi)) in enumerate(bounds.items()):
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.count_if(v.isNotNull() & ~in_range(v, lo, hi)).alias(f"b{i}")]
        names.append(c)
    row = df.agg(*aggs)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(f"n{i}").cast("bigint").alias("n_values"),
                 F.col(f"b{i}").cast("bigint").alias("n_out_of_range")) for i, c in enumerate(names)])))


def required_report(df: DataFrame, compiled: CompiledDictionary) -> DataFrame:
    """V4: ``(field, rule='required', n_bad)``: nulls of required fields present in ``df``."""
    cells = [(f, "required", F.col(f).isNull()) for f in compiled.required() if f in df.columns]
    return _tall(df, cells)


def recode_report(df: DataFrame, compiled: CompiledDictionary) -> DataFrame:
    """V5: unknown codes per coded column, unparsable dates per date column."""
    cells = []
    for c in df.columns:
        if c in compiled.choices and isinstance(df.schema[c].dataType, T.NumericType):
            cells.append((c, "unknown_code", F.col(c).isNotNull() & ~known_code(F.col(c), compiled.choices[c])))
        elif (compiled.vtype(c) or "").startswith("date") and isinstance(df.schema[c].dataType, T.StringType):
            cells.append((c, "bad_date", F.col(c).isNotNull() & cast_date(F.col(c)).isNull()))
    return _tall(df, cells)


def column_rules(df: DataFrame, compiled: CompiledDictionary) -> list[tuple[str, str, Column]]:
    """V6 cells: per column its applicable rules, each a 'bad row' predicate."""
    cells: list[tuple[str, str, Column]] = []
    for c in df.columns:
        meta = compiled.fields.get(c)
        if meta is None:
            continue
        col = F.col(c)
        is_text = isinstance(df.schema[c].dataType, T.StringType)
        if c in compiled.choices and isinstance(df.schema[c].dataType, T.NumericType):
            cells.append((c, "choice", col.isNotNull() & ~known_code(col, compiled.choices[c])))
        kind, decimals = py_parse_vtype(meta.vtype)
        if kind in NUMERIC_KINDS:
            num = col.try_cast("double") if is_text else col.cast("double")
            cells.append((c, "type", col.isNotNull() & num.isNull()))
            if decimals is not None:
                cells.append((c, "decimals", ~is_number_ndp(col, decimals)))
            lo, hi = (_num(b) if has_numeric_bounds(meta.vtype) else None for b in (meta.vmin, meta.vmax))
            if lo is not None or hi is not None:
                cells.append((c, "range", num.isNotNull() & ~in_range(num, lo, hi)))
        elif kind is not None and kind.startswith("date"):
            ts = cast_date(col) if is_text else col
            cells.append((c, "type", col.isNotNull() & ts.isNull()))
            bounds = [(b, low) for b, low in ((meta.vmin, True), (meta.vmax, False)) if b is not None] \
                if meta.vtype in DATE_VTYPES else []
            if bounds:
                outside = F.lit(False)
                for text, low in bounds:        # a bound that is no date is open, as in N7
                    bound = cast_date(F.lit(text))
                    outside = outside | F.coalesce(ts < bound if low else ts > bound, F.lit(False))
                cells.append((c, "range", outside))
        if meta.required:
            cells.append((c, "required", col.isNull()))
    return cells


# registry of extra per-column checks, column -> {rule name: bad-row
# predicate builder}.  ``check_columns`` adds every registered rule of a
# column present in the frame.
COLUMN_CHECKS: dict[str, dict[str, Callable[[Column], Column]]] = {}


def register_check(column: str, rule: str, bad: Callable[[Column], Column],
                   registry: dict | None = None) -> None:
    """Register ``bad(col)`` (true on a failing row) as rule ``rule`` of ``column``."""
    reg = COLUMN_CHECKS if registry is None else registry
    reg.setdefault(column, {})[rule] = bad


def decimals_check(decimals: int) -> Callable[[Column], Column]:
    """A registrable check: the value must have ``decimals`` decimal places when it has any."""
    return lambda c: ~is_number_ndp(c, decimals)


def _num(text: str | None):
    try:
        return float(text) if text is not None else None
    except ValueError:
        return None


def _all_rules(df: DataFrame, compiled: CompiledDictionary, extra_checks) -> list[tuple[str, str, Column]]:
    """The cells of :func:`column_rules` and those of the registered checks."""
    cells = column_rules(df, compiled)
    checks = COLUMN_CHECKS if extra_checks is None else extra_checks
    for c, rules in checks.items():
        if c in df.columns:
            for rule, bad in rules.items():
                cells.append((c, rule, F.coalesce(bad(F.col(c)), F.lit(False))))
    return cells


def check_columns(df: DataFrame, compiled: CompiledDictionary,
                  extra_checks: Mapping[str, Mapping[str, Callable[[Column], Column]]] | None = None) -> DataFrame:
    """V6: ``(field, rule, n_bad)`` for every applicable rule of every column.

    ``extra_checks`` (default: the :data:`COLUMN_CHECKS` registry) adds
    user rules; all rules are counted by the same aggregate.  Run it on the
    export as read, with dates as text, so that bad dates are counted too.
    """
    return _tall(df, _all_rules(df, compiled, extra_checks))


def offending_values(df: DataFrame, compiled: CompiledDictionary, dictionary: DataFrame | None = None,
                     extra_checks: Mapping[str, Mapping[str, Callable[[Column], Column]]] | None = None) -> DataFrame:
    """V5: the values behind :func:`check_columns`, ``(field, rule, value, n)``.

    One row per distinct value that fails a rule of a column, with the number
    of rows that hold it; per (field, rule) these add up to ``n_bad``.  A code
    is shown as in the export (``9``, ``1.5``); a missing value is null.  With
    ``dictionary``, malformed items of choice lists are rows of the rule
    ``malformed_choice``.

    One scan; the count is exact and has two stages (tasks count their own
    values before the shuffle, which deals whole (field, rule, value) keys), so
    neither a value nor a field that fails everywhere gathers rows in a task.
    """
    spark = df.sparkSession
    cells = []
    for c, rule, bad in _all_rules(df, compiled, extra_checks):
        shown = kept_code_text(F.col(c)) if isinstance(df.schema[c].dataType, T.NumericType) else F.col(c).cast("string")
        cells.append(F.when(bad, F.struct(F.lit(c).alias("field"), F.lit(rule).alias("rule"), shown.alias("value"))))
    if cells:
        rows = (df.select(F.array(*cells).alias("cells"))      # compiled, as above
                .select(F.inline_outer("cells")).where("field is not null"))
    else:
        rows = spark.createDataFrame([], "field string, rule string, value string")
    if dictionary is not None:
        rows = rows.unionByName(malformed_choices(dictionary).select(
            "field", F.lit("malformed_choice").alias("rule"), F.col("item").alias("value")))
    return rows.groupBy("field", "rule", "value").agg(F.count("*").alias("n"))


def top_offenders(values: DataFrame, k: int = 10, salts: int = 64) -> DataFrame:
    """The ``k`` most frequent values of each (field, rule) of
    :func:`offending_values`, for display, with their ``place`` from 1; ties by
    value, null first.

    A field may fail with as many values as there are rows (free text), so the
    values are ranked within ``salts`` hash parts first, and only ``k`` of each
    part are ranked together.
    """
    order = [F.col("n").desc(), F.col("value").asc_nulls_first()]
    within = Window.partitionBy("field", "rule", "_salt").orderBy(*order)
    some = (values.withColumn("_salt", F.pmod(F.xxhash64("value"), F.lit(salts)))
            .withColumn("_place", F.row_number().over(within)).where(F.col("_place") <= k))
    place = F.row_number().over(Window.partitionBy("field", "rule").orderBy(*order))
    return (some.withColumn("place", place.cast("bigint")).where(F.col("place") <= k)
            .select("field", "rule", "place", "value", "n"))


def all_true(df: DataFrame, check: Column) -> Column:
    """AG5 as a lazy scalar: true when ``check`` holds on every row."""
    return df.agg(F.coalesce(F.bool_and(F.coalesce(check, F.lit(False))), F.lit(True))).scalar()


def verify_all(df: DataFrame, check: Column, what: str = "check") -> DataFrame:
    """V7: raise :class:`ValidationError` unless ``check`` holds on every row."""
    bad = df.agg(F.count_if(~F.coalesce(check, F.lit(False))).alias("n")).first()["n"]
    if bad:
        raise ValidationError(f"{what}: {bad} rows failed")
    return df
