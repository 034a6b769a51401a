"""Casts driven by the dictionary's validation type.

ANSI mode is on in Spark 4: a plain ``cast`` of bad text raises, which is
the strict behaviour the export loader wants for numbers (S15).  Dates are
lenient: an unparsable date becomes null and is counted by the reports.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Validation types cast to a number, validation types cast to
# a timestamp (the reference's conversion map), and the date layouts read.
NUMERIC_VTYPES = ("integer", "number", "number_1dp", "yesno")
DATE_VTYPES = ("date_mdy", "date_dmy")
# The date layouts read: year-month-day or year/month/day, eight digits, and
# month/day/year; fields of 1 or 2 digits; then optionally a time after a space
# or T, hour:minute with optional seconds and up to nine decimals of a second.
TIME_SHAPE = r"([ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]{1,9})?)?)?$"
ISO_DATE_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}" + TIME_SHAPE
OTHER_DATE_SHAPES = (
    (r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})", "$3-$1-$2"),
    (r"^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})", "$1-$2-$3"),
    (r"^([0-9]{4})([0-9]{2})([0-9]{2})", "$1-$2-$3"),
)

# Validation type -> Spark type.
TYPE_CONVERSIONS: dict[str, T.DataType] = {
    **{v: T.DoubleType() for v in NUMERIC_VTYPES},
    **{v: T.TimestampNTZType() for v in DATE_VTYPES},
}


def cast_date(c: Column) -> Column:
    """Text to timestamp; unparsable text (``2016-02-30``) becomes null.

    The text shape picks the layout, then Spark's own string-to-timestamp
    cast (no formatter, no exception per failed layout) reads it; an
    impossible date or time gives null.  Form dates carry no time zone, so
    the result is ``timestamp_ntz`` (independent of the session zone).
    """
    c = F.trim(c)
    out = F.when(c.rlike(ISO_DATE_SHAPE), c.try_cast("timestamp_ntz"))
    for shape, as_iso in OTHER_DATE_SHAPES:
        out = out.when(c.rlike(shape + TIME_SHAPE), F.regexp_replace(c, shape, as_iso).try_cast("timestamp_ntz"))
    return out


def strict_double(c: Column) -> Column:
    """Strict cast, bad text raises (ANSI)."""
    return c.cast(T.DoubleType())


def lenient_double(c: Column) -> Column:
    """S15 lenient option: bad text becomes null."""
    return c.try_cast(T.DoubleType())


def code_text(c: Column) -> Column:
    """A float code as integer text (``2.0`` -> ``'2'``, ``1.7`` -> ``'1'``)."""
    return c.try_cast("bigint").cast("string")


def kept_code_text(c: Column) -> Column:
    """Text of a code that is not recoded: integer text of a whole number,
    otherwise the value as it stands (``1.5`` -> ``'1.5'``)."""
    whole = c.try_cast("bigint")
    return F.coalesce(F.when(whole.cast("double") == c, whole.cast("string")), c.cast("string"))


_CANONICAL_INT = re.compile(r"-?(0|[1-9][0-9]*)")
_INT64 = (-(2 ** 63), 2 ** 63 - 1)


def known_code(c: Column, keys) -> Column:
    """True when the code text of ``c`` (S14) is one of ``keys``.

    Code text is always a canonical integer, so the test runs on the
    truncated number (no per-row string conversion): only canonical
    integer keys can ever match.  Null only when ``c`` is null; a code
    with no integer value is unknown.
    """
    nums = sorted({int(k) for k in keys if _CANONICAL_INT.fullmatch(k) and _INT64[0] <= int(k) <= _INT64[1]})
    if not nums:
        return F.when(c.isNotNull(), F.lit(False))
    return F.when(c.isNotNull(), F.coalesce(c.try_cast("bigint").isin(*nums), F.lit(False)))


def cast_by_vtype(c: Column, vtype: str | None, current: T.DataType | None = None,
                  strict: bool = True) -> Column | None:
    """The cast of one column for its validation type.

    Returns ``None`` when the type has no conversion (column untouched).
    """
    target = TYPE_CONVERSIONS.get(vtype or "")
    if target is None:
        return None
    if current is not None and current == target:
        return c
    if isinstance(target, T.TimestampNTZType):
        return cast_date(c) if isinstance(current, (T.StringType, type(None))) else c.cast(target)
    return strict_double(c) if strict else lenient_double(c)


# A number with any fixed count of decimals has numeric bounds too.
DECIMAL_VTYPE = r"^number_[0-9]+dp$"


def has_numeric_bounds(vtype: str | None) -> bool:
    """Whether bounds of this validation type are numbers (driver side)."""
    return vtype is not None and (vtype in NUMERIC_VTYPES or re.fullmatch(DECIMAL_VTYPE.strip("^$"), vtype) is not None)


def typed_bound_num(vtype: Column, raw: Column) -> Column:
    """Numeric bound for numeric validation types, else null."""
    return F.when(vtype.isin(*NUMERIC_VTYPES) | vtype.rlike(DECIMAL_VTYPE), raw.try_cast("double"))


def typed_bound_ts(vtype: Column, raw: Column) -> Column:
    """Timestamp bound for date validation types, else null."""
    return F.when(vtype.isin(*DATE_VTYPES), cast_date(raw))
