"""Two-valued membership and null replacement.

Spark's ``isin`` is three-valued (null in, null out); the export helpers
are two-valued, so nulls are folded to ``False``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_in(c: Column, values) -> Column:
    """``True`` when ``c`` is one of ``values``, never null."""
    return F.coalesce(c.isin(*values), F.lit(False))


def not_in(c: Column, values) -> Column:
    """``True`` when ``c`` is not one of ``values`` (null counts as not in)."""
    return ~is_in(c, values)


def nan_to_null(c: Column) -> Column:
    """A NaN double becomes null (NaN is not null in Spark)."""
    return F.nanvl(c, F.lit(None).cast(T.DoubleType()))


def nan_to_str(c: Column, replacement: str = "", numeric: bool = False) -> Column:
    """Null (or NaN for doubles) becomes ``replacement``."""
    src = nan_to_null(c).cast("string") if numeric else c
    return F.coalesce(src, F.lit(replacement))
