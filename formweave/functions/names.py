"""Column-name helpers.

Checkbox options of a field ``base`` are exported as one column per
option, ``base___code``; a negative code keeps its minus sign as an
underscore (``race____1`` is option ``-1`` of ``race``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator between a checkbox field and its option code.
CHECKBOX_SEP = "___"


def base_name(c: Column) -> Column:
    """Text before the first ``___`` (the whole text when absent)."""
    return F.substring_index(c, CHECKBOX_SEP, 1)


def checkbox_code(c: Column) -> Column:
    """Option code of a ``base___code`` name, ``_`` read as ``-``."""
    return F.regexp_replace(F.get(F.split(c, CHECKBOX_SEP), 1), "_", "-")


def py_base_name(name: str) -> str:
    """Driver-side twin of :func:`base_name` for column-name lists."""
    return name.split(CHECKBOX_SEP)[0]


def py_checkbox_code(name: str) -> str | None:
    """Driver-side twin of :func:`checkbox_code`; ``None`` for a bare name."""
    parts = name.split(CHECKBOX_SEP)
    return parts[1].replace("_", "-") if len(parts) > 1 else None


def is_checkbox_column(name: str, base: str) -> bool:
    """P5: a ``base___code`` column of ``base``."""
    return CHECKBOX_SEP in name and py_base_name(name) == base


def child_table_name(parent: str, base: str) -> str:
    """Name of the child table holding the ticked options of ``base``."""
    return f"{parent}_{base}"
