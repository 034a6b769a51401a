"""Path and file-name functions of the asset table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    """Last path segment."""
    return F.element_at(F.split(path, "/"), -1)


def directory(path: Column) -> Column:
    """Path without its last segment."""
    return F.regexp_replace(path, "/[^/]*$", "")


def stem(name: Column) -> Column:
    """File name without its last suffix (``a.vcf.gz`` -> ``a.vcf``).

    A leading dot (``.bashrc``) or a trailing dot (``a.``) is not a suffix.
    """
    return F.when(name.rlike(r"^.+\.[^.]+$"), F.regexp_replace(name, r"\.[^.]+$", "")).otherwise(name)


def path_hash(path: Column) -> Column:
    """Reproducible 64-bit hash of the full path."""
    return F.xxhash64(path)


def subject_from_second_token(name: Column) -> Column:
    """Second ``_`` token of a file name, then trailing ``P``, ``M``,
    ``D`` and ``F`` runs stripped in that order (``123FPM`` -> ``123FP``)."""
    return F.regexp_replace(F.get(F.split(name, "_"), 1), "F*D*M*P*$", "")


# batch code -> subject parser over the file-name column.
# Fixed value: the one batch code whose file names carry the subject id as
# their second ``_`` token.
SUBJECT_PARSERS: dict[str, Callable[[Column], Column]] = {
    "REGENERON1": subject_from_second_token,
}
