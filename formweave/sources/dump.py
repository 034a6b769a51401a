"""The wide export ("dump").

The header line and the dictionary give the schema, so the CSV is read in
one typed pass (no ``inferSchema``).  NaN doubles become null, date
fields become timestamps (N5), and a profile may drop rows with a null
key (P4).  Nothing is sorted here: order is applied only when writing.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formweave.functions.nulls import nan_to_null
from formweave.operators.typing import dump_schema, recast
from formweave.plans.compiled import CompiledDictionary
from formweave.sources.compression import readable_paths
from formweave.sources.dictionary import EmptyInputError


def load_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None,
             repartition: int | None = None, sniff: bool = True, **options) -> DataFrame:
    """T4: CSV with a header; compression is told by content, whatever the
    files are called (``sniff=False`` trusts the names).

    Raises on an empty file (Spark itself returns an empty schema).  A
    gzip file is one task; ``repartition`` spreads the rows after the read.
    """
    if sniff:
        path = readable_paths(spark, path)
    reader = spark.read.option("header", True).option("escape", '"')
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        # Spark then compares every file's header with the schema, so files
        # whose columns are in another order fail instead of being swapped.
        reader = reader.schema(schema).option("enforceSchema", False)
    df = reader.csv(path)
    if not df.columns:
        raise EmptyInputError(f"file was empty: {path}")
    if repartition:
        df = df.repartition(repartition)
    return df


def read_header(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names from the first line of the export (one short read)."""
    first = spark.read.text(path).first()
    if first is None or not first[0].strip():
        raise EmptyInputError(f"file was empty: {path}")
    return next(csv.reader(io.StringIO(first[0])))


def normalize_nulls(df: DataFrame) -> DataFrame:
    """NaN doubles to null, one ``select``."""
    exprs = [nan_to_null(F.col(c)).alias(c) if isinstance(df.schema[c].dataType, T.DoubleType) else F.col(c)
             for c in df.columns]
    return df.select(*exprs)


def read_dump(spark: SparkSession, path: str | list[str], compiled: CompiledDictionary,
              keys: Iterable[str] = (), allowed_extra: Iterable[str] = (),
              drop_null_keys: bool = False, unknown_type: str = "raise",
              strict: bool = True, repartition: int | None = None,
              multi_line: bool = False, recast_dates: bool = True) -> tuple[DataFrame, dict]:
    """Typed export read.

    Returns the frame and a report dict (``column_types``, ``missing_dates``).
    ``recast_dates=False`` leaves date fields as text (to be reported on
    first).  Every file must have the header of the first one.
    ``strict`` fails the read on a cell that does not fit its type.
    ``multi_line`` accepts newlines inside quoted cells (free-text notes);
    each file is then parsed by one task, so split large exports into many
    files (or ``repartition``) when using it.
    """
    path = readable_paths(spark, path)
    header = read_header(spark, path)
    schema, rtypes = dump_schema(header, compiled, allowed_extra, unknown_type=unknown_type)
    df = load_csv(spark, path, schema=schema, repartition=repartition, sniff=False,
                  mode="FAILFAST" if strict else "PERMISSIVE", multiLine=multi_line)
    df = normalize_nulls(df)
    typed, missing = recast(df, compiled)
    df = typed if recast_dates else df
    if drop_null_keys:
        df = drop_null_key(df, list(keys))
    return df, {"column_types": rtypes, "missing_dates": missing}


def drop_null_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key columns are all set."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.filter(cond)


def drop_all_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows whose ``cols`` are all null (NaN counts as null)."""
    return df.na.drop(how="all", subset=cols) if cols else df
