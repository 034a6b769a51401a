"""The data dictionary, one row per field, in file order.

Columns are renamed from the export's long headers to short names (P7);
``ord`` keeps the file order, which Spark does not.  The dictionary may be
large (a derived dictionary grows with its source table), so every step is
a distributed plan; nothing is collected here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formweave.functions.choices import default_yesno
from formweave.plans.ordering import forward_fill
from formweave.sources.compression import readable_paths

# The export's dictionary headers and our short names.
DICT_HEADERS = {
    "Variable / Field Name": "field",
    "Form Name": "form",
    "Section Header": "hdr",
    "Field Type": "ftype",
    "Field Label": "label",
    "Choices, Calculations, OR Slider Labels": "choices",
    "Field Note": "note",
    "Text Validation Type OR Show Slider Number": "vtype",
    "Text Validation Min": "vmin",
    "Text Validation Max": "vmax",
    "Identifier?": "identifier",
    "Branching Logic (Show field only if...)": "logic",
    "Required Field?": "required",
    "Custom Alignment": "alignment",
    "Question Number (surveys only)": "question_number",
    "Matrix Group Name": "matrix_group",
    "Matrix Ranking?": "matrix_ranking",
    "Field Annotation": "annotation",
}
# Columns every prepared dictionary carries (missing ones become null).
CORE_COLUMNS = ("ord", "field", "form", "hdr", "ftype", "label", "choices",
                "vtype", "vmin", "vmax", "logic", "required")


class EmptyInputError(ValueError):
    """A CSV input had no header and no rows."""


def rename_headers(df: DataFrame) -> DataFrame:
    """Long export headers to short names (unknown headers kept)."""
    mapping = {c: DICT_HEADERS[c] for c in df.columns if c in DICT_HEADERS}
    return df.withColumnsRenamed(mapping) if mapping else df


def with_core_columns(df: DataFrame) -> DataFrame:
    """Add missing core columns as null strings; ``ord`` as bigint."""
    cols = []
    for c in CORE_COLUMNS:
        if c in df.columns:
            cols.append(F.col(c).cast("bigint" if c == "ord" else "string").alias(c))
        else:
            cols.append(F.lit(None).cast("bigint" if c == "ord" else "string").alias(c))
    extra = [F.col(c) for c in df.columns if c not in CORE_COLUMNS]
    return df.select(*cols, *extra)


def drop_descriptive(dd: DataFrame) -> DataFrame:
    """Remove ``descriptive`` rows; a null field type is kept."""
    return dd.filter(~F.coalesce(F.col("ftype").isin("descriptive"), F.lit(False)))


def fill_section_header(dd: DataFrame) -> DataFrame:
    """Last non-null section header within the form, in dictionary order."""
    return forward_fill(dd, value="hdr", group=["form"], order="ord")


def prepare_dictionary(dd: DataFrame, fill_headers: bool = True) -> DataFrame:
    """T1 minus the read: P1, S19, E1 on a short-named dictionary frame."""
    dd = with_core_columns(rename_headers(dd))
    dd = drop_descriptive(dd)
    dd = dd.withColumn("choices", default_yesno(F.col("ftype"), F.col("choices")))
    if fill_headers:
        dd = fill_section_header(dd)
    return dd


def file_order(rows: DataFrame, out: str = "ord") -> DataFrame:
    """Add the place of each row over all files of ``rows``, a frame just read:
    files in order of their paths, rows as they stand in the file.

    A file must be read by one task (``multiLine``), however tasks pack files:
    its rows then have consecutive ids, so the place is the id less the file's
    first one, plus the rows of the files before it.  Only one row per file is
    summed across files.
    """
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_id"))
    files = placed.groupBy("_file").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("_file", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return (placed.join(offsets, "_file").withColumn(out, F.col("_id") + F.col("_shift"))
            .drop("_file", "_id", "_shift"))


def read_dictionary_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The dictionary CSV as strings with an ``ord`` column, headers renamed.

    ``multiLine`` keeps quoted newlines inside a cell and reads each file
    whole.  Several files follow each other in order of their paths, whatever
    their sizes; compression is told by content.
    """
    raw = (spark.read.option("header", True).option("multiLine", True)
           .option("escape", '"').option("inferSchema", False).csv(readable_paths(spark, path)))
    if not raw.columns:
        raise EmptyInputError(f"dictionary file is empty: {path}")
    return rename_headers(file_order(raw))


def read_dictionary(spark: SparkSession, path: str | list[str], fill_headers: bool = True) -> DataFrame:
    """Read and prepare a dictionary CSV."""
    return prepare_dictionary(read_dictionary_raw(spark, path), fill_headers=fill_headers)
