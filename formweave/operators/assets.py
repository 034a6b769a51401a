"""Asset tables from file globs.

Files are listed by Spark's ``binaryFile`` source without its ``content``
column, so the scan reads no bytes; only ``path`` and ``length``.
Content digests read each file in the task that owns it: files up to a
size bound through Spark's own ``md5(content)``, larger files streamed in
chunks by a small Arrow-batched helper, so no file has to fit in memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formweave.functions.paths import SUBJECT_PARSERS, directory, file_name, path_hash, stem

# Largest file digested inside the JVM (one in-memory value per file).
INLINE_DIGEST_MAX_BYTES = 64 * 1024 * 1024
DIGEST_CHUNK_BYTES = 1024 * 1024


def _listing(spark: SparkSession, glob: str) -> DataFrame | None:
    """The files of one glob; none if it matches nothing.  Any other error is raised."""
    try:
        return spark.read.format("binaryFile").load(glob)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def list_files(spark: SparkSession, globs: str | Iterable[str]) -> DataFrame:
    """``(path, length, modificationTime)`` of the files matching the globs.

    A glob without matches yields no rows.
    """
    globs = [globs] if isinstance(globs, str) else list(globs)
    out = None
    for g in globs:
        df = _listing(spark, g)
        if df is None:
            continue
        df = df.select("path", "length", "modificationTime")
        out = df if out is None else out.unionByName(df)
    if out is None:
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return out


def split_glob(glob: str) -> tuple[str, str]:
    """The fixed folder of a glob and the pattern below it."""
    parts = glob.split("/")
    fixed = next((i for i, part in enumerate(parts) if any(c in part for c in "*?[{")), len(parts) - 1)
    fixed = min(fixed, len(parts) - 1)
    return "/".join(parts[:fixed]) or "/", "/".join(parts[fixed:])


def glob_regex(pattern: str) -> str:
    """A glob below a folder as a regular expression: ``*`` and ``?`` stay inside
    a path segment, ``[a-c]``, ``[^a]`` and ``{x,y}`` as the file systems read them."""
    out, at, braces = [], 0, 0
    while at < len(pattern):
        c = pattern[at]
        close = pattern.find("]", at + 2) if c == "[" else -1
        if c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[" and close > 0:
            inside = pattern[at + 1:close].replace("\\", "\\\\")
            out.append("[" + ("^" + inside[1:] if inside[0] in "!^" else inside) + "]")
            at = close
        elif c == "{":
            out.append("(?:")
            braces += 1
        elif c == "}" and braces:
            out.append(")")
            braces -= 1
        elif c == "," and braces:
            out.append("|")
        elif c == "\\" and at + 1 < len(pattern):
            at += 1
            out.append(re.escape(pattern[at]))
        else:
            out.append(re.escape(c))
        at += 1
    return "^" + "".join(out) + "$"


def topmost(folders: Iterable[str]) -> list[str]:
    """The folders that lie below no other one, by a walk through the tree of
    their segments."""
    tree: dict = {}
    out: list[str] = []
    for folder in sorted(set(folders), key=lambda f: f.count("/") if f != "/" else 0):
        node, covered = tree, False
        for part in folder.rstrip("/").split("/"):
            node = node.setdefault(part, {})
            covered = covered or node.get("/") is True
        if not covered:
            node["/"] = True            # no segment is called "/"
            out.append(folder)
    return out


def _qualified(spark: SparkSession, folder: str) -> tuple[str, bool]:
    """The folder as Spark lists it, and whether it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(where).toString(), fs.exists(where)


def configured_files(spark: SparkSession, entries: Iterable[tuple[str, str, str, str]], repeats: bool = True) -> DataFrame:
    """``(batch_code, file_type, assay_type, path, length)`` of the files that
    match ``(batch_code, file_type, assay_type, glob)`` entries.

    One listing whatever the number of globs: the fixed folders of all globs,
    without those below another one, are listed once, and each file is joined
    to the entries by the folders above it; the rest of the glob is a pattern
    on the rest of the path.  A file that two globs of one batch and type match
    is listed once for each (as the globs stand in the configuration);
    ``repeats=False`` lists it once for the batch and type.  Globs and folders
    without files give no rows.
    """
    found, folders = [], {}
    for batch, ftype, assay, glob in entries:
        folder, pattern = split_glob(glob)
        if folder not in folders:
            folders[folder] = _qualified(spark, folder)
        found.append((batch, ftype, assay, folders[folder][0].rstrip("/"), glob_regex(pattern)))
    roots = topmost(q for q, there in folders.values() if there)
    if not found or not roots:
        return spark.createDataFrame([], "batch_code string, file_type string, assay_type string, path string, length bigint")
    wanted = spark.createDataFrame(found, "batch_code string, file_type string, assay_type string, _folder string, _pattern string")
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots).select("path", "length"))
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    out = (listed.select("path", "length", F.explode(above).alias("_folder")).join(wanted, "_folder")
           .where(F.expr("substring(path, length(_folder) + 2) rlike _pattern"))
           .select("batch_code", "file_type", "assay_type", "path", "length"))
    return out if repeats else out.distinct()


def _asset_columns(batch: Column, ftype: Column, assay: Column, subject: Column) -> list[Column]:
    return [path_hash(F.col("path")).alias("path_hash"),
            file_name(F.col("path")).alias("file_name"),
            directory(F.col("path")).alias("directory"),
            batch.alias("batch_code"), ftype.alias("file_type"), assay.alias("assay_type"),
            F.col("length").cast("bigint").alias("bytes"), subject.alias("subject_id")]


def asset_rows(files: DataFrame, batch_code: str, file_type: str, assay_type: str,
               parser: Callable[[Column], Column] | None = None) -> DataFrame:
    """A1 columns for one (batch, file type) listing; A2/A3 subject id."""
    name = file_name(F.col("path"))
    subject = parser(name) if parser is not None else stem(name)
    return files.select(*_asset_columns(F.lit(batch_code), F.lit(file_type), F.lit(assay_type), subject))


def asset_table(spark: SparkSession, conf: Mapping,
                parsers: Mapping[str, Callable[[Column], Column]] | None = None,
                use_batch_parsers: bool = True, repeats: bool = True) -> DataFrame:
    """One row per file of every batch and file type of ``conf``.

    ``conf`` is ``{"BATCHES": {batch: {"ASSAY_TYPE": .., "FILE_TYPE": {type: [globs]}}}}``
    (the ``BATCHES`` level is optional).  With ``use_batch_parsers`` a batch
    with a registered file-name parser gets its subject id from it (A3),
    otherwise the file stem (A2).  All globs are answered by one listing; see
    :func:`configured_files` for files that several globs match.
    """
    parsers = SUBJECT_PARSERS if parsers is None else parsers
    batches = conf.get("BATCHES", conf)
    entries = [(batch, ftype, bconf["ASSAY_TYPE"], glob) for batch, bconf in batches.items()
               for ftype, globs in bconf["FILE_TYPE"].items() for glob in ([globs] if isinstance(globs, str) else globs)]
    name = file_name(F.col("path"))
    subject = stem(name)
    for batch in batches:
        if use_batch_parsers and batch in parsers:
            subject = F.when(F.col("batch_code") == batch, parsers[batch](name)).otherwise(subject)
    files = configured_files(spark, entries, repeats)
    return files.select(*_asset_columns(F.col("batch_code"), F.col("file_type"), F.col("assay_type"), subject))


def _stream_md5():
    """The streaming digest as a nested function, which is sent to workers by value."""
    chunk_bytes = DIGEST_CHUNK_BYTES

    def run(batches):
        import hashlib

        import pandas as pd
        import pyarrow.fs as pafs

        def opened(path: str):
            """Paths come as Spark lists them, not as escaped URIs: only scheme
            and authority are parsed, the rest is taken literally."""
            scheme, _, rest = path.partition(":")
            if scheme == "file":
                return pafs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/"))
            authority, slash, inner = rest.lstrip("/").partition("/")
            arrow = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
            fs, base = pafs.FileSystem.from_uri(f"{arrow}://{authority}/")
            return fs.open_input_stream(f"{base.rstrip('/')}{slash}{inner}")

        for pdf in batches:
            digests = []
            for path in pdf["path"]:
                h = hashlib.md5()
                with opened(path) as f:
                    while chunk := f.read(chunk_bytes):
                        h.update(chunk)
                digests.append(h.hexdigest())
            yield pd.DataFrame({"path": pdf["path"], "bytes": pdf["bytes"], "md5": digests})

    return run


def content_md5(spark: SparkSession, globs: str | Iterable[str],
                inline_max_bytes: int = INLINE_DIGEST_MAX_BYTES) -> DataFrame:
    """T5: ``(path, bytes, md5)`` of every matching file.

    Files up to ``inline_max_bytes`` are digested by ``md5(content)`` (the
    length filter is applied before any content is read).  Only if the
    listing has larger ones, these are streamed in 1 MiB chunks, one file
    per row, spread over tasks; the digests are the same.
    """
    globs = [globs] if isinstance(globs, str) else list(globs)
    out = None
    for g in globs:
        files = _listing(spark, g)
        if files is None:
            continue
        part = (files.filter(F.col("length") <= inline_max_bytes)
                .select("path", F.col("length").alias("bytes"), F.md5("content").alias("md5")))
        large = (files.filter(F.col("length") > inline_max_bytes)
                 .select("path", F.col("length").cast("bigint").alias("bytes")))
        if large.take(1):
            part = part.unionByName(large.repartition(F.col("path")).mapInPandas(
                _stream_md5(), "path string, bytes bigint, md5 string"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "path string, bytes bigint, md5 string")
    return out
