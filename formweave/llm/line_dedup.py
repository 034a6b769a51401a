"""Line dedup with a log-template tree.

Every line goes down a tree of fixed depth: by its number of tokens, then
by its leading tokens, where tokens with digits are already variable (unless
most tokens of the line have them: a row of numbers is its numbers).  In
a leaf, lines that agree in most positions have one template, named by the
most frequent of them; the positions that differ are its variable fields.
Templates that recur across unrelated documents are dropped from all
documents but the first.

Copies of a document also repeat its lines, but together.  So what counts
is the number of different documents: near copies, as near dedup finds them
on whole texts, are one.

Scale.  Lines travel as hashes and one byte per token.  Leaves seen in one
document or with one line only are left out before any comparison.  No leaf
is gathered: lines meet by keys of what must be equal (see
``line_templates``), and per key only the most frequent line is taken, by
an aggregate.  The rule is the same whatever the number of lines.  Texts are shuffled to meet the numbers of their lines to drop, and
those in candidate clusters to be compared for near copies (``set_join.py``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.arrays import LOWER, MULT, mix, slices, word_hashes, words, with_id
from formweave.llm.components import cut
from formweave.llm.set_join import near_duplicates
from formweave.session import remove_folder

LEADING = 2               # leading tokens on the way to a leaf
SHORT = 10                # shorter lines have one variable field at most, of one token
RUNS = 8                  # most runs into which a longer line is cut
AGREE = 80                # percent of positions in which a line agrees with its template
VARIABLE = np.uint64(0xD1B54A32D192ED03)
LINE = "doc_id bigint, mark bigint, line int, leaf bigint, exact bigint, tokens binary"


def _lines(min_tokens: int, min_chars: int):
    """Arrow mapper: one row per line that may be boilerplate."""
    digit = np.zeros(256, bool)
    digit[ord("0"):ord("9") + 1] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, max_bytes=2 << 20):
            low = LOWER[data]
            ends_at = np.flatnonzero(data == 0x0A)
            cuts = np.unique(np.concatenate((offsets, ends_at + 1)))       # each line's first byte, and the end
            starts, ends, first = words(low, cuts)
            hashes = word_hashes(low, starts, ends)
            digits = np.concatenate(([0], np.cumsum(digit[low])))
            n = np.diff(first)
            masked = digits[ends] > digits[starts]
            # a line mostly of numbers says nothing but them: it is compared by its own tokens
            share = np.concatenate(([0], np.cumsum(masked)))
            wordy = 2 * (share[first[1:]] - share[first[:-1]]) <= n
            hashes[masked & np.repeat(wordy, n)] = VARIABLE
            doc = np.searchsorted(offsets, cuts[:-1], side="right") - 1     # the last of texts that start there
            number = np.arange(len(n)) - np.searchsorted(cuts[:-1], offsets[:-1])[doc]
            full = np.flatnonzero(n)
            exact, leaf = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            if len(full):
                place = np.arange(len(hashes)) - np.repeat(first[:-1], n)
                terms = mix(hashes + place.astype(np.uint64) * MULT)
                exact[full] = mix(np.add.reduceat(terms, first[full]) + n[full].astype(np.uint64))
                lead = np.where(place < LEADING, terms, np.uint64(0))
                leaf[full] = mix(np.add.reduceat(lead, first[full]) ^ (n[full].astype(np.uint64) * MULT))
            size = np.zeros(len(n), np.int64)
            size[full] = ends[first[full + 1] - 1] - starts[first[full]]
            some = np.flatnonzero((n >= min_tokens) & (size >= min_chars))
            small = (hashes >> np.uint64(56)).astype(np.uint8)
            kept = np.repeat(np.isin(np.arange(len(n)), some), n)
            lists = pa.Array.from_buffers(pa.binary(), len(some), [
                None, pa.py_buffer(np.concatenate(([0], np.cumsum(n[some]))).astype(np.int32)), pa.py_buffer(small[kept])])
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(pa.array(doc[some])), rows.column("mark").take(pa.array(doc[some])),
                 pa.array(number[some].astype(np.int32)), pa.array(leaf[some].view(np.int64)), pa.array(exact[some].view(np.int64)),
                 lists],
                ["doc_id", "mark", "line", "leaf", "exact", "tokens"])

    return run


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of lines with equally many tokens: those that agree in ``AGREE``
    percent of the positions."""
    names = ["leaf", "rank", "exact", "top", "template"]
    for rows in batches:
        if not rows.num_rows:
            continue
        mine, other = ((c, np.frombuffer(c.buffers()[1], np.int32)[c.offset:c.offset + len(c) + 1])
                       for c in (rows.column("tokens"), rows.column("others")))
        values = [np.frombuffer(c.buffers()[2], np.uint8)[at[0]:at[-1]] for c, at in (mine, other)]
        offsets = mine[1] - mine[1][0]
        same = np.add.reduceat((values[0] == values[1]).astype(np.int64), offsets[:-1])
        yield rows.select(names).filter(pa.array(100 * same >= AGREE * np.diff(offsets)))


def line_templates(distinct: DataFrame) -> DataFrame:
    """``exact, template`` of the lines that belong to the template of another
    line of their leaf (``distinct``: leaf, exact, n, tokens; one row a line;
    n counts it).

    Lines of ``SHORT`` tokens and more are cut into runs behind the leading
    tokens, one more than there may be different tokens (``RUNS`` at most), so
    alike lines with fields in fewer runs have a run in common.  Shorter lines
    are taken once without each of these tokens.  Of the lines that share
    such a key, the most frequent one (ties: by hash) is the one to agree
    with; of all it agrees with, a line takes the most frequent.  A line
    that others have taken is its own template."""
    n = F.length("tokens")
    parts = F.when(n < SHORT, n - LEADING).otherwise(F.least(F.floor(n * (100 - AGREE) / 100) + 1, F.lit(RUNS))).cast("int")
    ranked = distinct.select("leaf", "exact", "tokens", F.expr(
        "shiftleft(least(n, 32767L), 48) | (exact & 281474976710655L)").alias("rank"))
    keys = (ranked.where(n * (100 - AGREE) >= 100)             # else no token may differ
            .select("leaf", "rank", "tokens", n.alias("length"), parts.alias("parts"),
                    F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
            .withColumn("begin", F.expr(f"cast({LEADING} + part * (length - {LEADING}) div parts as int)"))
            .withColumn("end", F.expr(f"cast({LEADING} + (part + 1) * (length - {LEADING}) div parts as int)"))
            .select("leaf", "rank", F.expr(f"""xxhash64(leaf, part, if(length < {SHORT},
                concat(substring(tokens, 1, begin), substring(tokens, end + 1, length)),
                substring(tokens, begin + 1, end - begin)))""").alias("key")))
    tops = keys.groupBy("key").agg(F.max("rank").alias("top"), F.min("rank").alias("least")).where("least < top").drop("least")
    pairs = keys.join(tops, "key").where("rank < top").select("leaf", "rank", "top").distinct()
    other = ranked.select("leaf", F.col("rank").alias("top"), F.col("exact").alias("template"), F.col("tokens").alias("others"))
    taken, _ = cut(pairs.join(ranked, ["leaf", "rank"]).join(other, ["leaf", "top"])
                   .where(n == F.length("others"))
                   .select("leaf", "rank", "exact", "top", "template", "tokens", "others")
                   .mapInArrow(_agreeing, "leaf bigint, rank bigint, exact bigint, top bigint, template bigint")
                   .groupBy("leaf", "rank").agg(F.max("top").alias("top"), F.max_by("template", "top").alias("template"),
                                                F.first("exact").alias("exact")), "taken")
    own = taken.select("leaf", F.col("top").alias("rank")).distinct()
    return taken.join(own, ["leaf", "rank"], "left_anti").select("exact", "template")


def recurring_lines(documents: DataFrame, min_tokens: int = 4, min_chars: int = 24, min_documents: int = 3) -> DataFrame:
    """``doc_id, mark, drop`` (line numbers from 0, an array) of the documents
    that have lines to drop; ``mark`` is ``xxhash64(text)``.  See
    ``drop_recurring_lines``."""
    spark = documents.sparkSession
    lines, lines_folder = cut(with_id(documents, "text", F.xxhash64("text").alias("mark"))
                              .where("doc_id is not null and text is not null")
                              .mapInArrow(_lines(min_tokens, min_chars), LINE), "lines")
    shared = (lines.groupBy("leaf").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"),
                                        F.min("exact").alias("c"), F.max("exact").alias("d"))
              .where("a < b and c < d").select("leaf"))
    distinct, _ = cut(lines.join(shared, "leaf").groupBy("leaf", "exact")
                      .agg(F.count("*").alias("n"), F.first("tokens").alias("tokens")), "leaves")
    named = line_templates(distinct)
    lines = lines.drop("tokens", "leaf").join(named, "exact", "left").select(
        "doc_id", "mark", "line", F.coalesce("template", "exact").alias("template"))
    often = (lines.groupBy("template").agg(F.count("*").alias("rows"), F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
             .where((F.col("rows") >= min_documents) & (F.col("a") < F.col("b"))).select("template"))
    lines, _ = cut(lines.join(often, "template"), "often")
    remove_folder(spark, lines_folder)
    classes = near_duplicates(documents).select("doc_id", F.col("component_id").alias("class")).distinct()
    recurring = (lines.join(classes, "doc_id").groupBy("template")
                 .agg(F.count_distinct("class").alias("classes"), F.min(F.struct("doc_id", "line", "mark")).alias("first"))
                 .where(F.col("classes") >= min_documents))
    return (lines.join(recurring.select("template", "first"), "template")
            .where(F.struct("doc_id", "line", "mark") != F.col("first"))
            .groupBy("doc_id", "mark").agg(F.collect_set("line").alias("drop")))


def drop_recurring_lines(documents: DataFrame, **options) -> DataFrame:
    """``documents`` with recurring lines taken out of ``text``, plus
    ``dropped_lines`` (how many); all rows and columns are kept.

    A line recurs if its template is found in at least ``min_documents``
    documents that are no near copies of each other (classes of
    ``near_duplicates``, however many copies each has); it stays in the first
    document by doc_id.  Lines of under ``min_tokens`` tokens or ``min_chars`` bytes
    are never dropped.  Options are those of ``recurring_lines``.

    Rows without doc_id and null texts stay as they are; rows that share
    doc_id and text are treated alike.  Columns with clashing names are
    overwritten only for ``dropped_lines``.  Equal lines twice in a document
    count once towards documents.  An empty table gives no rows."""
    drops = recurring_lines(documents, **options).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.col("drop").alias("_drop"))
    joined = documents.join(drops, (documents["doc_id"] == F.col("_id")) & (F.xxhash64(documents["text"]) == F.col("_mark")), "left")
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains("_drop", i)), "\n")
    return (joined.withColumn("text", F.when(F.col("_drop").isNull(), F.col("text")).otherwise(kept))
            .withColumn("dropped_lines", F.coalesce(F.size(F.col("_drop")), F.lit(0)))
            .withColumn("dropped_lines", F.greatest("dropped_lines", F.lit(0))).drop("_id", "_mark", "_drop"))
