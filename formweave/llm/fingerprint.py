"""Document fingerprints by MinHash.

A fingerprint is the text's minwise signature: 64 universal hash
permutations over its five-word shingles, 16 bits of each minimum, in hex.
Equal texts have equal fingerprints, and the share of equal positions
estimates the Jaccard similarity of the shingle sets.  Signatures are cut
into bands that Spark joins; what shares a band is verified on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formweave.llm.arrays import LOWER, shingles, slices, text_column, word_hashes, words, with_id
from formweave.llm.components import connected_components
from formweave.llm.minwise import permutations, signature
from formweave.llm.set_join import links_in_clusters

HASHES = 64
SHINGLE = 5
FINGERPRINT_SEED = 8


def signatures(texts: pa.Array) -> np.ndarray:
    """Signature of each text, one row of ``HASHES`` 16-bit values."""
    a, b = permutations(HASHES, FINGERPRINT_SEED)
    out = [np.zeros((0, HASHES), np.uint16)]
    for rows, data, offsets in slices([pa.RecordBatch.from_arrays([texts], ["text"])]):
        data = LOWER[data]
        starts, ends, first = words(data, offsets)
        hashes = word_hashes(data, starts, ends)
        out.append(np.stack([signature(shingles(hashes[first[i]:first[i + 1]], SHINGLE), a, b)
                             for i in range(rows.num_rows)]).astype(np.uint16))
    return np.concatenate(out)


def fingerprint_text(signature_row: np.ndarray) -> str:
    return signature_row.astype(">u2").tobytes().hex()


def likeness(left: str, right: str) -> float:
    """Estimated Jaccard similarity of two fingerprints."""
    a, b = (np.frombuffer(bytes.fromhex(x), ">u2") for x in (left, right))
    return float((a == b).mean())


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, _, _ in slices(batches):
        marks = signatures(text_column(rows))
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array([fingerprint_text(m) for m in marks], pa.string())],
            ["doc_id", "fingerprint"])


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` for every row of ``documents`` (``doc_id``,
    ``text``).  Null texts count as empty; all texts without words share one
    fingerprint.  Other columns are ignored."""
    return with_id(documents, "text").mapInArrow(_fingerprints, "doc_id bigint, fingerprint string")


def similar_documents(documents: DataFrame, bands: int = 16, percent: int = 80) -> DataFrame:
    """``doc_id, component`` of the documents that have a near copy: linked
    when ``100 * intersection >= percent * union`` of their shingle sets,
    directly or through others (the smallest doc_id is the component).

    Bands of equal signature values put documents into one cluster by an
    aggregate per band value (no pairs are formed); the clusters' links are
    then verified on full sets.  A pair at 0.8 shares one of 16 bands of 4
    values with probability 0.9998.  Null doc_ids, null and blank texts are
    left out; rows sharing a doc_id are one document."""
    width = HASHES // bands * 4
    prints = fingerprints(documents.where("doc_id is not null and text rlike '[^\\\\x20\\\\x09-\\\\x0D]'"))
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)),
                                 lambda i: F.concat_ws(":", i, F.substring("fingerprint", i * width + 1, F.lit(width)))))
    rows = prints.select("doc_id", band.alias("band")).checkpoint()
    least = rows.groupBy("band").agg(F.min("doc_id").alias("b"))
    clusters = connected_components(rows.join(least, "band").select(F.col("doc_id").alias("a"), "b")).checkpoint()
    placed = clusters.select(F.col("id").alias("doc_id"), F.col("component").alias("cluster"),
                             F.lit(0).cast("bigint").alias("block"))
    found = connected_components(links_in_clusters(documents, placed, SHINGLE, percent))
    return found.select(F.col("id").alias("doc_id"), "component")


def with_next(documents: DataFrame, rows_per_part: int = 4000) -> DataFrame:
    """Rows ``part, tail, doc_id, text`` in sorted partitions, such that the
    row after each row with ``tail = 0`` is its next document by ascending
    doc_id (then text; null ids first), and the first document after the last.

    The table is cut into ranges of doc_id at approximate quantiles; each
    range also gets a copy of the first row of the next range as its tail.
    Only as many ids as there are ranges reach the driver, and texts are
    shuffled once."""
    ids = documents.select("doc_id")
    parts = min(20_000, max(1, ids.count() // rows_per_part))
    cuts = sorted(set(ids.stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    cuts = F.array(*[F.lit(int(c)) for c in cuts]).cast("array<bigint>")
    rows = documents.select(F.size(F.filter(cuts, lambda c: c <= F.col("doc_id"))).alias("part"), "doc_id",
                            F.coalesce("text", F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    firsts = rows.groupBy("part").agg(F.min(key).alias("low"))
    heads = (rows.withColumn("low", key).join(F.broadcast(firsts), ["part", "low"])
             .groupBy("part", "low").agg(F.min("text").alias("text"), F.first("doc_id").alias("doc_id")))
    order = Window.orderBy("part")
    before = firsts.select(F.col("part").alias("next"),
                           F.coalesce(F.lag("part").over(order), F.last("part").over(order.rowsBetween(
                               Window.unboundedPreceding, Window.unboundedFollowing))).alias("part"))
    tails = heads.withColumnRenamed("part", "next").join(F.broadcast(before), "next")
    return (rows.select("part", F.lit(0).alias("tail"), "doc_id", "text")
            .union(tails.select("part", F.lit(1).alias("tail"), "doc_id", "text"))
            .repartition(parts, "part").sortWithinPartitions("part", "tail", "doc_id", "text"))


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row next to its follower: fingerprints of the text, of the text
    with its last quarter replaced by the follower's start, and likenesses."""
    last = None              # the row whose follower is still to come
    for rows, _, _ in slices(batches):
        texts = text_column(rows).to_pylist()
        marks = signatures(pa.array(texts, pa.string()))
        part, tail, ids = (rows.column(n).to_pylist() for n in ("part", "tail", "doc_id"))
        out, edited = [], []
        for i, text in enumerate(texts):
            if last is not None and last[0] == part[i]:
                quarter = len(last[2]) // 4
                edited.append(last[2][:len(last[2]) - quarter] + text[:quarter])
                out.append((last[1], len(last[2]), last[3], marks[i]))
            last = None if tail[i] else (part[i], ids[i], text, marks[i])
        changed = signatures(pa.array(edited, pa.string()))
        yield pa.RecordBatch.from_arrays([
            pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
            pa.array([fingerprint_text(o[2]) for o in out], pa.string()),
            pa.array([fingerprint_text(c) for c in changed], pa.string()),
            pa.array([float((o[2] == c).mean()) for o, c in zip(out, changed)], pa.float64()),
            pa.array([float((o[2] == o[3]).mean()) for o in out], pa.float64())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def edited_fingerprints(documents: DataFrame, rows_per_part: int = 4000) -> DataFrame:
    """Fingerprints of every text and of its edited text, one row per row of
    ``documents``: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text replaces the last quarter (rounded down) of the code
    points by as many first ones, or all, of the next document.  Null texts
    count as empty; rows that share a doc_id follow each other by text; rows
    without doc_id come first.  A single row is its own next document; an
    empty table gives no rows.  Other columns are ignored."""
    return with_next(with_id(documents, "text"), rows_per_part).mapInArrow(
        _edit, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
               "edited_fingerprint string, near_edited double, near_next double")
