"""Vectorised text helpers shared by the operators.

Texts arrive as Arrow string columns.  Their UTF-8 buffers are read as
numpy arrays, so splitting into words and hashing never touches single
Python strings.  Word separators are the ASCII white space characters
``\\x20 \\x09-\\x0D``, which never occur inside a multi-byte character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

SLICE_BYTES = 4 << 20
MULT = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def with_id(rows: DataFrame, *columns, name: str = "doc_id") -> DataFrame:
    """The id as bigint (whatever integer type the table has) and ``columns``."""
    return rows.select(rows[name].cast("bigint").alias(name), *columns)


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The column as strings, null as the empty text."""
    col = batch.column(batch.schema.names.index(name))
    return pc.fill_null(col.cast(pa.string()), "")


def slices(batches: Iterator[pa.RecordBatch], name: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into row slices of about ``max_bytes`` of text (a longer
    single text gets a slice of its own) and yield
    ``(rows, bytes, offsets)`` for each slice with at least one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = text_column(batch, name)
        offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        data = col.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(col):
            end = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
            end = min(max(end, at + 1), len(col))
            lo, hi = offsets[at], offsets[end]
            yield batch.slice(at, end - at), data[lo:hi], offsets[at:end + 1] - lo
            at = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and the first word index of each
    text (with the total as last entry).  Words never span two texts."""
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = True
    before[1:] = ~solid[:-1]
    starts = np.flatnonzero(solid & (before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = True
    after[:-1] = ~solid[1:]
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = 0x100000001B3) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    length = ends - starts
    inside = np.repeat(starts - np.concatenate(([0], np.cumsum(length)[:-1])), length) + np.arange(int(length.sum()))
    place = inside - np.repeat(starts, length)
    terms = (data[inside].astype(np.uint64) + np.uint64(1)) * powers(int(length.max()) + 1)[place]
    return mix(np.add.reduceat(terms, np.concatenate(([0], np.cumsum(length)[:-1]))) ^ length.astype(np.uint64) * MULT)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct sorted hashes of the ``k``-word shingles of one text given by
    its word hashes; with fewer words, the whole sequence as one shingle;
    without words, none."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64)
    width = min(k, n)
    out = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        out = mix(out * MULT + hashes[j:n - width + 1 + j])
    return np.unique(out)


def shingle_sets(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingles`` of several texts, one set behind the other, and the
    offsets of the sets (text i has the words from ``first[i]`` on)."""
    n = np.diff(first)
    m = max(len(hashes) - k + 1, 0)
    out = np.full(m, k, np.uint64)
    for j in range(k):
        out = mix(out * MULT + hashes[j:m + j])
    inside = np.arange(m) + k <= np.repeat(first[1:], n)[:m]
    size = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    offsets = np.concatenate(([0], np.cumsum(size)))
    short = np.flatnonzero((n > 0) & (n < k))
    items = np.empty(offsets[-1], np.uint64)
    whole = np.ones(len(items), bool)
    whole[offsets[short]] = False
    items[whole] = out[inside]
    for i in short:
        items[offsets[i]] = shingles(hashes[first[i]:first[i + 1]], k)[0]
    for i in np.flatnonzero(size > 1):
        items[offsets[i]:offsets[i + 1]].sort()
    new = np.ones(len(items), bool)
    new[1:] = items[1:] != items[:-1]
    new[offsets[:-1][size > 0]] = True
    return items[new], np.concatenate(([0], np.cumsum(new)))[offsets]


def jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Size of the intersection and of the union of two sorted distinct arrays."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both, len(a) + len(b) - both
