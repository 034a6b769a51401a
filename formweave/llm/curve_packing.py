"""Packing documents into token sequences along a space-filling curve.

Each text becomes token ids and a hashed vector of them; a fixed random
projection takes the vector to a few dimensions, and the Hilbert curve takes
these to one key.  Spark range-sorts the documents by that key, so documents
with similar words are neighbours.  Token positions are prefix sums over that
order, and a sequence is a stretch of ``length`` positions: documents that
follow each other on the curve share sequences, long ones are cut.  What is
left at the very end is cut into powers of two, which need no padding.

Token ids are written once; only places and lengths are sorted, and the
positions come back to the ids by one join.  A row holds at most ``SEGMENT``
ids, so a very long document is many rows.  Nothing but one row per range is
summed across ranges.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from formweave.llm.arrays import mix, text_column, with_id
from formweave.session import work_dir

LENGTH = 2048
END_ID = 1
DIMENSIONS = 4
BITS = 15
BUCKETS = 256
SEGMENT = 1 << 16
PART_TOKENS = 64_000_000
BLOCK_CHARS = 1 << 18

# A text may be cut before a space or line break that follows a character
# which is no white space of any kind: no token spans that place, and the
# tokens of both sides are those of the whole.
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85])[ \n]")


def byte_of_character() -> dict[str, int]:
    """Byte-level files write a byte as the character of its number if that is
    printable, else as the next character from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary of a plain byte-level file, in which a token's id is the
    rank of its merge; None for any other file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    if (model["type"] != "BPE" or spec.get("normalizer") or model.get("ignore_merges") or model.get("dropout")
            or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex")):
        return None
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if any(model["vocab"].get(m) != 256 + i for i, m in enumerate(merged)):
        return None
    byte_of = byte_of_character()
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if i < 256 + len(merged)}
    return ranks if len(ranks) == 256 + len(merged) else None


class Encoder:
    """Token ids of texts, as ``tokenizers`` gives them for the file at
    ``path``; strings of special tokens are ordinary text.

    A plain byte-level file is run by its own merge ranks in ``tiktoken``, for
    a third of the time; ``tokenizers`` runs every other file, and
    :meth:`check` compares the two."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        ranks = merge_ranks(path)
        self.ranked = None
        if ranks:
            import tiktoken
            self.ranked = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _block(self, text: str) -> np.ndarray:
        if self.ranked:
            return np.array(self.ranked.encode_ordinary(text), self.dtype)
        return np.array(self.model.encode(text, add_special_tokens=False).ids, self.dtype)

    def blocks(self, text: str) -> Iterator[str]:
        at = 0
        while at < len(text):
            cut = _CUT.search(text, at + BLOCK_CHARS)
            end = cut.start() if cut else len(text)
            yield text[at:end]
            at = end

    def __call__(self, text: str) -> np.ndarray:
        """The ids of one text, taken in blocks so that memory beyond the ids
        themselves does not grow with it."""
        return np.concatenate([np.zeros(0, self.dtype), *map(self._block, self.blocks(text))])

    def check(self, text: str) -> None:
        """Raise if the first block's ids are not those of ``tokenizers``."""
        for block in itertools.islice(self.blocks(text), 1):
            if self._block(block).tolist() != self.model.encode(block, add_special_tokens=False).ids:
                raise ValueError("the ranks of the vocabulary file give other ids than tokenizers")


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder a worker process for all its tasks."""
    return Encoder(path)


class Projection:
    """Hashed token vectors, projected to ``DIMENSIONS`` coordinates."""

    def __init__(self, vocabulary: int, seed: int = 13):
        hashed = mix(np.arange(vocabulary, dtype=np.uint64) + np.uint64(seed))
        self.bucket = (hashed % np.uint64(BUCKETS)).astype(np.int64)
        # ids of a byte-pair vocabulary ascend with rarity: rare ones weigh more
        rarity = np.log1p(np.arange(vocabulary)) / np.log1p(vocabulary)
        self.weight = np.where(hashed >> np.uint64(63), 1.0, -1.0) * rarity ** 2
        self.axes = np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS))

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        """The coordinates of one document as integers of ``BITS`` bits."""
        distinct, n = np.unique(ids, return_counts=True)
        vector = np.bincount(self.bucket[distinct], self.weight[distinct] * np.log1p(n), BUCKETS)
        size = np.sqrt(vector @ vector)
        spread = 1.0 / (1.0 + np.exp(-1.702 * ((vector / size if size else vector) @ self.axes)))
        return np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place on the Hilbert curve of each row of integer coordinates.

    From the highest bit down, the part of the cube a point lies in decides a
    reflection or exchange of the lower bits; the Gray code of all bits is
    then undone, and the bits of all axes are interleaved."""
    x = points.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(axes):
            inside = (x[axis] >> level & 1).astype(bool)
            swap = np.where(inside, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(inside, low, swap)
            x[axis] ^= swap
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(axes):
            key = key << 1 | x[axis] >> level & 1
    return key


_TOKEN_FIELDS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                           ("doc_tokens", pa.int64()), ("ids", pa.binary()), ("place", pa.int64())])


def _tokenise(path: str, end_id: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        project = Projection(max(encode.model.get_vocab_size(), end_id + 1))
        end = np.array([end_id], encode.dtype)
        out, points, held = [], [], 0

        def flushed():
            columns = [*zip(*out), hilbert_key(np.array(points))]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TOKEN_FIELDS)],
                                              schema=_TOKEN_FIELDS)
        for batch in batches:
            texts = text_column(batch)
            if batch.num_rows:
                encode.check(texts[0].as_py())
            for doc, text in zip(batch.column(0).to_pylist(), texts):
                ids = encode(text.as_py())
                point = project(ids)
                ids = np.concatenate((ids, end))
                for at in range(0, len(ids), SEGMENT):
                    piece = ids[at:at + SEGMENT].tobytes()
                    out.append((doc, at, len(piece) // ids.itemsize, len(ids), piece))
                    points.append(point)
                    held += len(piece)
                    if held > 4 << 20 or len(out) >= 4096:
                        yield flushed()
                        out, points, held = [], [], 0
        if out:
            yield flushed()
    return rows


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``before``: the tokens of the same range before each row."""
    total = 0
    for batch in batches:
        length = batch.column(batch.schema.names.index("length")).to_numpy()
        ends = np.cumsum(length) + total
        yield batch.append_column("before", pa.array(ends - length, pa.int64()))
        total = int(ends[-1]) if len(ends) else total


def write_tokens(documents: DataFrame, folder: str, path: str, end_id: int = END_ID) -> DataFrame:
    """The documents' token ids, written to ``folder``: ``row, doc_id, start,
    length, doc_tokens, ids, place``, a row for each segment of at most
    ``SEGMENT`` ids, ``start`` ids into its document; ``place`` is the
    document's place on the curve."""
    (with_id(documents, "text").mapInArrow(
        _tokenise(path, end_id), "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, place bigint")
     .withColumn("row", F.monotonically_increasing_id()).write.parquet(folder))
    return documents.sparkSession.read.parquet(folder)


def curve_order(tokens: DataFrame, folder: str, part_tokens: int = PART_TOKENS) -> DataFrame:
    """``row, doc_id, length, part, before`` in the order of the curve, written
    to ``folder``: ``part`` numbers the ranges of the order, ``before`` counts
    the tokens ahead in the same range."""
    total = tokens.agg(F.sum("length")).first()[0] or 0
    order = ["place", "doc_id", "row"]
    placed = (tokens.select(*order, "length").repartitionByRange(1 + total // part_tokens, *order).sortWithinPartitions(*order)
              .select("row", "doc_id", "length", F.spark_partition_id().alias("part")))
    placed.mapInArrow(_running, "row bigint, doc_id bigint, length bigint, part int, before bigint").write.parquet(folder)
    return tokens.sparkSession.read.parquet(folder)


def sequence_ends(total: int, length: int) -> list[int]:
    """Where the sequences after the last full one end: the remainder of
    ``total`` as powers of two, largest first."""
    at, ends = total - total % length, []
    for bit in range((total % length).bit_length() - 1, -1, -1):
        if total % length >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def _cut(total: int, length: int):
    full = total // length
    tail = np.array([full * length, *sequence_ends(total, length)], np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            col = dict(zip(batch.schema.names, batch.columns))
            at, n, start = (col[c].to_numpy() for c in ("at", "length", "start"))
            out = []
            for i, ids in enumerate(col["ids"]):
                ids = np.frombuffer(ids.as_buffer(), np.uint8)
                ids = ids.view("<u2" if len(ids) == 2 * n[i] else "<u4").astype("<u4")
                cuts = np.arange((at[i] // length + 1) * length, min(at[i] + n[i], full * length) + 1, length)
                cuts = np.concatenate((cuts, tail[tail > at[i]])) if at[i] + n[i] > full * length else cuts
                cuts = np.unique(np.concatenate(([at[i]], cuts[cuts < at[i] + n[i]], [at[i] + n[i]])))
                for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    after = int(np.searchsorted(tail, lo, side="right")) - 1
                    sequence = lo // length if lo < full * length else full + after
                    offset = lo % length if lo < full * length else lo - int(tail[after])
                    out.append((i, int(start[i]) + lo - int(at[i]), hi - lo,
                                zlib.crc32(ids[lo - at[i]:hi - at[i]].tobytes()), sequence, offset))
            of, begin, size, crc, sequence, offset = zip(*out)
            of = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [col["doc_id"].take(of), pa.array(begin, pa.int64()), pa.array(size, pa.int64()),
                 pa.array(crc, pa.int64()), col["doc_tokens"].take(of), pa.array(sequence, pa.int64()),
                 pa.array(offset, pa.int64())],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return rows


def pack_documents(documents: DataFrame, length: int = LENGTH, path: str | None = None, end_id: int = END_ID,
                   part_tokens: int = PART_TOKENS) -> DataFrame:
    """One row per piece of a document in a sequence: ``doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset``.

    A document (``doc_id``, ``text``) is its token ids by the ``tokenizers``
    file at ``path`` (byte_bpe_50k.json unless given), without special tokens,
    and ``end_id``.  Every id lies in exactly one piece; all sequences hold
    ``length`` ids but the last ones, whose sizes are falling powers of two.

    Null and empty texts are the end id alone; null ids are kept; equal rows
    are packed once each.  Copies of one text are neighbours, by doc_id.  Other
    columns are ignored; an empty table gives no rows."""
    spark = documents.sparkSession
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    folder = work_dir(spark, "packing")
    tokens = write_tokens(documents, f"{folder}/tokens", path, end_id)
    ordered = curve_order(tokens, f"{folder}/order", part_tokens)
    parts = ordered.groupBy("part").agg(F.sum("length").alias("n"))
    total = parts.agg(F.sum("n")).first()[0] or 0
    across = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("ahead"))
    # one row per range of part_tokens tokens
    places = ordered.join(F.broadcast(parts), "part").select("row", (F.col("ahead") + F.col("before")).alias("at"))
    return tokens.join(places, "row").select("doc_id", "start", "length", "doc_tokens", "ids", "at").mapInArrow(
        _cut(total, length), "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                             "sequence_id bigint, offset bigint")
