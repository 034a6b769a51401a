"""Benchmark decontamination by q-gram lemma filtering.

If a passage of n characters occurs in a document with at most k edits,
the two share at least ``n - q + 1 - q * k`` of the passage's q-grams, and
all of these lie on diagonals (place in the document less place in the
passage) at most k apart.  So shared q-grams are counted in overlapping
bands of diagonals, and only regions that reach the bound are verified,
by alignment within the band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.arrays import LOWER, MULT, slices, with_id

Q = 7
EDITS = 0.1              # edit budget, as a share of the passage's length
FILTER_BITS = 22
SEGMENT = 1 << 19        # document places whose q-grams are looked up at once
MOST_PAIRS = 1 << 22     # shared q-grams counted at once
COUNT_BITS = 20


def normal_form(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts, A-Z lowered and runs of white space as one
    space; the offsets of the texts among them; and the code point of its
    text that each one stands for."""
    head = (data & 0xC0) != 0x80
    points = np.concatenate(([0], np.cumsum(head)))[offsets]
    code = np.frombuffer(LOWER[data].tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    blank = (code == 32) | ((code >= 9) & (code <= 13))
    first = np.zeros(len(code) + 1, bool)
    first[points] = True
    keep = np.ones(len(code), bool)
    keep[1:] = ~(blank[1:] & blank[:-1]) | first[1:-1]
    kept = np.flatnonzero(keep)
    bounds = np.searchsorted(kept, points)
    return np.where(blank, np.uint32(32), code)[kept], bounds, kept - np.repeat(points[:-1], np.diff(bounds))


def gram_hashes(code: np.ndarray) -> np.ndarray:
    """Hash of the q-gram (``Q`` = 7) at each place where one begins."""
    base = 0x100000001B3
    one, two, three = (np.uint64(base ** k & 0xFFFFFFFFFFFFFFFF) for k in (1, 2, 3))
    n = max(len(code) - Q + 1, 0)
    c = code.astype(np.uint64)
    pair = c[:-1] * one + c[1:]
    four = pair[:-2] * two + pair[2:]
    return (four[:n] * three + (pair[4:4 + n] * one + c[6:6 + n])) * MULT


class Passages:
    """An index of passages: postings of every q-gram, and a bit filter."""

    def __init__(self, ids: list, texts: list[str]):
        _, data, offsets = next(slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])], max_bytes=1 << 40))
        code, bounds, _ = normal_form(data, offsets)
        self.ids, self.codes = [], []
        for i, lo, hi in zip(ids, bounds, bounds[1:]):
            trimmed = code[lo:hi]
            trimmed = trimmed[len(trimmed) > 0 and int(trimmed[0] == 32):]
            trimmed = trimmed[:len(trimmed) - (len(trimmed) > 0 and int(trimmed[-1] == 32))]
            if len(trimmed) >= Q:
                self.ids.append(i)
                self.codes.append(trimmed)
        self.size = np.array([len(c) for c in self.codes], np.int64)
        budget = (self.size * EDITS).astype(np.int64)
        # where the lemma gives no bound, allow as many edits as leave one
        self.budget = np.minimum(budget, (self.size - Q) // Q)
        self.least = self.size - Q + 1 - Q * self.budget
        self.half = self.budget + 1
        grams = [gram_hashes(c) for c in self.codes]
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.gram, self.first = np.unique(flat[order], return_index=True)
        self.first = np.append(self.first, len(flat))
        prefix, slot = np.unique((self.gram >> np.uint64(64 - FILTER_BITS)).astype(np.int64), return_index=True)
        self.filter, self.slot = np.zeros(1 << FILTER_BITS, bool), np.zeros(1 << FILTER_BITS, np.int32)
        self.filter[prefix], self.slot[prefix] = True, slot


def look_up(p: Passages, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose q-gram some passage has, and its number in the index."""
    prefix = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    hit = np.flatnonzero(p.filter[prefix])
    at, prefix, h = p.slot[prefix[hit]], prefix[hit], h[hit]
    found = p.gram[at] == h
    rest = np.flatnonzero(~found)
    while len(rest):                      # the few prefixes that several q-grams share
        at[rest] += 1
        rest = rest[at[rest] < len(p.gram)]
        rest = rest[(p.gram[at[rest]] >> np.uint64(64 - FILTER_BITS)).astype(np.int64) == prefix[rest]]
        same = p.gram[at[rest]] == h[rest]
        found[rest[same]] = True
        rest = rest[~same]
    return hit[found], at[found]


def candidates(p: Passages, code: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int, int]]:
    """``(text, passage, first diagonal of the band)`` of all bands that reach
    the bound.

    Shared q-grams are counted per half band; two neighbours are a band.
    Counts in a hashed table, which can only be too high, leave out almost
    everything before the exact count.  Segments overlap by more than any
    band's region, and a segment with very many shared q-grams is halved."""
    out: set[tuple[int, int, int]] = set()
    if not len(p.size) or len(code) < Q:
        return out
    reach = int(p.size.max() + 4 * p.half.max()) + Q
    h = gram_hashes(code)
    todo = [(lo, min(lo + SEGMENT, len(h))) for lo in range(0, len(h), SEGMENT)]
    while todo:
        lo, hi = todo.pop()
        hit, at = look_up(p, h[lo:hi + reach])
        hit += lo
        text = np.searchsorted(bounds, hit, side="right") - 1
        inside = hit + Q <= bounds[text + 1]
        hit, at, text = hit[inside], at[inside], text[inside]
        count = p.first[at + 1] - p.first[at]
        if count.sum() > MOST_PAIRS and hi - lo > reach:
            todo += [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)]
            continue
        if not len(hit):
            continue
        posting = np.arange(int(count.sum())) + np.repeat(p.first[at] - (np.cumsum(count) - count), count)
        item = p.owner[posting]
        place = np.repeat(hit - bounds[text], count)      # inside the text
        half = (place - p.place[posting] + p.size[item]) // p.half[item]
        first, span = int(text[0]), int(half.max()) + 3
        pair = np.repeat(text - first, count) * len(p.size) + item
        key = pair * span + half + 1
        slots = [((key + d).astype(np.uint64) * MULT >> np.uint64(64 - COUNT_BITS)).astype(np.int64) for d in (-1, 0, 1)]
        table = np.bincount(slots[1], minlength=1 << COUNT_BITS)
        own = table[slots[1]]
        some = np.flatnonzero(own + np.maximum(table[slots[0]], table[slots[2]]) >= p.least[item])
        if not len(some):
            continue
        # the bound counts places of the passage: a repeating text has each but once
        most = int(p.size.max())
        key, n = np.unique(np.unique(key[some] * most + p.place[posting[some]]) // most, return_counts=True)
        after = np.append(np.where(np.diff(key) == 1, n[1:], 0), 0)
        pair = key // span
        i = pair % len(p.size)
        for k in np.flatnonzero(n + after >= p.least[i]):
            out.add((int(pair[k] // len(p.size)) + first, int(i[k]), int((key[k] % span - 1) * p.half[i[k]] - p.size[i[k]])))
    return out


def verbatim(passage: np.ndarray, text: np.ndarray, first: int, width: int) -> int | None:
    """The first diagonal of a band on which the text holds the passage as it is."""
    lo, hi = max(first, 0), min(first + width, len(text) - len(passage) + 1)
    if lo >= hi:
        return None
    rows = np.lib.stride_tricks.sliding_window_view(text[lo:hi + len(passage) - 1], len(passage))
    same = np.flatnonzero((rows == passage).all(axis=1))
    return lo + int(same[0]) if len(same) else None


def align(passage: np.ndarray, text: np.ndarray, first: int, width: int, budget: int) -> tuple[int, int, int] | None:
    """Fewest edits of the passage against a part of the text, on diagonals
    from ``first - budget`` to ``first + width + budget``: edits, and start
    and end of the part; none beyond the budget.  Of equals, the first end."""
    lo, cells = first - budget, width + 2 * budget + 1
    worst = budget + 1
    place = lo + np.arange(cells)                       # text place before which row 0 stands
    cost = np.where((place >= 0) & (place <= len(text)), 0, worst)
    start = place.copy()
    steps = np.arange(cells)
    padded = np.full(cells + len(passage) + 1, np.uint32(0xFFFFFFFF))
    src = np.arange(len(padded)) + lo
    real = (src >= 0) & (src < len(text))
    padded[real] = text[src[real]]
    for i, c in enumerate(passage):
        here = place + i                                # the text place of each cell's diagonal step
        ok = (here >= 0) & (here < len(text))
        straight = np.where(ok, cost + (padded[i:i + cells] != c), worst)
        down = np.append(cost[1:] + 1, worst)           # the passage's character is missing
        take = down < straight
        new = np.where(take, down, straight)
        begun = np.where(take, np.append(start[1:], 0), start)
        # extra characters of the text: move right along the row
        ahead = new - steps
        best = np.minimum.accumulate(ahead)
        source = np.maximum.accumulate(np.where(ahead == best, steps, 0))
        cost, start = np.minimum(best + steps, worst), begun[source]
    end = place + len(passage)
    cost = np.where((end >= 0) & (end <= len(text)), cost, worst)
    at = int(cost.argmin())
    return (int(cost[at]), int(start[at]), int(end[at])) if cost[at] <= budget else None


def find_passages(p: Passages, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """``(text, passage, edits, start, end)``: the best region of each passage
    in each text that holds it; start and end in the text's code points."""
    code, bounds, origin = normal_form(data, offsets)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for t, i, first in sorted(candidates(p, code, bounds)):
        if (t, i) in best and best[t, i][0] == 0:
            continue                       # bands come in order, so this is the first place
        passage, text, width = p.codes[i], code[bounds[t]:bounds[t + 1]], 2 * int(p.half[i])
        exact = verbatim(passage, text, first, width)
        found = (0, exact, exact + len(passage)) if exact is not None else \
            align(passage, text, first, width, int(p.budget[i]))
        if found and ((t, i) not in best or found[:2] < best[t, i][:2]):
            best[t, i] = found
    return [(t, i, e, int(origin[bounds[t] + s]), int(origin[bounds[t] + end - 1]) + 1) for (t, i), (e, s, end) in best.items()]


def _matches(passages):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Passages(*passages.value)
        for rows, data, offsets in slices(batches, max_bytes=2 << 20):
            found = sorted(find_passages(index, data, offsets))
            ids = rows.column("doc_id")
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array([f[0] for f in found], pa.int64())),
                rows.column("mark").take(pa.array([f[0] for f in found], pa.int64())),
                pa.array([index.ids[f[1]] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.int64()),
                pa.array([f[4] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64()),
                pa.array([1 - f[2] / int(index.size[f[1]]) for f in found], pa.float64())],
                ["doc_id", "mark", "item_id", "start", "end", "edits", "likeness"])

    return run


def contaminated(documents: DataFrame, benchmark: DataFrame, block_bytes: int = 8 << 20) -> DataFrame:
    """``doc_id, mark, item_id, start, end, edits, likeness``: one row per
    document and benchmark passage it holds with at most a tenth of the
    passage's characters edited, with its best region (code points of the
    text, end exclusive).  ``mark`` is ``xxhash64(text)``.

    Texts are compared with A-Z lowered and runs of white space as one space.
    Passages are taken in blocks of about ``block_bytes``; a block is sent
    to all tasks, and every document is read whole against every block.

    Null and empty texts hold nothing; null, empty and very short passages
    (under seven characters) are not searched; passages too short for the
    bound are searched with as few edits as leave one.  Repeated rows are
    reported as often as they occur; null ids are carried along.  Empty
    tables give no rows.  Other columns are ignored."""
    spark = documents.sparkSession
    items = benchmark.select("item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    rows = with_id(documents, "text", F.xxhash64("text").alias("mark")).where("text is not null")
    out = None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        if not part:
            continue
        shared = spark.sparkContext.broadcast(([r.item_id for r in part], [r.text for r in part]))
        found = rows.mapInArrow(_matches(shared), "doc_id bigint, mark bigint, item_id bigint, start bigint, end bigint, "
                                                  "edits bigint, likeness double")
        out = found if out is None else out.union(found)
    if out is None:
        out = spark.createDataFrame([], "doc_id bigint, mark bigint, item_id bigint, start bigint, end bigint, "
                                        "edits bigint, likeness double")
    return out


def remove_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without those that hold a benchmark passage; all columns
    are kept, and a document without doc_id is judged by its text alone."""
    found = contaminated(documents, benchmark).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct()
    return documents.join(found, documents["doc_id"].eqNullSafe(F.col("_id"))
                          & (F.xxhash64(documents["text"]) == F.col("_mark")), "left_anti")
