"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters of eight bytes slide over the whole
document in steps of four; overlapping chunks max-pool their responses; a
hidden layer reads each chunk, and the mean and maximum over all chunks
give one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.llm.arrays import slices, with_id
from formweave.llm.labelled import Adam, labelled_sample, sigmoid

UNIT = 4                # bytes a filter moves by; a filter sees two units
BLOCK = 16              # filter positions that are pooled at once
CHUNK, STEP = 4, 3      # blocks of a chunk, and between chunk starts
EMBED, FILTERS, HIDDEN = 8, 32, 16


def layout(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes padded with zeros to whole blocks; the filter
    positions that are only padding; the blocks of each chunk (a short last
    chunk repeats its last block); and the first chunk of each text.  Chunks
    overlap and cover every position of a text."""
    size = np.diff(offsets)
    places = np.maximum(1, -(-size // UNIT) - 1)
    blocks = -(-(places + 1) // BLOCK)
    begin = np.concatenate(([0], np.cumsum(blocks)))
    padded = np.zeros(int(begin[-1]) * BLOCK * UNIT, np.uint8)
    for at, lo, hi in zip(begin * BLOCK * UNIT, offsets, offsets[1:]):
        padded[at:at + hi - lo] = data[lo:hi]
    spare = blocks * BLOCK - places
    unused = np.arange(int(spare.sum())) + np.repeat(begin[:-1] * BLOCK + places - (np.cumsum(spare) - spare), spare)
    chunks = 1 + np.maximum(0, -(-(blocks - CHUNK) // STEP))
    first = np.concatenate(([0], np.cumsum(chunks)))
    number = np.arange(int(first[-1])) - np.repeat(first[:-1], chunks)
    lo = np.repeat(begin[:-1], chunks) + number * STEP
    return padded, unused, np.minimum(lo[:, None] + np.arange(CHUNK), np.repeat(begin[1:] - 1, chunks)[:, None]), first


def at_positions(p: dict[str, np.ndarray], padded: np.ndarray) -> np.ndarray:
    """All filters at all positions; the last one sees nothing behind it."""
    units = p["embed"][padded].reshape(-1, UNIT * EMBED)
    half = UNIT * EMBED
    out = units @ p["filters"][:half]
    out[:-1] += (units @ p["filters"][half:])[1:]
    return out


def responses(p: dict[str, np.ndarray], padded: np.ndarray, unused: np.ndarray) -> np.ndarray:
    """All filters at all positions, as ``(block, position, filter)``."""
    out = at_positions(p, padded)
    out[unused] = -1e30
    return out.reshape(-1, BLOCK, FILTERS)


def block_maxima(p: dict[str, np.ndarray], padded: np.ndarray, unused: np.ndarray, many: int = 1 << 14) -> np.ndarray:
    """The highest response of each filter in each block, ``many`` blocks at a
    time, so that one huge text needs little more memory than its bytes."""
    out = np.empty((len(padded) // (BLOCK * UNIT), FILTERS), np.float32)
    for at in range(0, len(out), many):
        end = min(at + many, len(out))
        found = at_positions(p, padded[at * BLOCK * UNIT:(end * BLOCK + 1) * UNIT])[:(end - at) * BLOCK]
        lo, hi = np.searchsorted(unused, (at * BLOCK, end * BLOCK))
        found[unused[lo:hi] - at * BLOCK] = -1e30
        out[at:end] = found.reshape(-1, BLOCK, FILTERS).max(axis=1)
    return out


def head(p: dict[str, np.ndarray], pooled: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """From the chunks' pooled responses to one probability a text."""
    act = np.maximum(pooled + p["bias"], 0)
    inner = act @ p["hidden"] + p["hidden_bias"]
    chunk = np.maximum(inner, 0)
    mean = np.add.reduceat(chunk, first[:-1], axis=0) / np.diff(first)[:, None]
    most = np.maximum.reduceat(chunk, first[:-1], axis=0)
    whole = np.concatenate((mean, most), axis=1)
    return {"act": act, "inner": inner, "chunk": chunk, "most": most, "whole": whole,
            "score": sigmoid(whole @ p["out"] + p["out_bias"][0])}


def score_texts(p: dict[str, np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    padded, unused, chunks, first = layout(data, offsets)
    most, pooled = block_maxima(p, padded, unused), np.full((len(chunks), FILTERS), -np.inf, np.float32)
    for blocks in chunks.T:
        np.maximum(pooled, most[blocks], out=pooled)
    return head(p, pooled, first)["score"].astype(np.float64)


def gradients(p: dict[str, np.ndarray], data: np.ndarray, offsets: np.ndarray, label: np.ndarray,
              weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted mean log loss of a batch and its gradients."""
    padded, unused, chunks, first = layout(data, offsets)
    out = responses(p, padded, unused)
    most = out.max(axis=1)
    best = np.take_along_axis(chunks, most[chunks].argmax(axis=1).reshape(len(chunks), -1), axis=1)  # block of each maximum
    pooled = np.take_along_axis(most, best, axis=0)
    inside = (out[best, :, np.arange(FILTERS)] == pooled[:, :, None]).argmax(axis=2)
    best = best * BLOCK + inside                                          # position, for every chunk and filter
    h = head(p, pooled, first)
    score = np.clip(h["score"], 1e-7, 1 - 1e-7)
    loss = float(-(weight * (label * np.log(score) + (1 - label) * np.log(1 - score))).sum() / weight.sum())
    d = (weight * (h["score"] - label) / weight.sum()).astype(np.float32)
    count = np.diff(first)
    d_whole = d[:, None] * p["out"][None]
    d_chunk = np.repeat(d_whole[:, :HIDDEN] / count[:, None], count, axis=0)
    top = h["chunk"] == np.repeat(h["most"], count, axis=0)
    ties = np.repeat(np.add.reduceat(top.astype(np.float32), first[:-1], axis=0), count, axis=0)
    d_chunk = d_chunk + np.repeat(d_whole[:, HIDDEN:], count, axis=0) * top / ties
    d_inner = d_chunk * (h["inner"] > 0)
    d_pooled = (d_inner @ p["hidden"].T) * (h["act"] > 0)
    # how much gradient each byte value gets at each place of each filter
    seen = padded[best[:, :, None] * UNIT + np.arange(2 * UNIT)]          # (chunks, filters, 8) bytes
    cell = (np.arange(FILTERS * 2 * UNIT) * 256).reshape(1, FILTERS, -1) + seen
    felt = np.bincount(cell.ravel(), np.repeat(d_pooled.ravel(), 2 * UNIT), FILTERS * 2 * UNIT * 256)
    felt = felt.astype(np.float32).reshape(FILTERS, 2 * UNIT, 256)
    taps = p["filters"].reshape(2 * UNIT, EMBED, FILTERS)
    return loss, {
        "embed": np.tensordot(felt, taps, axes=((0, 1), (2, 0))),
        "filters": (felt @ p["embed"]).transpose(1, 2, 0).reshape(-1, FILTERS), "bias": d_pooled.sum(axis=0),
        "hidden": h["act"].T @ d_inner, "hidden_bias": d_inner.sum(axis=0),
        "out": h["whole"].T @ d, "out_bias": np.array([d.sum()], np.float32)}


def start_parameters(seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {"embed": normal(256, EMBED, scale=0.5), "filters": normal(2 * UNIT * EMBED, FILTERS, scale=0.15),
            "bias": np.zeros(FILTERS, np.float32), "hidden": normal(FILTERS, HIDDEN, scale=0.2),
            "hidden_bias": np.zeros(HIDDEN, np.float32), "out": normal(2 * HIDDEN, scale=0.2),
            "out_bias": np.zeros(1, np.float32)}


def batch_of(texts: pa.Array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, data, offsets = next(slices([pa.RecordBatch.from_arrays([texts.take(pa.array(rows))], ["text"])],
                                   max_bytes=1 << 40))
    return data, offsets


def train(texts: pa.Array, label: np.ndarray, epochs: int = 8, batch: int = 48) -> dict[str, np.ndarray]:
    """Parameters learnt from whole texts; both classes weigh the same."""
    p = start_parameters()
    if not len(label):
        return p
    rng, adam = np.random.default_rng(2), Adam(p, 0.004, 1e-5)
    share = label.mean()
    weight = np.where(label > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    steps = epochs * -(-len(label) // batch)
    # short samples get more epochs, so that every fit makes some hundred steps
    epochs = int(epochs * max(1, -(-250 // steps)))
    for epoch in range(epochs):
        adam.rate = 0.004 * (1 - epoch / epochs) + 0.0002
        order = rng.permutation(len(label))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            data, offsets = batch_of(texts, rows)
            _, grads = gradients(p, data, offsets, label[rows], weight[rows])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            adam.step({k: g * min(1.0, 1.0 / max(norm, 1e-9)) for k, g in grads.items()})
    return p


def _scorer(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches):
            score = score_texts(model, data, offsets)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("held_out"), pa.array(score),
                 pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return run


def quality_scores(documents: DataFrame, labels: DataFrame, held_out: Column, per_class: int = 1200,
                   threshold: float = 0.3) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, held_out, score,
    predicted`` (1 if ``score >= threshold``); the score tells how likely
    ``labels.quality`` is 1.

    Only the text is an input of a score.  The network is trained on at most
    ``per_class`` labelled documents of each class outside ``held_out`` (a
    condition over ``doc_id``; null counts as false) and on their whole
    texts; it then reads every byte of every document.  Null and empty texts
    get the score of an empty text.  Without labels the network is untrained
    and scores are near 0.5.  An empty table gives no rows; other columns
    are ignored."""
    held = F.coalesce(held_out, F.lit(False))
    texts, label = labelled_sample(documents, labels, "quality", ~held, per_class)
    model = train(texts, label)
    return with_id(documents, "text", held.alias("held_out")).mapInArrow(
        _scorer(model, threshold), "doc_id bigint, held_out boolean, score double, predicted int")
