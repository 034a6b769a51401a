"""Toxicity: a bidirectional gated recurrent network with attention pooling,
trained in numpy.

Every word is one input vector: how much its spelling as a whole, its
beginnings and its inner character sequences speak for a toxic text (log
odds learnt from the labelled sample, in hashed tables), and its form.
The network reads overlapping windows of words in both directions, pools
its states with attention, and the highest window decides the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formweave.llm.arrays import LOWER, SPACE, mix, slices, words, with_id
from formweave.llm.labelled import Adam, labelled_sample, sigmoid

WINDOW, STRIDE = 48, 36          # words
STATES, ATTENTION = 8, 8
TABLE_BITS = 18
PREFIXES, INNER = (4, 6), 5      # bytes
INPUTS = 6
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LETTER = np.zeros(256, bool)
LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def word_keys(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The slots of each word in the tables: the whole lower-cased word
    without marks around it, its beginnings, and all its inner sequences
    (``inner`` in a row, ``inner_of`` the word of each).  Also the share of
    its bytes that are no letters, and the first word of each text."""
    low = LOWER[data]
    starts, ends, first = words(data, offsets)
    letter = LETTER[low]
    # narrow each word to its first and last letter; a word without letters stays whole
    place = np.arange(len(low))
    following = np.minimum.accumulate(np.where(letter, place, len(low))[::-1])[::-1] if len(low) else place
    preceding = np.maximum.accumulate(np.where(letter, place, -1)) if len(low) else place
    lo, hi = (following[starts], preceding[ends - 1] + 1) if len(starts) else (starts, ends)
    bare = (lo >= ends) | (hi <= starts)
    lo, hi = np.where(bare, starts, lo), np.where(bare, ends, hi)
    size = hi - lo
    padded = np.concatenate((low, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(low) + 1, np.dtype("<u8"), padded.data, strides=(1,))     # the next eight bytes

    def slot(h: np.ndarray, salt: int) -> np.ndarray:
        return (mix(h ^ np.uint64(salt)) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)

    def run(at: np.ndarray, length: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` (at most eight) bytes from each position, packed."""
        return eight[at] & FIRST_BYTES[np.minimum(length, most)]

    count = np.maximum(size - INNER + 1, 0)
    inner_of = np.repeat(np.arange(len(lo), dtype=np.int32), count)
    at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    sequence = eight[at] & FIRST_BYTES[INNER]
    whole = np.zeros(len(lo), np.uint64)
    if len(lo):
        inside = np.concatenate(([0], np.cumsum(letter.astype(np.int64))))
        other = 1 - (inside[ends] - inside[starts]) / (ends - starts)
        # whole words: head, tail and length of the spelling
        whole = mix(run(lo, size, 8) + mix(run(np.maximum(hi - 8, lo), size, 8)) + size.astype(np.uint64))
    else:
        other = np.zeros(0)
    return {"word": slot(whole, 0), **{f"prefix{n}": slot(run(lo, size, n), n) for n in PREFIXES},
            "inner": slot(sequence, 0), "inner_of": inner_of, "other": other.astype(np.float32), "first": first,
            "upper": np.logical_and(data[starts] >= 65, data[starts] <= 90).astype(np.float32) if len(lo) else np.zeros(0, np.float32)}


TABLES = ["word", *[f"prefix{n}" for n in PREFIXES], "inner"]


def joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """The keys of consecutive slices as one."""
    at = np.cumsum([0, *[len(k["word"]) for k in parts]])
    out = {name: np.concatenate([k[name] for k in parts]) for name in parts[0] if name not in ("first", "inner_of")}
    out["inner_of"] = np.concatenate([k["inner_of"] + np.int32(a) for k, a in zip(parts, at)])
    out["first"] = np.concatenate([[0], *[k["first"][1:] + a for k, a in zip(parts, at)]])
    return out


def presence(keys: dict[str, np.ndarray], table: str, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, slot) pairs of a table."""
    of_word = np.repeat(np.arange(n_texts), np.diff(keys["first"]))
    of = of_word[keys["inner_of"]] if table == "inner" else of_word
    pair = np.unique(of << TABLE_BITS | keys[table])
    return pair >> TABLE_BITS, pair & ((1 << TABLE_BITS) - 1)


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """How much more often toxic texts have it, drawn to zero where it is rare."""
    return (np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))) * (toxic + clean) / (toxic + clean + 8)


def inputs(keys: dict[str, np.ndarray], odds: dict[str, np.ndarray]) -> np.ndarray:
    """The input vector of each word; ``odds`` are the values looked up per key."""
    inner = np.zeros(len(keys["word"]), np.float32)
    if len(keys["inner"]):
        starts = np.flatnonzero(np.diff(keys["inner_of"], prepend=-1))
        inner[keys["inner_of"][starts]] = np.maximum.reduceat(odds["inner"], starts)
    return np.stack([odds["word"], *[odds[f"prefix{n}"] for n in PREFIXES], inner, keys["other"], keys["upper"]],
                    axis=1).astype(np.float32)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and length of each window, and the first window of each
    text.  Windows overlap and cover all words; a text without words has one
    empty window."""
    n = np.diff(first)
    count = 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE))
    begin = np.concatenate(([0], np.cumsum(count)))
    number = np.arange(int(begin[-1])) - np.repeat(begin[:-1], count)
    start = np.repeat(first[:-1], count) + number * STRIDE
    return start, np.minimum(WINDOW, np.repeat(first[1:], count) - start), begin


def gather(x: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows as ``(step, window, input)`` with a mask of real steps."""
    steps = np.arange(max(1, int(length.max(initial=0))))[:, None]
    mask = steps < length
    if not len(x):
        return np.zeros((*mask.shape, INPUTS), np.float32), mask
    return x[np.where(mask, start + steps, 0)] * mask[:, :, None].astype(np.float32), mask


def start_parameters(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {}
    for way in ("f", "b"):
        p[way + "w"] = rng.standard_normal((INPUTS, 3 * STATES)) * 0.4
        p[way + "u"] = rng.standard_normal((STATES, 3 * STATES)) * 0.3
        p[way + "c"] = np.concatenate((np.zeros(STATES), -np.ones(STATES), np.zeros(STATES)))
    p["att"], p["att_bias"] = rng.standard_normal((2 * STATES, ATTENTION)) * 0.4, np.zeros(ATTENTION)
    p["look"] = rng.standard_normal(ATTENTION) * 0.4
    p["out"], p["out_bias"] = rng.standard_normal(2 * STATES) * 0.4, np.array([-1.0])
    return {k: v.astype(np.float32) for k, v in p.items()}


def read(p: dict, way: str, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States of one direction (reset, update, candidate gates); a step beyond
    the window's end leaves the state as it is."""
    steps = len(x)
    pre = x @ p[way + "w"] + p[way + "c"]
    out = np.zeros((*x.shape[:2], STATES), x.dtype)
    h = np.zeros((x.shape[1], STATES), x.dtype)
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        rec = h @ p[way + "u"]
        gates = 1 / (1 + np.exp(-(pre[t, :, :2 * STATES] + rec[:, :2 * STATES])))
        r, z = gates[:, :STATES], gates[:, STATES:]
        new = np.tanh(pre[t, :, 2 * STATES:] + r * rec[:, 2 * STATES:])
        update = (z * mask[t][:, None]).astype(x.dtype)
        if keep is not None:
            keep.append((t, h, r, z, new, rec[:, 2 * STATES:], update))
        h = h + update * (new - h)
        out[t] = h
    return out


def forward(p: dict, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logit of each window."""
    traces = {"f": [], "b": []} if keep is not None else {"f": None, "b": None}
    states = np.concatenate([read(p, way, x, mask, traces[way]) for way in ("f", "b")], axis=2)
    hidden = np.tanh(states @ p["att"] + p["att_bias"])
    weight = np.where(mask, hidden @ p["look"], -1e9)
    weight = np.exp(weight - weight.max(axis=0)) * mask
    weight = (weight / np.maximum(weight.sum(axis=0), 1e-9)).astype(x.dtype)
    pooled = (states * weight[:, :, None]).sum(axis=0)
    if keep is not None:
        keep.update(traces=traces, states=states, hidden=hidden, weight=weight, pooled=pooled, x=x, mask=mask)
    return pooled @ p["out"] + p["out_bias"][0]


def backward(p: dict, k: dict, d: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients from the derivative ``d`` of the loss by each logit."""
    g = {"out": k["pooled"].T @ d, "out_bias": np.array([d.sum()])}
    d_pooled = d[:, None] * p["out"]
    d_weight = (k["states"] * d_pooled).sum(axis=2)
    d_score = k["weight"] * (d_weight - (k["weight"] * d_weight).sum(axis=0))
    d_hidden = d_score[:, :, None] * p["look"] * (1 - k["hidden"] ** 2)
    g["look"] = np.tensordot(d_score, k["hidden"], axes=2)
    g["att"], g["att_bias"] = np.tensordot(k["states"], d_hidden, axes=((0, 1), (0, 1))), d_hidden.sum(axis=(0, 1))
    d_states = k["weight"][:, :, None] * d_pooled + d_hidden @ p["att"].T
    for at, way in enumerate(("f", "b")):
        w, u, c = (np.zeros_like(p[way + n]) for n in "wuc")
        carry = np.zeros((k["x"].shape[1], STATES), k["x"].dtype)
        for t, h, r, z, new, rec, update in reversed(k["traces"][way]):
            carry = carry + d_states[t, :, at * STATES:(at + 1) * STATES]
            d_new = carry * update * (1 - new ** 2)
            d_z = carry * (new - h) * k["mask"][t][:, None] * z * (1 - z)
            d_r = d_new * rec * r * (1 - r)
            pre = np.concatenate((d_r, d_z, d_new), axis=1)
            through = np.concatenate((d_r, d_z, d_new * r), axis=1)
            w += k["x"][t].T @ pre
            u += h.T @ through
            c += pre.sum(axis=0)
            carry = carry * (1 - update) + through @ p[way + "u"].T
        g.update({way + "w": w, way + "u": u, way + "c": c})
    return g


def window_logits(p: dict, x: np.ndarray, first: np.ndarray, many: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    """Logits of all windows, and the first window of each text."""
    start, length, begin = windows(first)
    parts = [forward(p, *gather(x, start[at:at + many], length[at:at + many])) for at in range(0, len(start), many)]
    return np.concatenate(parts), begin


def train(texts: pa.Array, label: np.ndarray, rounds: int = 6, batch: int = 64) -> dict:
    """The odds tables and network parameters learnt from whole texts.

    A document's label is that of its highest window: every round first
    scores all windows of all sample texts, then learns on the highest one of
    each text.
    While training, the tables leave out the text at hand."""
    n = len(label)
    model = {"tables": {t: np.zeros(1 << TABLE_BITS, np.float32) for t in TABLES}, "net": start_parameters()}
    if not n:
        return model
    keys = joined([word_keys(data, offsets) for _, data, offsets in
                   slices([pa.RecordBatch.from_arrays([texts], ["text"])], max_bytes=1 << 19)])
    n_toxic, n_clean = label.sum(), n - label.sum()
    text = np.repeat(np.arange(n), np.diff(keys["first"]))
    own = {}
    for table in TABLES:
        of, slot = presence(keys, table, n)
        toxic = np.bincount(slot, label[of], 1 << TABLE_BITS)
        clean = np.bincount(slot, 1 - label[of], 1 << TABLE_BITS)
        model["tables"][table] = log_odds(toxic, clean, n_toxic, n_clean).astype(np.float32)
        mine = label[text[keys["inner_of"]] if table == "inner" else text]
        left = keys[table]
        own[table] = log_odds(toxic[left] - mine, clean[left] - (1 - mine), n_toxic, n_clean).astype(np.float32)
    x = inputs(keys, own)
    p, rng = model["net"], np.random.default_rng(4)
    adam = Adam(p, 0.01, 1e-5)
    balance = np.where(label > 0, 0.5 / max(n_toxic, 1), 0.5 / max(n_clean, 1)) * n
    start, length, begin = windows(keys["first"])
    of = np.repeat(np.arange(n), np.diff(begin))
    repeats = max(1, 3000 // n)
    # before the network knows anything: the window with the strongest words
    strength = x[:, :4].max(axis=1) if len(x) else np.zeros(0)
    logit = np.array([strength[s:s + m].max(initial=-9.0) for s, m in zip(start, length)])
    for turn in range(rounds):
        order = np.lexsort((-logit, of))
        chosen = order[begin[:-1]]
        for _ in range(repeats):
            for rows in np.array_split(rng.permutation(n), max(1, -(-n // batch))):
                keep: dict = {}
                win = chosen[rows]
                out = forward(p, *gather(x, start[win], length[win]), keep)
                d = ((sigmoid(out) - label[rows]) * balance[rows] / len(rows)).astype(np.float32)
                grads = backward(p, keep, d)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                adam.step({k: g * min(1.0, 2.0 / max(norm, 1e-9)) for k, g in grads.items()})
        adam.rate *= 0.75
        if turn + 1 < rounds:
            logit, _ = window_logits(p, x, keys["first"])
    return model


def highest_windows(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The highest window's logit for each text."""
    keys = word_keys(data, offsets)
    x = inputs(keys, {t: model["tables"][t][keys[t]] for t in TABLES})
    logit, begin = window_logits(model["net"], x, keys["first"])
    return np.maximum.reduceat(logit, begin[:-1])


def pieces(data: np.ndarray, max_bytes: int) -> Iterator[np.ndarray]:
    """One text in pieces of about ``max_bytes`` whose windows are, together,
    those of the text: each piece begins with the first window that is not
    whole in the one before.  A piece ends between words, so a single word
    may make it longer."""
    at = 0
    while len(data) - at > max_bytes:
        space = np.flatnonzero(SPACE[data[at + max_bytes:at + 2 * max_bytes]])
        if not len(space):
            space = np.flatnonzero(SPACE[data[at + max_bytes:]])
        if not len(space):
            break
        piece = data[at:at + max_bytes + int(space[0])]
        starts, ends, _ = words(piece, np.array([0, len(piece)]))
        count = (len(starts) - (WINDOW - STRIDE) - 1) // STRIDE
        if count > 0:
            yield piece[:ends[(count - 1) * STRIDE + WINDOW - 1]]
            at += int(starts[count * STRIDE])
        else:                                  # hardly any words in so many bytes
            max_bytes *= 2
    yield data[at:]


def score_texts(model: dict, data: np.ndarray, offsets: np.ndarray, max_bytes: int = 2 << 20) -> np.ndarray:
    """The highest window's probability for each text; a single text beyond
    ``max_bytes`` is read in pieces."""
    if len(offsets) == 2 and len(data) > max_bytes:
        logit = np.max([highest_windows(model, x, np.array([0, len(x)])) for x in pieces(data, max_bytes)], axis=0)
    else:
        logit = highest_windows(model, data, offsets)
    return sigmoid(logit.astype(np.float64))


def _scorer(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, max_bytes=2 << 20):
            score = score_texts(shared.value, data, offsets)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("held_out"), pa.array(score),
                 pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return run


def toxicity_scores(documents: DataFrame, labels: DataFrame, held_out: Column, per_class: int = 600,
                    threshold: float = 0.7) -> DataFrame:
    """One row per row of ``documents``: ``doc_id, held_out, score,
    predicted`` (1 if ``score >= threshold``); the score tells how likely
    ``labels.toxic`` is 1.

    Only the text is an input of a score.  Tables and network are trained on
    at most ``per_class`` labelled documents of each class outside
    ``held_out`` (a condition over ``doc_id``; null counts as false) and on
    their whole texts; all windows of every document are then scored, those
    of a very long text piece by piece (a single word is not divided: one of
    many megabytes takes some 80 times its bytes).  Null and empty texts have one empty window.  Without labels the network is
    untrained.  An empty table gives no rows; other columns are ignored."""
    held = F.coalesce(held_out, F.lit(False))
    texts, label = labelled_sample(documents, labels, "toxic", ~held, per_class)
    shared = documents.sparkSession.sparkContext.broadcast(train(texts, label))
    return with_id(documents, "text", held.alias("held_out")).mapInArrow(
        _scorer(shared, threshold), "doc_id bigint, held_out boolean, score double, predicted int")


def _filter(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, max_bytes=2 << 20):
            yield rows.filter(pa.array(score_texts(shared.value, data, offsets) < threshold))

    return run


def drop_toxic(documents: DataFrame, labels: DataFrame, held_out: Column, per_class: int = 600,
               threshold: float = 0.7) -> DataFrame:
    """``documents`` without those that ``toxicity_scores`` predicts to be
    toxic; all columns are kept and no text is shuffled."""
    texts, label = labelled_sample(documents, labels, "toxic", ~F.coalesce(held_out, F.lit(False)), per_class)
    shared = documents.sparkSession.sparkContext.broadcast(train(texts, label))
    return documents.mapInArrow(_filter(shared, threshold), documents.schema)
