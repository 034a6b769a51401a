"""Language-model scoring with a weighted backoff automaton over n-grams of words.

The probability of a word is the interpolated Witten-Bell one of up to
``WORDS`` words: a context (the words before) that the training texts have
hands a share of its mass to the shorter context, one they lack all of it.
Below single words lies the uniform distribution over the vocabulary and one
unknown word, so the model is a distribution over these, as the add-one
baseline is.  Every n-gram counts, however rare, and nothing of the model is
gathered.

Scoring.  A block of texts gets the corpus counts of its own n-grams and
makes the part of the automaton that its texts can reach: contexts are
states, n-grams with a count are arcs, and a failure arc leads from each
context to the shorter one at its backoff weight.  One left-to-right
traversal of each text carries the state and sums the log-probabilities.

Scale.  Counts are asked for length by length, bucket by bucket of the hash
space of contexts.  A frequent n-gram costs one entry per block, not one per
document.  The answer also says whether another block has the n-gram; if not,
the block alone has all that follows it, and counts that itself.  How often a
context occurs is known from the length before.  The n-grams of a context
that would fill a bucket alone are dealt by themselves; the totals of these
few contexts, the empty one among them, are summed over all buckets.

``frequent_words`` and ``train`` learn a small automaton of word classes
that fits one process; scoring does not use them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.llm.arrays import LOWER, MULT, mix, slices, word_hashes, words, with_id
from formweave.llm.automaton import BITS, END, ORDER, RARE, SYMBOLS, Automaton, SortedAutomaton, compile_automaton, grams
from formweave.llm.components import cut
from formweave.session import ensure_checkpoint_dir

END_TOKEN = np.uint64(0)        # stands for the end of a text among word hashes
MERGE_ROWS = 1 << 21
WORDS = 4                       # of the longest n-gram
NO_CONTEXT = np.uint64(0)       # hash of the empty context


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (each text's words, then its end) and the offsets
    of the texts among them."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    hashes[hashes == END_TOKEN] = np.uint64(1)
    at = first + np.arange(len(first))
    out = np.full(int(at[-1]), END_TOKEN)
    out[np.arange(len(hashes)) + np.repeat(np.arange(len(first) - 1), np.diff(first))] = hashes
    return out, at


def _classes(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Symbol of each token; ``frequent`` holds sorted hashes."""
    if not len(frequent):
        return np.where(tokens == END_TOKEN, END, RARE)
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    return np.where(tokens == END_TOKEN, END, np.where(frequent[at] == tokens, at + 2, RARE))


def _counted(keys_of, share: float):
    """Arrow mapper: distinct keys of the task's texts with their counts.
    What a task holds is merged whenever it passes ``MERGE_ROWS`` and handed
    on when merging does not shrink it.  With ``share``, only keys with at
    least that part of what is handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return key, np.bincount(place, np.concatenate([c for _, c in held])).astype(np.int64)

        def give(key: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
            common = count >= share * count.sum()
            key, count = key[common], count[common]
            for at in range(0, len(key), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(key[at:at + 100_000].astype(np.int64)),
                                                  pa.array(count[at:at + 100_000])], ["key", "n"])

        for _, data, offsets in slices(batches):
            held.append(np.unique(keys_of(*_tokens(data, offsets)), return_counts=True))
            if sum(len(k) for k, _ in held) > MERGE_ROWS:
                held = [merged()]
                if len(held[0][0]) > MERGE_ROWS // 2:
                    yield from give(*held.pop())
        if held:
            yield from give(*merged())

    return run


def _count(texts: DataFrame, keys_of, share: float = 0.0) -> DataFrame:
    return (texts.select("text").mapInArrow(_counted(keys_of, share), "key bigint, n bigint")
            .groupBy("key").agg(F.sum("n").alias("n")))


def frequent_words(training: DataFrame) -> np.ndarray:
    """Sorted hashes of the words that get a class of their own: the
    ``SYMBOLS - 2`` most frequent ones among those that make up at least one
    in 50,000 of the tokens some task saw.  The choice only shapes the model;
    all counts in it are exact."""
    rows = (_count(training, lambda tokens, at: tokens[tokens != END_TOKEN], 1 / 50_000)
            .orderBy(F.desc("n"), "key").limit(SYMBOLS - 2).collect())
    return np.sort(np.array([r.key for r in rows], np.int64).astype(np.uint64))


def train(training: DataFrame, frequent: np.ndarray, max_grams: int = 1 << 18) -> Automaton:
    """The automaton learnt from all rows of ``training`` (column ``text``).

    Counts cover the whole table.  ``max_grams`` bounds the model, not the
    data: grams that occur at least ``m`` times are kept, with the smallest
    ``m >= 2`` for which they fit; the rest of the mass is in the backoff
    weights.  So what the driver compiles has a fixed bound."""
    ensure_checkpoint_dir(training.sparkSession)
    top = _count(training, lambda tokens, at: grams(_classes(tokens, frequent), at)).checkpoint()
    counted = None
    for k in range(1, ORDER + 1):
        gram = F.col("key").bitwiseAND(F.lit((1 << BITS * k) - 1).cast("bigint"))
        part = top.groupBy(gram.alias("gram")).agg(F.sum("n").alias("n")).withColumn("k", F.lit(k))
        counted = part if counted is None else counted.union(part)
    counted = counted.checkpoint()
    spread = sorted(((r.least, r.grams) for r in counted.groupBy(
        F.least("n", F.lit(1 << 16)).alias("least")).agg(F.count("*").alias("grams")).collect()), reverse=True)
    m, kept = 2, 0
    for least, number in spread:
        kept += number
        if kept > max_grams:
            m = max(2, least + 1)
            break
    context = F.shiftright("gram", BITS)
    around = counted.groupBy("k", context.alias("context")).agg(F.sum("n").alias("c"), F.count("*").alias("t"))
    rows = (counted.where((F.col("n") >= m) | (F.col("k") == 1)).withColumn("context", context)
            .join(around, ["k", "context"]).select("k", "gram", "n", "c", "t").toPandas())
    orders = []
    for k in range(1, ORDER + 1):
        part = rows[rows["k"] == k].sort_values("gram")
        orders.append(tuple(part[x].to_numpy() for x in ("gram", "n", "c", "t")))
    return compile_automaton(orders)


def _contexts(tokens: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of the 0, 1, ... ``WORDS - 1`` tokens before each token, length
    by length; before the first token of a text stands its end."""
    place = np.arange(len(tokens)) - np.repeat(at[:-1], np.diff(at))
    out = np.full(len(tokens), NO_CONTEXT)
    yield out
    for back in range(1, WORDS):
        word = np.full(len(tokens), END_TOKEN)
        word[back:] = tokens[:max(0, len(tokens) - back)]
        word[place < back] = END_TOKEN
        out = mix(out * MULT + word + np.uint64(back))
        yield out


def _place(among: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted array that is not empty, or -1."""
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return np.where(among[at] == keys, at, -1)


def _cuts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of rows with equal columns begins, and the end."""
    new = np.zeros(max(0, len(columns[0]) - 1), bool)
    for x in columns:
        new |= x[1:] != x[:-1]
    return np.concatenate(([0], np.flatnonzero(new) + 1, [len(columns[0])]))


def _pack(counts: np.ndarray) -> bytes:
    """One byte per count, then those of 255 and more in full."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data[:n], np.uint8).astype(np.int64)
    if len(data) > n:
        out[out == 255] = np.frombuffer(data[n:], np.int64)
    return out


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers by bytes, the lowest of all first, without those that
    are zero in all; the first byte says how many there are."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view(np.uint64).ravel()


def _blocks(block_bytes: int):
    """One row per block of texts: their ids and lengths, the hashes of the
    block's different tokens (frequent ones first) and the tokens as numbers
    of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, (rows, data, offsets) in enumerate(slices(batches, max_bytes=block_bytes)):
            tokens, at = _tokens(data, offsets)
            different, symbol, count = np.unique(tokens, return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")
            rank = np.empty(len(order), np.uint64)
            rank[order] = np.arange(len(order), dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([
                pa.array([(task << 32) | number]), pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([rows.column("held_out").to_pylist()], pa.list_(pa.bool_())),
                pa.array([np.diff(at)], pa.list_(pa.int64())), pa.array([different[order].tobytes()], pa.binary()),
                pa.array([zstandard.compress(_planes(rank[symbol]))], pa.binary())],
                ["block", "doc_id", "held_out", "lengths", "words", "symbols"])

    return run


class _Texts:
    """A block of texts read back."""

    def __init__(self, table: pa.Table):
        row = {name: table.column(name)[0] for name in table.column_names}
        self.block = row["block"].as_py()
        self.doc_id, self.held_out = row["doc_id"].values, row["held_out"].values
        self.at = np.concatenate(([0], np.cumsum(row["lengths"].values.to_numpy())))
        self.words = np.frombuffer(row["words"].as_py(), np.uint64)
        self.symbols = _from_planes(zstandard.decompress(row["symbols"].as_py())).astype(np.int64)
        self.tokens = self.words[self.symbols]
        held = np.asarray(self.held_out.to_pylist(), bool)
        self.learnt = np.repeat(~held, np.diff(self.at))


def _distinct(keys: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each different key (0 <= key < ``below``) stands first, by
    ascending key, and the rank of every key."""
    n = len(keys)
    bits = n.bit_length()
    if below.bit_length() + bits < 64:      # key and place in one number: a plain sort
        both = np.sort((keys << bits) | np.arange(n))
        order, ordered = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return order[new].astype(np.int32), rank


class _Grams:
    """The different n-grams of one length in a block, by context and word.

    ``index`` is the token each ends at first, ``place`` the n-gram of every
    token, ``own`` how often the block's training texts have it, ``of`` the
    number of its context (``context`` numbers those of all tokens) and
    ``asked`` those to ask for, context by context: by bucket, first those of
    common contexts, then those of ``hot`` ones, which are spread by n-gram.
    ``shared`` says of every token whether other blocks may have its context."""

    def __init__(self, texts: _Texts, context, hashes, shared, hot, n_buckets: int):
        n_words = len(texts.words)
        self.index, self.place = _distinct(context * n_words + texts.symbols, (int(context.max()) + 1) * n_words)
        self.own = np.bincount(self.place[texts.learnt], minlength=len(self.index))
        self.of = context[self.index].astype(np.int32)
        asked = np.flatnonzero(shared[self.index])
        of = hashes[self.index[asked]]
        runs = _cuts(self.of[asked])
        if not len(asked):
            runs = runs[:1]
        spread = _place(hot, of[runs[:-1]]) >= 0
        size = np.diff(runs)
        common = np.flatnonzero(~spread)
        common = common[np.argsort(of[runs[common]])]
        begin, size = runs[common], size[common]
        at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        dealt = np.flatnonzero(np.repeat(spread, np.diff(runs)))
        gram = mix(of[dealt] * MULT + texts.tokens[self.index[asked[dealt]]])
        dealt = dealt[np.lexsort((gram, of[dealt], _bucket(gram, n_buckets)))]
        gram = mix(of[dealt] * MULT + texts.tokens[self.index[asked[dealt]]])
        bucket = np.concatenate((_bucket(of[at], n_buckets), _bucket(gram, n_buckets)))
        kind = np.repeat([0, 1], [len(at), len(dealt)])
        at = np.concatenate((at, dealt))
        self.asked, of = asked[at], of[at]
        self.runs, self.rows = _cuts(kind, bucket, of), _cuts(kind, bucket)      # of one context; asked in one row
        if not len(at):
            self.runs, self.rows = self.runs[:1], self.rows[:1]
        self.heads = np.searchsorted(self.runs, self.rows)
        self.contexts, self.bucket = of[self.runs[:-1]], bucket[self.rows[:-1]]

    def answer(self, rows: pa.Table) -> None:
        """Corpus counts, and whether another block has the n-gram, from the
        answers in the order asked and from the block's own counts."""
        self.n, self.shared = self.own.copy(), np.zeros(len(self.own), bool)
        for lo, hi, n, shared in zip(self.rows[:-1], self.rows[1:], rows.column("n"), rows.column("shared"), strict=True):
            at = self.asked[lo:hi]
            self.n[at] = _unpack(n.as_py(), hi - lo)
            self.shared[at] = np.unpackbits(np.frombuffer(shared.as_py(), np.uint8), count=hi - lo)

    def forget(self) -> None:
        """Only counts are needed any more."""
        del self.own, self.shared, self.asked, self.runs, self.rows, self.heads, self.contexts, self.bucket

    def different(self, rows: pa.Table, hot, hot_t) -> np.ndarray:
        """For every n-gram, how many different words follow its context."""
        out = np.bincount(self.of[self.own > 0], minlength=int(self.of[-1]) + 1)    # of a context of this block alone
        at = _place(hot, self.contexts)
        contexts = self.of[self.asked[self.runs[:-1]]]
        for lo, hi, t in zip(self.heads[:-1], self.heads[1:], rows.column("t"), strict=True):
            out[contexts[lo:hi]] = _unpack(t.as_py(), hi - lo)
        out[contexts[at >= 0]] = hot_t[at[at >= 0]]
        return out[self.of]


def _bucket(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return (((hashes >> np.uint64(40)) * np.uint64(n_buckets)) >> np.uint64(24)).astype(np.int64)


def _rows(answers: pa.Table, length: int) -> pa.Table:
    """The answers about n-grams of one length in the order asked."""
    rows = answers.filter(pa.array(answers.column("length").to_numpy() == length))
    return rows.take(pa.array(np.argsort(rows.column("row").to_numpy())))


def _lengths(texts: _Texts, answers: pa.Table, upto: int, answered: int, hot, n_buckets: int, hot_t=None) -> list[_Grams]:
    """The n-grams of 1 to ``upto`` words, of which ``answers`` has those of
    up to ``answered``; with ``hot_t`` (different words after hot contexts)
    also how many different words follow each context."""
    context, shared = np.zeros(len(texts.tokens), np.int64), np.ones(len(texts.tokens), bool)
    out: list[_Grams] = []
    for k, hashes in zip(range(upto), _contexts(texts.tokens, texts.at)):
        grams = _Grams(texts, context, hashes, shared, hot, n_buckets)
        if k < answered:
            rows = _rows(answers, k + 1)
            grams.answer(rows)
            # the context of the next length is the n-gram before; the ends before a text are one more
            context[1:] = grams.place[:-1]
            context += 1
            shared[1:] = grams.shared[grams.place[:-1]]
            context[texts.at[:-1]], shared[texts.at[:-1]] = 0, True
            if hot_t is not None:
                grams.t = grams.different(rows, hot, hot_t)
            grams.forget()
        out.append(grams)
    return out


def _ask(k: int, hot, n_buckets: int):
    """Per bucket, the n-grams of ``k`` words that the block asks for, context
    by context, with how often its training texts have them."""

    def rows_of(texts: _Texts, answers: pa.Table) -> pa.Table:
        grams = _lengths(texts, answers, k, k - 1, hot.value, n_buckets)[-1]
        words = texts.tokens[grams.index[grams.asked]] >> np.uint64(24 if k > 1 else 0)
        own, size, contexts = grams.own[grams.asked], np.diff(grams.runs), grams.contexts >> np.uint64(8)
        spans, heads = list(zip(grams.rows, grams.rows[1:])), list(zip(grams.heads, grams.heads[1:]))
        return pa.table({
            "block": pa.array([texts.block] * len(spans), pa.int64()), "row": pa.array(np.arange(len(spans))),
            "bucket": pa.array(grams.bucket),
            "contexts": pa.array([_planes(np.diff(contexts[lo:hi], prepend=np.uint64(0))) for lo, hi in heads], pa.binary()),
            "runs": pa.array([_pack(size[lo:hi]) for lo, hi in heads], pa.binary()),
            "words": pa.array([_planes(words[lo:hi]) for lo, hi in spans], pa.binary()),
            "counts": pa.array([_pack(own[lo:hi]) for lo, hi in spans], pa.binary())})

    def alone(texts: pa.Table) -> pa.Table:
        return rows_of(_Texts(texts), pa.table({"length": pa.array([], pa.int32())}))

    def answered(texts: pa.Table, answers: pa.Table) -> pa.Table:
        return rows_of(_Texts(texts), answers)

    return alone if k == 1 else answered


def _answer(hot):
    """One bucket of the hash space: per block, in the order asked, the corpus
    count of every n-gram, whether several blocks have it, and the number of
    different words of every context; on one row also what the bucket has of
    hot contexts."""

    def run(table: pa.Table) -> pa.Table:
        deltas = [_from_planes(x) for x in table.column("contexts").to_pylist()]
        contexts = np.concatenate([np.cumsum(x, dtype=np.uint64) for x in deltas])
        size = [_unpack(x, len(c)) for x, c in zip(table.column("runs").to_pylist(), deltas)]
        words = [_from_planes(x) for x in table.column("words").to_pylist()]
        counts = np.concatenate([_unpack(x, len(w)) for x, w in zip(table.column("counts").to_pylist(), words)])
        cuts, heads = np.cumsum([len(x) for x in words])[:-1], np.cumsum([len(x) for x in deltas])[:-1]
        known, group = np.unique(contexts, return_inverse=True)
        of = np.repeat(group, np.concatenate(size))
        _, index, place, blocks = np.unique(mix(known[of] * MULT + np.concatenate(words)), return_index=True,
                                            return_inverse=True, return_counts=True)
        total = np.bincount(place, counts, len(index)).astype(np.int64)
        of = of[index]
        all_ = np.bincount(of, total, len(known)).astype(np.int64)
        kinds = np.bincount(of[total > 0], minlength=len(known))
        some = np.flatnonzero((_place(hot.value >> np.uint64(8), known) >= 0) & (all_ > 0))
        sums = [[]] * table.num_rows
        sums[0] = [{"context": int(known[i]), "c": int(all_[i]), "t": int(kinds[i])} for i in some]
        return pa.table({
            "block": table.column("block"), "row": table.column("row"),
            "n": pa.array([_pack(x) for x in np.split(total[place], cuts)], pa.binary()),
            "shared": pa.array([np.packbits(x).tobytes() for x in np.split(blocks[place] > 1, cuts)], pa.binary()),
            "t": pa.array([_pack(x) for x in np.split(kinds[group], heads)], pa.binary()),
            "hot": pa.array(sums, pa.list_(pa.struct([("context", pa.int64()), ("c", pa.int64()), ("t", pa.int64())])))})

    return run


def _block_automaton(texts: _Texts, lengths: list[_Grams], everything: int, vocabulary: int) -> SortedAutomaton:
    """The states and arcs that the texts of one block can reach.  The states
    of one length are numbered as the contexts of its n-grams are."""
    is_first = np.zeros(len(texts.tokens), bool)
    is_first[texts.at[:-1]] = True
    ends = lengths[0].n[lengths[0].place[texts.at[1] - 1]]        # of the training texts
    base = np.concatenate(([0], np.cumsum([int(grams.of[-1]) + 1 for grams in lengths])))
    fail, backoff = np.zeros(base[-1], np.int32), np.zeros(base[-1])
    bits = max(1, int(len(texts.words) - 1).bit_length())
    # the root reads every word
    arcs = [np.arange(len(grams.n)) if k == 0 else np.flatnonzero(grams.n) for k, grams in enumerate(lengths)]
    size = np.concatenate(([0], np.cumsum([len(x) for x in arcs])))
    key, target, weight = np.empty(size[-1], np.int64), np.zeros(size[-1], np.int32), np.empty(size[-1])
    p = None
    for k, (grams, arc) in enumerate(zip(lengths, arcs)):
        n, t, at = grams.n, grams.t, grams.index
        if k == 0:
            p = (n + vocabulary / (vocabulary + 1)) / (everything + vocabulary) if everything else np.ones(len(n))
        else:
            below = lengths[k - 1]
            lower = below.place[at]
            c = np.where(is_first[at], ends, below.n[below.place[at - 1]])       # how often the context occurs
            p = np.where(c > 0, (n + t * p[lower]) / np.maximum(c + t, 1), p[lower])
            one = _cuts(grams.of)[:-1]                            # an n-gram of each context
            state = base[k] + grams.of[one]
            fail[state] = base[k - 1] + below.of[lower[one]]
            seen = one[c[one] > 0]
            backoff[state[c[one] > 0]] = np.log10(t[seen] / (c[seen] + t[seen]))
        place = slice(size[k], size[k + 1])
        last = at[arc]
        key[place] = ((base[k] + grams.of[arc]) << bits) | texts.symbols[last]
        weight[place] = np.log10(p[arc])
        goes = np.flatnonzero((n[arc] > 0) & (texts.tokens[last] != END_TOKEN))
        longer = min(k + 1, WORDS - 1)
        after = lengths[longer]
        target[size[k] + goes] = base[longer] + after.of[after.place[last[goes] + 1]]
    begin = int(base[WORDS - 1] + lengths[-1].of[lengths[-1].place[0]]) if ends else 0
    return SortedAutomaton(key, target, weight, fail, backoff, begin, bits, WORDS)


def _finish(totals, n_buckets: int):
    """One block: its automaton, and the sums over each text's tokens."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        hot, hot_c, hot_t = totals.value
        everything, vocabulary = int(hot_c[0]), int(hot_t[0])       # of the empty context, whose hash is the least
        texts = _Texts(texts)
        lengths = _lengths(texts, answers, WORDS, WORDS, hot, n_buckets, hot_t)
        model = _block_automaton(texts, lengths, everything, vocabulary)
        count = lengths[0].n[lengths[0].place]
        m, length = len(texts.at) - 1, np.diff(texts.at)
        text = np.repeat(np.arange(m), length)
        return pa.table({
            "doc_id": texts.doc_id, "held_out": texts.held_out, "n_tokens": pa.array(length),
            "n_known": pa.array(np.bincount(text[count > 0], minlength=m)),
            "log_counts": pa.array(np.bincount(text, np.log10(count + 1.0), m)),
            "score": pa.array(model.score(texts.symbols, texts.at))})

    return run


def _hot_contexts(training: DataFrame, size: int, n_buckets: int) -> np.ndarray:
    """Sorted hashes of the empty context and of those that have about a
    bucket's share of a sample's tokens.  They only say how the work is
    spread; no result depends on them."""
    part = min(1.0, max(64 << 20, n_buckets << 13) / max(size, 1))
    share = 1 / max(1000, n_buckets)
    rows = (_count(training.sample(part, 1), lambda tokens, at: np.concatenate(list(_contexts(tokens, at))[1:]), share / (WORDS - 1))
            .where(F.col("n") >= share * part * size / 16).select("key").collect())
    return np.unique(np.array([0, *[r.key for r in rows]], np.int64).view(np.uint64))


def lm_scores(documents: DataFrame, held_out, bucket_bytes: int = 8 << 20, block_bytes: int = 8 << 20) -> DataFrame:
    """One row per row of ``documents`` (``doc_id``, ``text``): ``doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``held_out`` is a boolean column over ``documents``; null counts as
    false.  The model learns from the other rows.  ``base_score`` is the
    add-one unigram log10 probability of the text's tokens (words after
    lowering A-Z, then one end), ``score`` that of the backoff model with
    all n-grams of up to ``WORDS`` tokens; in both, all words that the
    training rows lack are one unknown word.  Words are counted by 64-bit
    hashes, longer n-grams by 56 bits of their context's and 40 of the last
    word's.  ``block_bytes`` of text are scored together; no result depends on
    the sizes.

    Null and blank texts have one token, the end.  Repeated rows count as
    often as they occur.  Without training rows every token is the unknown
    word, at probability one.  Very long texts form a block of their own.  An
    empty table gives no rows.  Other columns are ignored.  The rows are read
    from two tables below the session's shared folder."""
    spark = documents.sparkSession
    rows = with_id(documents, "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, size // bucket_bytes)
    keys = _hot_contexts(rows.where("not held_out"), size, n_buckets)
    hot = spark.sparkContext.broadcast(keys)
    texts, _ = cut(rows.mapInArrow(_blocks(block_bytes), (
        "block bigint, doc_id array<bigint>, held_out array<boolean>, lengths array<bigint>, words binary, symbols binary")), "texts")
    question = "block bigint, row bigint, bucket bigint, contexts binary, runs binary, words binary, counts binary"
    answer = ("block bigint, row bigint, n binary, shared binary, t binary, "
              "hot array<struct<context: bigint, c: bigint, t: bigint>>")
    answers, sums = None, {}
    for k in range(1, WORDS + 1):
        by_block = texts.groupBy("block")
        if answers is None:
            asked = by_block.applyInArrow(_ask(k, hot, n_buckets), question)
        else:
            asked = (by_block.cogroup(answers.select("block", "length", "row", "n", "shared").groupBy("block"))
                     .applyInArrow(_ask(k, hot, n_buckets), question))
        got, _ = cut(asked.groupBy("bucket").applyInArrow(_answer(hot), answer).withColumn("length", F.lit(k)), "answers")
        for r in got.select(F.inline("hot")).groupBy("context").agg(F.sum("c").alias("c"), F.sum("t").alias("t")).collect():
            sums[r.context] = (r.c, r.t)
        got = got.drop("hot")
        answers = got if answers is None else answers.unionByName(got)
    c, t = np.array([sums.get(int(x >> np.uint64(8)), (0, 0)) for x in keys], np.int64).T
    totals = spark.sparkContext.broadcast((keys, c, t))
    n, v = int(c[0]), int(t[0])                 # of the empty context, whose hash is the least
    return (texts.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(_finish(totals, n_buckets),
                          "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, log_counts double, score double")
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"),
                    (F.col("log_counts") - F.col("n_tokens") * float(np.log10(n + v + 1))).alias("base_score"), "score"))
