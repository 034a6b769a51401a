"""Weighted backoff automaton over n-grams of words or word classes.

Smoothed n-grams are the arcs: a state is a context of up to ``order - 1``
symbols, an arc carries the log-probability of the next symbol, and a failure
arc leads to the state of the shorter context at the cost of the backoff
weight.  Symbols are the words of a block of texts (``SortedAutomaton``) or
word classes: a frequent word of its own, ``RARE`` for all other words, or
``END`` for the end of a text.
"""

from __future__ import annotations

import numpy as np

ORDER = 3
BITS = 10            # of a symbol; ORDER * BITS stays below 64
SYMBOLS = 1 << BITS
RARE, END = 0, 1     # END also stands before the first word of a text
EMPTY = np.int64(-1)


def grams(stream: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The packed ``ORDER``-symbol gram that ends at each symbol of the
    stream; before the first symbol of a text stands ``END``."""
    out = np.zeros(len(stream), np.int64)
    place = np.arange(len(stream)) - np.repeat(offsets[:-1], np.diff(offsets))
    for back in range(ORDER - 1, -1, -1):
        symbol = np.full(len(stream), END, np.int64)
        if back < len(stream):
            symbol[back:] = stream[:len(stream) - back]
        symbol[place < back] = END
        out = (out << BITS) | symbol
    return out


class Automaton:
    """Arcs in an open-addressing table (key: state and symbol)."""

    bits, order = BITS, ORDER

    def __init__(self, key, target, weight, fail, backoff, start):
        self.key, self.target, self.weight = key, target, weight
        self.fail, self.backoff, self.start = fail, backoff, start
        self.shift = np.uint64(64 - int(np.log2(len(key))))

    def parts(self) -> dict:
        """Plain arrays to send to tasks; ``Automaton(**parts)`` restores it."""
        return {name: getattr(self, name) for name in ("key", "target", "weight", "fail", "backoff", "start")}

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1."""
        slot = self.slots(keys)
        held = self.key[slot]
        open_ = np.flatnonzero((held != keys) & (held != EMPTY))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.key) - 1)
            held[open_] = self.key[slot[open_]]
            open_ = open_[(held[open_] != keys[open_]) & (held[open_] != EMPTY)]
        slot[held == EMPTY] = -1
        return slot

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and the log10 weight of reading ``symbol``: follow the
        arc, or failure arcs until a state has one (the root has them all)."""
        slot = self.find((state.astype(np.int64) << self.bits) | symbol)
        weight = np.zeros(len(state))
        lost = np.flatnonzero(slot < 0)
        if len(lost):
            at = state[lost].copy()
            while len(lost):
                weight[lost] += self.backoff[at]
                at = self.fail[at]
                got = self.find((at.astype(np.int64) << self.bits) | symbol[lost])
                slot[lost] = got
                lost, at = lost[got < 0], at[got < 0]
        return self.target[slot], weight + self.weight[slot]

    def score(self, stream: np.ndarray, offsets: np.ndarray, segment: int = 64) -> np.ndarray:
        """log10 probability of each text of the stream.

        One left-to-right pass.  Long texts are cut into segments so that
        many are read in step; a segment first reads the symbols before it
        without counting them, which leaves it in the state that one pass
        over the whole text has there, as no state is longer."""
        size = np.diff(offsets)
        pieces = -(-size // segment)
        text = np.repeat(np.arange(len(size)), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = offsets[text] + number * segment
        length = np.minimum(segment, offsets[text + 1] - begin)
        order = np.argsort(-length, kind="stable")
        text, number, begin, length = text[order], number[order], begin[order], length[order]
        state = np.where(number == 0, self.start, 0)
        later = np.flatnonzero(number > 0)
        for back in range(self.order - 1, 0, -1):
            state[later], _ = self.step(state[later], stream[begin[later] - back])
        total = np.zeros(len(text))
        for t in range(int(length.max(initial=0))):
            active = int(np.searchsorted(-length, -t, side="left"))
            state[:active], weight = self.step(state[:active], stream[begin[:active] + t])
            total[:active] += weight
        return np.bincount(text, total, len(size))


class SortedAutomaton(Automaton):
    """Arcs in arrays sorted by key, for symbols of any number of bits: quicker
    to make than the table, for an automaton that is used once."""

    def __init__(self, key, target, weight, fail, backoff, start, bits: int, order: int):
        self.key, self.target, self.weight = key, target, weight
        self.fail, self.backoff, self.start, self.bits, self.order = fail, backoff, start, bits, order
        self.first = np.concatenate(([0], np.cumsum(np.bincount(key >> bits, minlength=len(fail)))))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Most states have one arc: the first is looked at before the search."""
        state = keys >> self.bits
        at = self.first[state]
        slot = np.where(self.key[np.minimum(at, len(self.key) - 1)] == keys, at, -1)
        more = np.flatnonzero((slot < 0) & (self.first[state + 1] > at + 1))
        among = np.minimum(np.searchsorted(self.key, keys[more]), len(self.key) - 1)
        slot[more] = np.where(self.key[among] == keys[more], among, -1)
        return slot


def compile_automaton(orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Automaton:
    """The automaton of counted n-grams.

    ``orders[k - 1]`` holds the kept grams of ``k`` symbols, sorted: packed
    gram, its count, the count of its context, and the number of different
    symbols seen after the context (all counts over the whole corpus, also
    where other grams are not kept).  Witten-Bell smoothing interpolates
    each order with the next lower one, down to the uniform distribution;
    a backoff weight hands the mass of all symbols without an arc to the
    shorter context, so every state sums to one."""
    symbols = np.arange(SYMBOLS, dtype=np.int64)
    gram, n, c, t = (np.asarray(x, np.int64) for x in orders[0])
    total, kinds = (int(c[0]), int(t[0])) if len(gram) else (0, 1)
    count = np.zeros(SYMBOLS)
    count[gram] = n
    probability = [(count + kinds / SYMBOLS) / (total + kinds)]
    keys = [symbols]
    for gram, n, c, t in orders[1:]:
        gram, n, c, t = (np.asarray(x, np.int64) for x in (gram, n, c, t))
        lower = np.searchsorted(keys[-1], gram & ((1 << BITS * len(keys)) - 1))
        probability.append((n + t * probability[-1][lower]) / (c + t))
        keys.append(gram)
    contexts = [np.unique(k >> BITS) if i else np.zeros(1, np.int64) for i, k in enumerate(keys)]
    base = np.concatenate(([0], np.cumsum([len(x) for x in contexts])))

    def longest(key: np.ndarray, most: int) -> np.ndarray:
        """The state of the longest suffix (up to ``most`` symbols) that is one."""
        state = np.zeros(len(key), np.int64)
        for size in range(1, most + 1):
            if len(contexts[size]):
                suffix = key & ((1 << BITS * size) - 1)
                at = np.minimum(np.searchsorted(contexts[size], suffix), len(contexts[size]) - 1)
                state = np.where(contexts[size][at] == suffix, base[size] + at, state)
        return state

    n_states = int(base[-1])
    fail, backoff = np.zeros(n_states, np.int64), np.zeros(n_states)
    arc_key, arc_target, arc_weight = [], [], []
    for i, key in enumerate(keys):
        state = base[i] + (np.searchsorted(contexts[i], key >> BITS) if i else np.zeros(len(key), np.int64))
        arc_key.append((state << BITS) | (key & (SYMBOLS - 1)))
        arc_target.append(longest(key, min(i + 1, ORDER - 1, len(keys) - 1)))
        arc_weight.append(np.log10(probability[i]))
        if i and len(key):
            own = np.bincount(state - base[i], probability[i], len(contexts[i]))
            lower = np.searchsorted(keys[i - 1], key & ((1 << BITS * i) - 1))
            below = np.bincount(state - base[i], probability[i - 1][lower], len(contexts[i]))
            backoff[base[i]:base[i + 1]] = np.log10(np.maximum(1 - own, 1e-12) / np.maximum(1 - below, 1e-12))
            fail[base[i]:base[i + 1]] = longest(contexts[i], i - 1)
    arc_key, arc_target, arc_weight = (np.concatenate(x) for x in (arc_key, arc_target, arc_weight))
    size = 1 << max(10, int(np.ceil(np.log2(2 * len(arc_key)))))
    start = int(longest(np.array([sum(END << BITS * i for i in range(ORDER - 1))]), min(ORDER - 1, len(keys) - 1))[0])
    made = Automaton(np.full(size, EMPTY), np.zeros(size, np.int32), np.zeros(size, np.float32), fail, backoff, start)
    slot, left = made.slots(arc_key), np.arange(len(arc_key))
    while len(left):                 # every free slot takes the first arc that asks for it
        _, winner = np.unique(slot[left], return_index=True)
        takes = left[winner]
        takes = takes[made.key[slot[takes]] == EMPTY]
        made.key[slot[takes]], made.target[slot[takes]], made.weight[slot[takes]] = arc_key[takes], arc_target[takes], arc_weight[takes]
        left = left[made.key[slot[left]] != arc_key[left]]
        slot[left] = (slot[left] + 1) & (size - 1)
    return made
