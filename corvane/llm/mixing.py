"""Language-model scores by logistic context mixing.

A text is its words in A-Z lower case, then one end symbol. Each word is first known or new, with the share of words met
once as the chance of a new one. A known word's BITS hash bits are then predicted one by one from hashed contexts that
reach across words: none, the word before, the two words before, and the most common one of the REACH words before,
which tells the language (the first two for the first bits only, later ones hardly ever return); within the words that
share all these bits it has its share of the counts. A new word is spelled: every bit of every byte is predicted from hashed contexts inside the
word, its position, the last one to four bytes, and the whole word so far, the longer ones together with the common word
before it if that is one of the first GROUPS. Each context holds counts of zeros and ones;
their log odds are mixed by a logistic mixer whose weights are chosen by a gate (how often the long contexts were seen)
and learned online; an adaptive map of (bit, mixed odds) refines the result, and log2 of it sums to the total bits.

All training texts fill the tables: words are counted in one shuffle, every token adds to the contexts across words,
every distinct word, with each common word it was met behind, to those inside words. Tables have a fixed size and are sums, so neither the number of tasks nor the
order of rows changes them; what is gathered on the way grows with the corpus. The common words are those of all training
texts. The mixers learn from every token, and from every distinct word with each common word it was met behind, each
taken out of the counts first: rows are dealt by hash to as many slices as their number asks for, each slice is learned
online in an order fixed by hash, and the slices' mixers are joined, weights by how much each gate has learned, maps as
sums; then they stay. A row's own bit leaves only two ways for the counts of a slot, so the odds of both are taken once for
the whole table and a step looks them up. At most HEAD frequent words travel to the workers with
their counts, the rows of all others are joined with the counted words; the head only decides where a word is looked up.

Null texts are empty: one end token. With no training text the counts are zero and every word is new. Rows of one doc_id
are summed, so keys should be unique; rows without a doc_id and extra columns are left behind; words are compared as
bytes, ties do not arise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, freed, over_batches, stored, texts

#: Words that travel to the workers at most.
HEAD = 1 << 19
#: Slots of each predictor inside words: position, last 1, 2, 3, 4 bytes, word so far.
SLOTS = (1 << 12, 1 << 16, 1 << 18, 1 << 20, 1 << 20, 1 << 21)
K = len(SLOTS)
STARTS = np.cumsum((0, *SLOTS))
GATES = 12 * 4
BUCKETS = 33
#: Hash bits of a known word that are predicted, and slots of each predictor across words: none, one, two words before,
#: the most common one of the REACH before, if it is among the COMMON most frequent words.
BITS = 13
ACROSS = (1 << BITS, 1 << 20, 1 << 21, 1 << 20)
#: Bits that each of them takes part in.
DEPTHS = (BITS, 9, 7, BITS)
REACH, COMMON, GROUPS = 32, 1024, 16
ACROSS_STARTS = np.cumsum((0, *ACROSS))
ACROSS_GATES = 16
#: Tokens and distinct words that one mixer learns from in a row, about; there are as many mixers as the corpus asks for.
SLICE_TOKENS, SLICE_WORDS = 1 << 21, 1 << 17
#: Tokens and bytes of a mixer's first steps; later ones grow to WIDEN times that.
STEP_TOKENS, STEP_BYTES, WIDEN = 1024, 4096, 4
#: Distinct words that one task adds to the tables, about.
TASK_WORDS = 1 << 18
LOG10 = float(np.log(10))
END = b"\n"
_ODD = tuple(np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
#: Products of the first and the second with the third.
_TWICE, _KNOWN = (np.uint64(int(x) * int(_ODD[2]) & 0xFFFFFFFFFFFFFFFF) for x in _ODD[:2])
_TURNS = sorted({0, *DEPTHS})


# mixing


@dataclass
class Mixer:
    weights: np.ndarray  # gate, predictor
    refined: np.ndarray  # bit, bucket: (zeros, ones)
    mass: np.ndarray  # gate: bits learned from

    @staticmethod
    def fresh(gates: int = GATES, predictors: int = K, bits: int = 8) -> Mixer:
        centre = 1 / (1 + np.exp(-np.linspace(-8, 8, BUCKETS)))
        return Mixer(np.full((gates, predictors), 1.8 / predictors), np.tile(np.stack([1 - centre, centre], 1)[None] * 20, (bits, 1, 1)), np.zeros(gates))

    def packed(self, fresh: Mixer) -> np.ndarray:
        """What it has learned as whole numbers, which add up in any order."""
        return np.rint(np.concatenate([(self.weights * self.mass[:, None] * 65536).ravel(), (self.refined - fresh.refined).ravel(), self.mass])).astype(np.int64)

    def unpacked(self, total: np.ndarray) -> Mixer:
        """This fresh mixer with the sum of what others have learned."""
        a, b = self.weights.size, self.weights.size + self.refined.size
        mass = total[b:].astype(float)
        weights = np.where(mass[:, None] > 0, total[:a].reshape(self.weights.shape) / 65536 / np.maximum(mass, 1)[:, None], self.weights)
        return Mixer(weights, self.refined + total[a:b].reshape(self.refined.shape), mass)


def mixed(mixer: Mixer, s: Sequence[np.ndarray | None], gate: np.ndarray) -> np.ndarray:
    """s: log odds by predictor, None for one that takes no part."""
    x = np.zeros(gate.shape, np.float32)
    for weights, odds_of in zip(np.ascontiguousarray(mixer.weights.T, np.float32), s, strict=True):
        if odds_of is not None:
            part = weights.take(gate)
            part *= odds_of
            x += part
    return np.clip(x, -8, 8, out=x)


def refine(mixer: Mixer, bit: int, x: np.ndarray) -> np.ndarray:
    """Probability of a one: mean of the mixed one and its interpolated entry in the adaptive map."""
    p = 1 / (1 + np.exp(-x))
    place = (x + 8) * (BUCKETS - 1) / 16
    low = np.minimum(place.astype(np.int64), BUCKETS - 2)
    high = place - low
    share = mixer.refined[bit, :, 1] / mixer.refined[bit].sum(1)
    return np.clip((p + share[low] * (1 - high) + share[low + 1] * high) / 2, 1e-6, 1 - 1e-6)


def correct(mixer: Mixer, bit: int | np.ndarray, s: Sequence[np.ndarray | None], gate: np.ndarray, one: np.ndarray) -> None:
    """One step of the weights and of the adaptive map by the bits just coded. bit: of all, or one that spreads to each."""
    gates = len(mixer.weights)
    x = mixed(mixer, s, gate)
    error = np.exp(-x)
    error += 1
    np.reciprocal(error, out=error)
    np.subtract(one, error, out=error)
    flat = gate.ravel()
    mass = np.bincount(flat, minlength=gates)
    mixer.mass += mass
    for k in range(len(s)):
        if s[k] is not None:
            part = error * s[k]
            mean = np.bincount(flat, part.ravel(), gates) / (mass + 20)
            np.multiply(s[k], s[k], out=part)
            mixer.weights[:, k] += 0.15 * mean / (1 + np.bincount(flat, part.ravel(), gates) / (mass + 20)) ** 0.5
    x += 8
    x *= (BUCKETS - 1) / 16
    place = np.rint(x, out=x).astype(np.int64)
    place += bit * BUCKETS
    place += place
    place += one
    mixer.refined += np.bincount(place.ravel(), minlength=mixer.refined.size).reshape(mixer.refined.shape)


def log_odds(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + np.float32(0.25)) / (n0 + np.float32(0.25)))


def left(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of all slots without one zero, then without one `one`; and how often each was seen besides."""
    n0, n1 = table[0::2], table[1::2]
    size, less = len(n0), np.float32(1)
    out = np.empty(2 * size, np.float32)
    out[:size] = log_odds(np.maximum(n0 - less, 0), n1)
    out[size:] = log_odds(n0, np.maximum(n1 - less, 0))
    return out, np.maximum(n0 + n1 - less, 0)


class Learner:
    """A mixer that learns step by step from columns of symbols, whatever the batches that bring them.

    tables: log odds without the symbol itself, and gates, which the step looks up.
    """

    def __init__(self, mixer: Mixer, tables: tuple[np.ndarray, ...], step: Callable[[Mixer, tuple[np.ndarray, ...], list[np.ndarray]], None], width: int) -> None:
        self.mixer, self.tables, self.step, self.width, self.seen, self.held = mixer, tables, step, width, 0, []

    def again(self) -> Learner:
        """Another one that starts where this one stands."""
        m = self.mixer
        return Learner(Mixer(m.weights.copy(), m.refined.copy(), m.mass.copy()), self.tables, self.step, self.width)

    def add(self, columns: list[np.ndarray]) -> None:
        if self.held:
            columns = [np.concatenate(pair) for pair in zip(self.held, columns, strict=True)]
        a = 0
        while len(columns[0]) - a >= (width := min(max(self.seen // 256, self.width), WIDEN * self.width)):
            self.step(self.mixer, self.tables, [c[a : a + width] for c in columns])
            self.seen += width
            a += width
        self.held = [c[a:] for c in columns]

    def close(self) -> Mixer:
        if self.held and len(self.held[0]):
            self.step(self.mixer, self.tables, self.held)
        self.held = []
        return self.mixer


# inside words


@dataclass(frozen=True)
class Flat:
    """Bytes of many words, one after another, and the hash of each predictor's context of each byte, as `slots` adds to it."""

    data: np.ndarray
    word: np.ndarray
    position: np.ndarray
    contexts: list[np.ndarray]


def flatten(words: list[bytes], groups: np.ndarray) -> Flat:
    """Each word is closed by a space; the end symbol stands alone. Contexts from the third on hold the word's group."""
    coded = [w if w == END else w + b" " for w in words]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    data = np.frombuffer(b"".join(coded), np.uint8)
    word = np.repeat(np.arange(len(coded)), sizes)
    starts = np.cumsum(sizes) - sizes
    position = np.arange(len(data)) - starts[word]
    wide, contexts, recent = data.astype(np.uint64), [np.minimum(position, 15).astype(np.uint64)], np.zeros(len(data), np.uint64)
    for back in range(1, 5):
        before = np.full(len(data), 32, np.uint64)
        before[back:] = np.where(position[back:] >= back, wide[:-back], np.uint64(32))
        recent = recent << np.uint64(8) | before
        contexts.append(recent.copy())
    powers = np.multiply.accumulate(np.full(int(sizes.max(initial=1)), np.uint64(0x9E3779B97F4A7C15)))
    terms = (wide + np.uint64(1)) * powers[position]
    total = np.cumsum(terms, dtype=np.uint64) - terms
    contexts.append(total - total[starts[word]])
    salt = (groups.astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))[word]
    contexts = [c << np.uint64(8) if k < 2 else (c if k < 3 else c ^ salt) * _TWICE for k, c in enumerate(contexts)]
    return Flat(data, word, position, contexts)


def slots(flat: Flat, k: int, bit: int, rows: slice, known: np.ndarray | None = None) -> np.ndarray:
    """Slot of predictor k for the given bit (0 is the highest) of each byte. known: `_known` of them, if at hand."""
    if known is None:
        known = _known(flat, bit, rows)
    if k < 2:
        return (flat.contexts[k][rows] | known).view(np.int64)
    at = known * _KNOWN
    at += flat.contexts[k][rows]
    at >>= np.uint64(65 - SLOTS[k].bit_length())
    return at.view(np.int64)


def _known(flat: Flat, bit: int, rows: slice) -> np.ndarray:
    """The bits of each byte before the given one, behind a leading one."""
    known = flat.data[rows].astype(np.uint64)
    known |= np.uint64(256)
    known >>= np.uint64(8 - bit)
    return known


def count_tables(words: list[bytes], groups: np.ndarray, tables: np.ndarray) -> None:
    """Add each word once to (zeros, ones) of every context it passes."""
    flat, everything = flatten(words, groups), slice(None)
    for bit in range(8):
        one, known = (flat.data >> (7 - bit) & 1).astype(np.int64), _known(flat, bit, everything)
        for k in range(K):
            at = slots(flat, k, bit, everything, known)
            at += at
            at += one
            np.add.at(tables[2 * STARTS[k] :], at, tables.dtype.type(1))


def spelling_gates(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the last predictor's slots, and those of the one before, add to the gate."""
    deep = np.minimum(np.log2(seen[STARTS[5] : STARTS[6]] + 1).astype(np.int8), 11) * np.int8(4)
    return deep, np.minimum((np.log2(seen[STARTS[4] : STARTS[5]] + 1) / 3).astype(np.int8), 3)


def looked_up(odds: np.ndarray, deep: np.ndarray, near: np.ndarray, flat: Flat, bit: int, rows: slice, beside: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Log odds of a one by each predictor, and the gate. beside: what is added to each slot's number."""
    known, out = _known(flat, bit, rows), []
    for k in range(K):
        at = slots(flat, k, bit, rows, known)
        if k == 4:
            gate = near.take(at).astype(np.int64)
        elif k == 5:
            gate += deep.take(at)
        if beside is not None:
            at += beside
        out.append(odds[STARTS[k] :].take(at))
    return out, gate


def odds(tables: np.ndarray, flat: Flat, bit: int, rows: slice) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of a one by each predictor, and the gate, from counts."""
    n0, n1 = tables[0::2], tables[1::2]
    s, gate = looked_up(log_odds(n0, n1), *spelling_gates(n0 + n1), flat, bit, rows)
    return np.stack(s), gate


def _spelling_step(mixer: Mixer, tables: tuple[np.ndarray, ...], columns: list[np.ndarray]) -> None:
    flat, half = Flat(columns[0], columns[0], columns[0], columns[1:]), len(tables[0]) // 2
    for bit in range(8):
        one = (flat.data >> (7 - bit) & 1).astype(np.int64)
        correct(mixer, bit, *looked_up(*tables, flat, bit, slice(None), one * half), one)


def spelling_learner(tables: np.ndarray) -> Learner:
    """It learns from columns of `spelled`."""
    without, seen = left(tables)
    return Learner(Mixer.fresh(), (without, *spelling_gates(seen)), _spelling_step, STEP_BYTES)


def spelled(words: list[bytes], groups: np.ndarray) -> list[np.ndarray]:
    flat = flatten(words, groups)
    return [flat.data, *flat.contexts]


@dataclass(frozen=True)
class Model:
    tables: np.ndarray
    mixer: Mixer

    @cached_property
    def looks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds and gates of all slots."""
        n0, n1 = self.tables[0::2], self.tables[1::2]
        return log_odds(n0, n1), *spelling_gates(n0 + n1)

    def spell(self, words: list[bytes], groups: np.ndarray, chunk: int = 1 << 14) -> np.ndarray:
        """Log probability of each word with its closing space (or of END alone)."""
        if not words:
            return np.zeros(0)
        flat = flatten(words, groups)
        out = np.zeros(len(flat.data))
        for a in range(0, len(flat.data), chunk):
            rows = slice(a, a + chunk)
            for bit in range(8):
                s, gate = looked_up(*self.looks, flat, bit, rows)
                p = refine(self.mixer, bit, mixed(self.mixer, s, gate).astype(float))
                out[rows] += np.log(np.where(flat.data[rows] >> (7 - bit) & 1, p, 1 - p))
        return np.bincount(flat.word, out, len(words))


# across words


@dataclass(frozen=True)
class Tokens:
    """Tokens of a batch, the end of each text among them: distinct words, the word of each token, its text, hashes of
    the words and of the contexts."""

    distinct: pa.Array
    ids: np.ndarray  # the end has the number after the last word's
    owner: np.ndarray
    hashes: np.ndarray
    before: tuple[np.ndarray, ...]  # of one and two words before each token, and of the most common one before it
    group: np.ndarray  # rank of the most common one, at most GROUPS


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of a batch, the word of each token, and the text of each token."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column).cast(pa.large_string()))
    flat = lists.flatten()
    full = pc.not_equal(pc.binary_length(flat), 0)
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))[full.to_numpy(zero_copy_only=False)]
    coded = flat.filter(full).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), owner


def hashed(words: list) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def tokens_of(column: pa.Array, common: pa.Array, contexts: bool = True) -> Tokens:
    """common: the most frequent words, in order. Without contexts the hashes are left out."""
    distinct, ids, owner = split_words(column)
    n, size = len(column), len(ids)
    sizes = np.bincount(owner, minlength=n) + 1
    begin, who = np.cumsum(sizes) - sizes, np.repeat(np.arange(n), sizes)
    every = np.full(size + n, len(distinct), np.int64)
    owner += np.arange(size)
    every[owner] = ids
    # how far each token is from its text's beginning, REACH at most
    deep = np.full(len(every), REACH, np.int16)
    for k in range(REACH - 1, -1, -1):
        deep[begin[sizes > k] + k] = k
    rank = np.append(pc.fill_null(pc.index_in(distinct, value_set=common), COMMON).to_numpy(zero_copy_only=False), COMMON).astype(np.int16)[every]
    least = np.full(len(every), COMMON, np.int16)
    least[1:] = rank[:-1]
    least[begin] = COMMON
    reach = 1
    while reach < REACH:  # the least of twice as many each time
        near = np.where(deep[reach:] >= reach, least[:-reach], np.int16(COMMON))
        np.minimum(least[reach:], near, out=least[reach:])
        reach *= 2
    group, hashes, before = np.minimum(least, GROUPS).astype(np.int64), np.zeros(0, np.uint64), ()
    if contexts:
        hashes = np.append(hashed(distinct.to_pylist()), hashed([END]))
        h = hashes[every]
        one, two = np.zeros((2, len(h)), np.uint64)
        one[1:] = h[:-1]
        one[begin] = 0
        two[1:] = one[:-1]
        two[begin] = 0
        two *= _ODD[1]
        two += one
        before = (one, two, ((np.arange(COMMON + 1, dtype=np.uint64) + np.uint64(1)) * _ODD[1])[least])
    return Tokens(distinct, every, who, hashes, before, group)


def across_slots(k: int, term: np.ndarray, before: Sequence[np.ndarray]) -> np.ndarray:
    """Slots of a predictor with context. term: `_term` of the bits so far; before: the contexts, scattered."""
    at = term + before[k - 1]
    at >>= np.uint64(65 - ACROSS[k].bit_length())
    return at.view(np.int64)


def _term(node: np.ndarray) -> np.ndarray:
    return node * _TWICE


def _nodes(h: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits so far behind a leading one, and the next bit."""
    node = h >> np.uint64(64 - depth) | np.uint64(1 << depth) if depth else np.ones(len(h), np.uint64)
    return node, (h >> np.uint64(63 - depth) & np.uint64(1)).astype(np.int64)


def prefix_table(counts: np.ndarray) -> np.ndarray:
    """(zeros, ones) of the predictor without context, from the counts of all hash prefixes."""
    out = np.zeros(2 * ACROSS[0], np.float32)
    for depth in range(BITS):
        out[2 << depth : 4 << depth] = counts.reshape(2 << depth, -1).sum(1)
    return out


def scattered(before: Sequence[np.ndarray], rows: slice = slice(None)) -> list[np.ndarray]:
    return [x[rows] * _ODD[2] for x in before]


def count_across(tokens: Tokens, table: np.ndarray, chunk: int = 1 << 14) -> None:
    """Add each token to (zeros, ones) of its hash bits in the contexts that hold words; prefix_table has the first one's."""
    for a in range(0, len(tokens.ids), chunk):
        rows = slice(a, a + chunk)
        h, before = tokens.hashes[tokens.ids[rows]], scattered(tokens.before, rows)
        for depth in range(BITS):
            node, one = _nodes(h, depth)
            term = _term(node)
            for k in range(1, len(ACROSS)):
                if depth >= DEPTHS[k]:
                    continue
                at = across_slots(k, term, before)
                at += at
                at += one
                np.add.at(table[2 * ACROSS_STARTS[k] :], at, table.dtype.type(1))


def _seen(n: np.ndarray) -> np.ndarray:
    """0 to 3: never, a few times, often, very often."""
    return np.minimum((np.log2(n + np.float32(1)) + np.float32(2)) / np.float32(3), 3).astype(np.int8)


def _across_step(mixer: Mixer, tables: tuple[np.ndarray, ...], columns: list[np.ndarray]) -> None:
    odds, *seen = tables
    half = len(odds) // 2
    h, before = columns[0], scattered(columns[1:])
    for low, high in zip(_TURNS, _TURNS[1:], strict=False):  # depths that the same predictors take part in
        depth = np.arange(low, high, dtype=np.uint64)[:, None]
        node = h >> np.uint64(63) - depth
        node |= np.uint64(2) << depth  # with the next bit
        one = (node & np.uint64(1)).view(np.int64)
        node >>= np.uint64(1)
        beside, term = one * half, _term(node)
        s: list[np.ndarray | None] = [odds.take(beside + node.view(np.int64))]
        depth = depth.astype(np.int64)
        gate = np.repeat(depth * ACROSS_GATES, len(h), 1)
        for k in range(1, len(ACROSS)):
            if low >= DEPTHS[k]:
                s.append(None)
                continue
            at = across_slots(k, term, before)
            if k < 3:
                gate += seen[k - 1].take(at)
            at += beside
            s.append(odds[ACROSS_STARTS[k] :].take(at))
        correct(mixer, depth, s, gate, one)


def across_learner(table: np.ndarray) -> Learner:
    """It learns from the hash bits of tokens and their contexts."""
    without, n = left(table)
    one, two = (_seen(n[ACROSS_STARTS[k] : ACROSS_STARTS[k + 1]]) for k in (1, 2))
    return Learner(Mixer.fresh(ACROSS_GATES * BITS, len(ACROSS), BITS), (without, one * np.int8(4), two), _across_step, STEP_TOKENS)


def coded(tokens: Tokens) -> list[np.ndarray]:
    return [tokens.hashes[tokens.ids], *tokens.before]


def fit_across(table: np.ndarray, tokens: Tokens) -> Mixer:
    learner = across_learner(table)
    learner.add(coded(tokens))
    return learner.close()


@dataclass(frozen=True)
class Across:
    """Log odds and how often each context was seen, as counted; the mixer; counts of the words of each hash prefix."""

    odds: np.ndarray
    seen: np.ndarray
    mixer: Mixer

    @staticmethod
    def of(table: np.ndarray, mixer: Mixer) -> Across:
        n0, n1 = table[0::2], table[1::2]
        return Across(log_odds(n0, n1).astype(np.float32), _seen(n0 + n1), mixer)

    def bits(self, tokens: Tokens, chunk: int = 1 << 14) -> np.ndarray:
        """Log probability of each token's hash bits after the words before it."""
        out = np.zeros(len(tokens.ids))
        last = 4095
        steps = np.linspace(-8, 8, last + 1)
        # by depth: each gate's weights, and the refined log probabilities of both bits at fine steps of the mixed odds
        weights = self.mixer.weights.astype(np.float32).reshape(BITS, ACROSS_GATES, -1).transpose(0, 2, 1) * np.float32(last / 16)
        refined = [refine(self.mixer, depth, steps) for depth in range(BITS)]
        refined = [np.log(np.stack([1 - p, p], 1)).ravel() for p in refined]
        begin = [int(x) for x in ACROSS_STARTS]
        odds = [self.odds[a:b] for a, b in zip(begin, begin[1:], strict=False)]
        seen = [self.seen[a:b] for a, b in zip(begin, begin[1:], strict=False)]
        for a in range(0, len(out), chunk):
            rows = slice(a, a + chunk)
            h, before = tokens.hashes[tokens.ids[rows]], scattered(tokens.before, rows)
            for depth in range(BITS):
                node, one = _nodes(h, depth)
                term = _term(node)
                at = [across_slots(k, term, before) if depth < DEPTHS[k] else None for k in (1, 2)]
                near = [seen[k + 1].take(x) for k, x in enumerate(at) if x is not None]
                gate = near[0] * np.int8(4) + near[1] if len(near) == 2 else near[0] * np.int8(4) if near else np.zeros(len(h), np.int8)
                w = weights[depth]
                x = w[0].take(gate) * odds[0].take(node.view(np.int64))
                for k, place in enumerate(at, 1):
                    if place is not None:
                        x += w[k].take(gate) * odds[k].take(place)
                x += w[3].take(gate) * odds[3].take(across_slots(3, term, before))
                x += np.float32(last / 2 + 0.5)
                np.clip(x, 0, last, out=x)
                place = x.astype(np.int32)
                place += place
                place += one.astype(np.int32)
                out[rows] += refined[depth].take(place)
        return out


# the corpus


class Words:
    """Rows of a task's batches, each once (its count, if it has one, summed), given on once there are `most` of them."""

    def __init__(self, schema: pa.Schema, most: int) -> None:
        self.schema, self.most = schema, most
        self.held: list[pa.Table] = []
        self.size = 0

    def add(self, words: pa.Array, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(pa.table([words.cast(pa.string()), pa.array(numbers, self.schema.types[1])], self.schema.names))
        self.size += len(words)
        if self.size > self.most:
            joined = self._joined()
            self.held, self.size = [joined], len(joined)
            if self.size > self.most // 2:
                yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield from self._joined().to_batches(65536)
        self.held, self.size = [], 0

    def _joined(self) -> pa.Table:
        rows, names = pa.concat_tables(self.held), self.schema.names
        found = rows.group_by("word").aggregate([("c", "sum")]).rename_columns(names) if "c" in names else rows.group_by(names).aggregate([])
        return found.cast(self.schema)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c): counts in all texts, with the end symbol. docs: text.

    Each task sends a word once for every million of them.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Words(pa.schema([("word", pa.string()), ("c", pa.int64())]), 1 << 20)
        for batch in batches:
            distinct, ids, _ = split_words(batch.column(0))
            words = pa.concat_arrays([distinct, pa.array([END.decode()], distinct.type)])
            yield from held.add(words, np.append(np.bincount(ids, minlength=len(distinct)), batch.num_rows))
        yield from held.close()
        batch = distinct = ids = words = held = None
        freed()

    return docs.select("text").mapInArrow(run, "word string, c long").where("c > 0").groupBy("word").agg(F.sum("c").alias("c"))


def met_groups(found: Tokens) -> tuple[pa.Array, np.ndarray]:
    """The batch's words, the end among them, with a bit for each group met."""
    met = np.zeros((len(found.distinct) + 1, GROUPS + 1), np.int32)
    met[found.ids, found.group] = 1
    return pa.concat_arrays([found.distinct, pa.array([END.decode()], found.distinct.type)]), (met << np.arange(GROUPS + 1)).sum(1).astype(np.int32)


def count_contexts(docs: DataFrame, common: pa.Array) -> tuple[np.ndarray, DataFrame]:
    """The table of contexts across words but for the first predictor, and (word, groups): a bit for each group that a
    word was met in. docs: text; read once."""
    bounded_batches(docs.sparkSession)
    size = 2 * int(ACROSS_STARTS[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = np.zeros(-(-size // WIDTH) * WIDTH, np.uint32), Words(pa.schema([("word", pa.string()), ("groups", pa.int32())]), 1 << 19)
        names = ["block", "data", "word", "groups"]

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.binary()), *b.columns], names)

        for batch in batches:
            found = tokens_of(batch.column(0), common)
            count_across(found, table)
            yield from rows(held.add(*met_groups(found)))
        yield from rows(held.close())
        for b in _blocks(table):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.nulls(b.num_rows, pa.string()), pa.nulls(b.num_rows, pa.int32())], names)
        batch = found = table = held = None
        freed()

    both = stored(docs.select("text").mapInArrow(run, "block int, data binary, word string, groups int"), "contexts")
    met = both.where("word is not null").groupBy("word").agg(F.bit_or("groups").alias("groups"))
    return _merged(both.where("word is null").select("block", "data"), size), stored(met, "met")


def in_groups(words: pa.Array, groups: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """Each word once for every group it was met in."""
    row, group = np.nonzero(groups.to_numpy()[:, None] >> np.arange(GROUPS + 1) & 1)
    names = [w.encode() for w in words.to_pylist()]
    return [names[k] for k in row.tolist()], group


WIDTH = 1 << 17


def _sent(block: int, x: np.ndarray) -> pa.RecordBatch:
    """A block of four-byte numbers, their bytes in planes."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes()
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([zstandard.ZstdCompressor(level=1).compress(planes)], pa.binary())], ["block", "data"])


def _taken(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1).T).view(kind).ravel()


def _blocks(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    for block in range(len(table) // WIDTH):
        part = table[block * WIDTH : (block + 1) * WIDTH]
        if part.any():
            yield _sent(block, part)


def _merged(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' tables. Counts are summed as whole numbers, so their order doesn't matter."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block not in held:
                    held[block] = np.zeros(WIDTH, np.uint64)
                held[block] += _taken(data, "<u4")
        for block, x in held.items():
            yield _sent(block, x.astype("<f4"))
        freed()

    merged = rows.repartition("block").mapInArrow(merge, "block int, data binary").toArrow()  # the fixed size of the table
    table = np.zeros(-(-size // WIDTH) * WIDTH, np.float32)
    for block, data in zip(merged["block"].to_pylist(), merged["data"].to_pylist(), strict=True):
        table[block * WIDTH : (block + 1) * WIDTH] = _taken(data, "<f4")
    return table[:size]


def summed_tables(rows: DataFrame, add: Callable[[pa.RecordBatch, np.ndarray], None], size: int) -> np.ndarray:
    """A table of `size` counts that `add` fills from all rows: each task sends its own in compressed blocks."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(-(-size // WIDTH) * WIDTH, np.uint32)
        for batch in batches:
            add(batch, table)
        yield from _blocks(table)
        del table
        freed()

    return _merged(rows.mapInArrow(build, "block int, data binary"), size)


def fitted(rows: DataFrame, key: str, slices: int, table: np.ndarray, learner: Callable[[np.ndarray], Learner], columns: Callable[[pa.RecordBatch], list[np.ndarray]]) -> Mixer:
    """The mixer that all rows teach. Each slice's rows go to one task, which learns from them in the order of the key's
    hash; what the slices have learned is summed as whole numbers."""
    spark = rows.sparkSession
    first = learner(table)
    shared, start = spark.sparkContext.broadcast(first), first.mixer  # of fixed size
    place = F.xxhash64(key)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = shared.value.again()
        for batch in batches:
            if batch.num_rows:
                one.add(columns(batch))
        mixer = one.close()
        if mixer.mass.any():
            yield pa.RecordBatch.from_arrays([pa.array([mixer.packed(start).tobytes()], pa.binary())], ["learned"])
        batch = one = mixer = None
        freed()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column(0).to_pylist():
                x = np.frombuffer(data, np.int64)
                total = x if total is None else total + x
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["learned"])

    dealt = rows.repartitionById(slices, F.pmod(place, F.lit(slices)).cast("int")).sortWithinPartitions(place, *rows.columns)
    total = np.zeros(start.weights.size + start.refined.size + start.mass.size, np.int64)
    for (data,) in stored(dealt.mapInArrow(learn, "learned binary"), "learned").repartition(4).mapInArrow(add, "learned binary").collect():  # four rows
        total = total + np.frombuffer(data, np.int64)
    shared.destroy()
    return start.unpacked(total)


def _least(vocabulary: DataFrame, most: int) -> int:
    """The smallest count that at most `most` words reach (up to rounding to eighths of a doubling)."""
    steps = F.floor(F.log2("c") * 8).cast("int")
    tally = {row[0]: row[1] for row in vocabulary.groupBy(steps.alias("step")).count().collect()}  # a few hundred rows
    total, chosen = 0, max(tally, default=0) + 1
    for step in sorted(tally, reverse=True):
        total += tally[step]
        if total > most:
            break
        chosen = step
    return int(np.ceil(2 ** (chosen / 8) - 1e-9))


@dataclass(frozen=True)
class Counts:
    """All training tokens, the discount of a known word, and the discounted counts of the words of each hash prefix."""

    n: float
    new: float  # chance of a new word
    discount: float
    mass: np.ndarray

    def share(self, c: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Log of a known word's share among the words of its hash prefix, and of being known."""
        return np.log(np.maximum(c - self.discount, 1e-300) / self.mass[(hashes >> np.uint64(64 - BITS)).astype(np.int64)]) + np.log1p(-self.new)


@dataclass(frozen=True)
class Head:
    """The frequent words in order of their hashes, and their counts."""

    hashes: np.ndarray
    words: pa.Array
    counts: np.ndarray

    @staticmethod
    def of(words: pa.Array, counts: np.ndarray) -> Head:
        hashes = hashed(words.to_pylist())
        order = np.argsort(hashes)
        return Head(hashes[order], words.take(pa.array(order)), counts[order])

    @cached_property
    def alike(self) -> bool:
        """Whether two of the words have one hash."""
        return bool((self.hashes[1:] == self.hashes[:-1]).any())

    def places(self, words: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for one that is not there. Found by hash, then compared as a whole."""
        if self.alike or not len(self.hashes):
            return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        at[self.hashes[at] != hashes] = -1
        met = np.flatnonzero(at >= 0)
        same = pc.equal(self.words.take(pa.array(at[met])), words.take(pa.array(met)))
        at[met[~same.to_numpy(zero_copy_only=False)]] = -1
        return at


def learned_words(learned: DataFrame) -> tuple[DataFrame, list[int]]:
    """(word, c, prefix) of the training texts, stored; words, tokens, words met once and twice, texts."""

    def prefixed(batch: pa.RecordBatch) -> pa.RecordBatch:
        prefix = (hashed(batch.column(0).to_pylist()) >> np.uint64(64 - BITS)).astype(np.int32)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(prefix)], ["word", "c", "prefix"])

    vocabulary = stored(over_batches(count_words(learned), prefixed, "word string, c long, prefix int"), "vocabulary")
    found = vocabulary.agg(F.count(F.lit(1)), F.sum("c"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2), F.max(F.when(F.col("word") == END.decode(), F.col("c")))).first()
    return vocabulary, [x or 0 for x in found]


def frequent_words(vocabulary: DataFrame, least: int) -> Head:
    """The words that are met `least` times or more."""
    frequent = vocabulary.where(F.col("c") >= least).select("word", "c").toArrow()  # at most `head` rows
    return Head.of(frequent["word"].combine_chunks().cast(pa.large_string()), frequent["c"].to_numpy())


def base_scores(docs: DataFrame, trains: Column, head: int = HEAD) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score of every text as `score` gives them. They hang on the words'
    counts alone, so no mixer is learned."""
    spark, rows = docs.sparkSession, texts(docs)
    vocabulary, (v, n, _, _, end_c) = learned_words(rows.where(trains))
    least = _least(vocabulary, head)
    known = spark.sparkContext.broadcast(frequent_words(vocabulary, least))
    zero = float(np.log10(n + 0.5 * (v + 1)))

    def heads(batch: pa.RecordBatch) -> pa.RecordBatch:
        distinct, ids, owner = split_words(batch.column(1))
        size, often = batch.num_rows, known.value.counts
        at = known.value.places(distinct, hashed(distinct.to_pylist()))
        hit = at[ids] >= 0
        base = np.bincount(owner[hit], np.log10(often[at[ids[hit]]] + 0.5), size) + np.log10(end_c + 0.5)
        width = max(1, len(distinct))
        pairs, times = np.unique(owner[~hit] * width + ids[~hit], return_counts=True)
        none = np.zeros(len(pairs))
        columns = [
            pa.array(np.concatenate([batch.column(0).to_numpy(), batch.column(0).to_numpy()[pairs // width]])), pa.concat_arrays([pa.nulls(size, pa.string()), distinct.take(pa.array(pairs % width)).cast(pa.string())]),
            pa.array(np.concatenate([np.bincount(owner, minlength=size) + 1, times]).astype(np.int64)), pa.array(np.concatenate([np.bincount(owner[hit], minlength=size) + (end_c > 0), none]).astype(np.int64)), pa.array(np.concatenate([base, none])),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "word", "n", "known", "base"])

    placed = stored(over_batches(rows, heads, "doc_id long, word string, n long, known long, base double"), "tokens")
    rest = placed.where("word is not null").select("word", "doc_id", "n").join(vocabulary.where(F.col("c") < least).select("word", "c"), "word", "left")
    more = rest.select("doc_id", F.lit(0).cast("long").alias("tokens"), F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("known"), (F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("base"))
    every = placed.where("word is null").select("doc_id", F.col("n").alias("tokens"), "known", "base").unionByName(more)
    total = every.groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in ("tokens", "known", "base")))
    return total.select("doc_id", F.col("tokens").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), (F.col("base") - F.col("tokens") * zero).alias("base_score"))


def score(docs: DataFrame, trains: Column, head: int = HEAD) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every text.

    trains: a condition on doc_id; the texts that meet it are learned from. bits_per_byte is over the bytes that are
    scored: words, each with a closing space, and the end.
    """
    spark, rows = docs.sparkSession, texts(docs)
    learned = rows.where(trains)
    bounded_batches(spark)
    vocabulary, (v, n, once, twice, n_docs) = learned_words(learned)
    common = pa.array([r.word for r in vocabulary.where(F.col("word") != END.decode()).orderBy(F.desc("c"), "word").limit(COMMON).collect()], pa.large_string())
    discount = float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.95)) if once else 0.5
    mass, whole = np.zeros((2, 1 << BITS))
    for prefix, c, words in vocabulary.groupBy("prefix").agg(F.sum("c"), F.count(F.lit(1))).collect():  # a row a prefix
        mass[prefix], whole[prefix] = c - discount * words, c
    counts = Counts(n, min(max(discount * v / n, 1e-9), 1 - 1e-9) if n else 1 - 1e-9, discount, np.maximum(mass, 1e-300))

    across_table, met = count_contexts(learned, common)
    across_table[: 2 * ACROSS[0]] = prefix_table(whole)
    across = Across.of(across_table, fitted(learned, "doc_id", max(1, -(-n // SLICE_TOKENS)), across_table, across_learner, lambda batch: coded(tokens_of(batch.column(1), common))))
    spell_table = summed_tables(met.coalesce(max(1, -(-v // TASK_WORDS))), lambda batch, table: count_tables(*in_groups(batch.column(0), batch.column(1)), table), 2 * int(STARTS[-1]))
    speller = Model(spell_table, fitted(met, "word", max(1, -(-v // SLICE_WORDS)), spell_table, spelling_learner, lambda batch: spelled(*in_groups(batch.column(0), batch.column(1)))))
    shared = spark.sparkContext.broadcast((across, speller))  # of the fixed size of the tables
    least = _least(vocabulary, head)
    known = spark.sparkContext.broadcast(frequent_words(vocabulary, least))
    zero, end_c = float(np.log10(n + 0.5 * (v + 1))), n_docs

    def heads(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = tokens_of(batch.column(1), common)
        size, docs_here, distinct = batch.num_rows, batch.column(0).to_numpy(), found.distinct
        often, at = known.value.counts, known.value.places(distinct, found.hashes[:-1])
        c = np.append(np.where(at >= 0, often[at] if len(often) else 0, 0), end_c)
        here = np.append(at >= 0, True)
        bits = shared.value[0].bits(found)
        share = np.where(c > 0, counts.share(c.astype(float), found.hashes), np.log(counts.new))
        if not end_c:
            share[-1] += shared.value[1].spell([END], np.full(1, GROUPS))[0]
        which, owner = found.ids, found.owner
        hit = here[which]
        one, which_hit = owner[hit], which[hit]
        lp = np.bincount(one, share[which_hit] + np.where(c[which_hit] > 0, bits[hit], 0.0), size)
        length = np.append(pc.binary_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64) + 1, 1)
        width = max(1, len(distinct))
        pairs, inverse, times = np.unique((owner[~hit] * width + which[~hit]) * (GROUPS + 1) + found.group[~hit], return_inverse=True, return_counts=True)
        group, who, what = pairs % (GROUPS + 1), pairs // (GROUPS + 1) // width, pairs // (GROUPS + 1) % width
        none = np.zeros(len(who))
        columns = [
            pa.array(np.concatenate([docs_here, docs_here[who]])), pa.concat_arrays([pa.nulls(size, pa.string()), distinct.take(pa.array(what)).cast(pa.string())]),
            pa.array(np.concatenate([np.bincount(owner, minlength=size), times]).astype(np.int64)), pa.array(np.concatenate([np.bincount(one, c[which_hit] > 0, size), none]).astype(np.int64)),
            pa.array(np.concatenate([np.bincount(one, np.log10(c[which_hit] + 0.5), size), none])), pa.array(np.concatenate([np.bincount(owner, length[which], size), none]).astype(np.int64)),
            pa.array(np.concatenate([lp, np.bincount(inverse, bits[~hit], len(who))])), pa.array(np.concatenate([np.full(size, GROUPS), group]).astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "word", "n", "known", "base", "n_bytes", "lp", "group"])

    placed = stored(over_batches(rows, heads, "doc_id long, word string, n long, known long, base double, n_bytes long, lp double, group int"), "tokens")
    # lp of a rare word's row is that of its hash bits, for the case that it is known
    rest = placed.where("word is not null").select("word", "doc_id", "n", "lp", "group").join(vocabulary.where(F.col("c") < least).select("word", "c"), "word", "left")

    def tails(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.column(0).dictionary_encode()
        ids, listed = names.indices.to_numpy().astype(np.int64), names.dictionary.to_pylist()
        c, times, bits = batch.column(4).fill_null(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(), batch.column(3).to_numpy()
        value, old = np.zeros(len(ids)), c > 0
        share = counts.share(c.astype(float), hashed(listed)[ids])
        value[old] = times[old] * share[old] + bits[old]
        pairs, inverse = np.unique(ids[~old] * (GROUPS + 1) + batch.column(5).to_numpy()[~old], return_inverse=True)
        spelled = shared.value[1].spell([listed[k].encode() for k in (pairs // (GROUPS + 1)).tolist()], pairs % (GROUPS + 1))
        value[~old] = times[~old] * (spelled[inverse] + np.log(counts.new))
        docs_here, where = np.unique(batch.column(1).to_numpy(), return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(docs_here), pa.array(np.bincount(where, times * (c > 0)).astype(np.int64)), pa.array(np.bincount(where, times * np.log10(c + 0.5))), pa.array(np.bincount(where, value))], ["doc_id", "known", "base", "lp"])

    more = over_batches(rest.select("word", "doc_id", "n", "lp", "c", "group"), tails, "doc_id long, known long, base double, lp double")
    nothing = F.lit(0).cast("long")
    every = placed.where("word is null").select("doc_id", F.col("n").alias("tokens"), "known", "base", "n_bytes", "lp").unionByName(more.select("doc_id", nothing.alias("tokens"), "known", "base", nothing.alias("n_bytes"), "lp"))
    total = every.groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in ("tokens", "known", "base", "n_bytes", "lp")))
    return total.select(
        "doc_id", F.col("tokens").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), (F.col("base") - F.col("tokens") * zero).alias("base_score"), (F.col("lp") / LOG10).alias("score"),
        (-F.col("lp") / F.lit(float(np.log(2))) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
