"""Language identification with spans: script ranges narrow the candidates of each word, hashed byte n-grams score
them, and Viterbi with a switching penalty labels the words of mixed-language texts.

The model is, for each learned language, the frequency of every hashed n-gram (1 to 4 bytes, word ends included) and
of the scripts of its words, counted over all labelled documents given to `learn`; its size does not grow with them.
Letters are what Unicode calls so; in scripts without a name here all candidates stay open. A text's language is the
one whose spans hold most letters, ties going to the first in order of name; the score is those spans' share. Null
texts and texts without letters are `und` with score 0, and so is everything if no language was learned. Repeated rows
count once each; extra columns are left behind; only the text is looked at.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, freed, over_batches

SLOTS = 1 << 16
ORDERS = (1, 2, 3, 4)
SWITCH = 6.0
#: Distinct words whose n-grams are held at once.
PIECE = 1 << 15
#: Evidence of one word is at most this many nats.
MOST = 8.0
#: First code points of script ranges, and the script from there on (0: none named; its letters are of script OTHER).
SCRIPTS = (
    (0x41, 1), (0x5B, 0), (0x61, 1), (0x7B, 0), (0xAA, 1), (0xAB, 0), (0xB5, 1), (0xB6, 0), (0xBA, 1), (0xBB, 0), (0xC0, 1), (0xD7, 0), (0xD8, 1), (0xF7, 0), (0xF8, 1),
    (0x2B0, 0), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6), (0x700, 0), (0x750, 6), (0x780, 0), (0x900, 7), (0x980, 8), (0xA00, 9), (0xA80, 10), (0xB00, 0),
    (0xB80, 11), (0xC00, 12), (0xC80, 13), (0xD00, 14), (0xD80, 0), (0xE00, 15), (0xE80, 0), (0x10A0, 16), (0x1100, 17), (0x1200, 18), (0x1380, 0), (0x1E00, 1), (0x1F00, 2),
    (0x2000, 0), (0x3040, 19), (0x3100, 0), (0x3130, 17), (0x3190, 0), (0x3400, 20), (0x4DC0, 0), (0x4E00, 20), (0xA000, 0), (0xAC00, 17), (0xD7B0, 0), (0xF900, 20), (0xFB00, 0), (0x20000, 20), (0x30000, 0),
)
OTHER = 21
N_SCRIPTS = 22


def _script_table() -> np.ndarray:
    """The script of every code point; 0 of all that are no letters in Unicode."""
    codes = np.arange(sys.maxunicode + 1)
    named = np.array([0] + [s for _, s in SCRIPTS], np.int8)[np.searchsorted([0] + [a for a, _ in SCRIPTS], codes, side="right") - 1]
    letter = np.fromiter((chr(c).isalpha() for c in range(len(codes))), bool, len(codes))
    return np.where(letter, np.where(named > 0, named, np.int8(OTHER)), np.int8(0))


_SCRIPT = _script_table()


@dataclass(frozen=True)
class Words:
    """Distinct words of a batch and the words of each text, in order."""

    distinct: pa.Array
    ids: np.ndarray
    counts: np.ndarray


def split(texts: pa.Array) -> Words:
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.utf8_lower(texts).cast(pa.large_string()))
    flat = lists.flatten()
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))[full]
    coded = flat.filter(pa.array(full)).dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.bincount(owner, minlength=len(texts)))


def scripts_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters of each word, and the script of its last letter (0: no letter)."""
    n = len(words)
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    script = _SCRIPT[codes].astype(np.int64)
    owner = np.repeat(np.arange(n), lengths)
    letters = np.bincount(owner, script > 0, n).astype(np.int64)
    last = np.zeros(n, np.int64)
    lettered = script > 0
    last[owner[lettered]] = script[lettered]
    return letters, last


def ngrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word, slot) of every n-gram of every word with its ends marked."""
    raw = ["\x02" + w + "\x03" for w in words.to_pylist()]
    data = [x.encode("utf-8", "surrogatepass") for x in raw]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    flat = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(data)), sizes)
    owners, slots = [], []
    rolled = np.zeros(len(flat), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        rolled = rolled[: len(flat) - order + 1] * np.uint64(0x100000001B3) + flat[order - 1 :] + np.uint64(order)
        same = owner[: len(rolled)] == owner[order - 1 :]
        mixed = (rolled * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
        owners.append(owner[: len(rolled)][same])
        slots.append(mixed[same].astype(np.int64))
        rolled = rolled[: len(rolled)]
    return np.concatenate(owners), np.concatenate(slots)


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    weights: np.ndarray  # language, slot: log frequency
    allowed: np.ndarray  # script, language

    def scores(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Evidence for each language of each word (at most 0), and the word's letters."""
        n, letters = len(words), np.zeros(0, np.int64)
        out = np.zeros((n, len(self.langs)), np.float32)
        if n > PIECE:
            parts = [self.scores(words.slice(a, PIECE)) for a in range(0, n, PIECE)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        if n:
            letters, script = scripts_of(words)
            owner, slot = ngrams(words)
            for k in range(len(self.langs)):
                out[:, k] = np.bincount(owner, self.weights[k, slot], n)
            out *= 0.5
            out -= out.max(1, keepdims=True)
            out = np.maximum(out, -MOST)
            ok = self.allowed[script]
            narrowed = ok.any(1)
            out[narrowed] = np.where(ok[narrowed], out[narrowed], -2 * MOST)
            out -= out.max(1, keepdims=True)
            out[letters == 0] = 0
        return out, letters


def learn(labelled: DataFrame) -> Model:
    """Count n-grams and scripts over all rows of (text, lang); rows with a null lang or text teach nothing."""
    size = 4 * (SLOTS + N_SCRIPTS)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, rows = np.array(batch.column(1).to_pylist(), object), []
        for lang in sorted(set(langs)):
            words = split(batch.column(0).filter(pa.array(langs == lang)))
            times = np.bincount(words.ids, minlength=len(words.distinct)).astype(float)
            total = np.zeros(SLOTS + N_SCRIPTS)
            for a in range(0, len(times), PIECE):
                piece, n = words.distinct.slice(a, PIECE), times[a : a + PIECE]
                owner, slot = ngrams(piece)
                letters, script = scripts_of(piece)
                total += np.concatenate([np.bincount(slot, n[owner], SLOTS), np.bincount(script, n * (letters > 0), N_SCRIPTS)])
            if len(times):
                rows.append((lang, total.astype("<f4").tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["lang", "counts"])

    def merge(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[lang] = held.get(lang, 0) + np.frombuffer(counts, "<f4").astype("<f8")
        for lang, counts in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([counts.astype("<f4").tobytes()], pa.binary())], ["lang", "counts"])

    rows = labelled.where("text is not null and lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    partial = over_batches(rows, count, "lang string, counts binary").mapInArrow(merge, "lang string, counts binary")
    # a row a language and task is left; a second sum leaves one a language in each of a few tasks
    found: dict[str, np.ndarray] = {}
    for lang, counts in partial.repartition(4).mapInArrow(merge, "lang string, counts binary").toLocalIterator():
        assert len(counts) == size
        found[lang] = found.get(lang, 0) + np.frombuffer(counts, "<f4").astype(float)
    langs = tuple(sorted(found))
    if not langs:
        return Model((), np.zeros((0, SLOTS), np.float32), np.zeros((N_SCRIPTS, 0), bool))
    counts = np.stack([found[x][:SLOTS] for x in langs])
    scripts = np.stack([found[x][SLOTS:] for x in langs])
    weights = np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * SLOTS)).astype(np.float32)
    allowed = (scripts >= 0.001 * np.maximum(scripts.sum(1, keepdims=True), 1)).T
    allowed[OTHER] = True
    return Model(langs, weights, allowed)


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Best language of each word; words of all texts stand one after another, and texts are decoded side by side."""
    order = np.argsort(-counts, kind="stable")
    counts, first = counts[order], (np.cumsum(counts) - counts)[order]
    longest, k = int(counts.max(initial=0)), scores.shape[1]
    active = np.searchsorted(-counts, -np.arange(longest), side="left")
    label = np.zeros(len(scores), np.int16)
    if not longest:
        return label
    stay = np.zeros((len(scores), k), bool)
    best = np.zeros(len(scores), np.int16)
    state = np.zeros((len(counts), k), np.float32)
    state[: active[0]] = scores[first[: active[0]]]
    for t in range(1, longest):
        n = int(active[t])
        at, now = first[:n] + t, state[:n]
        top = now.argmax(1)
        high = now.max(1)[:, None] - np.float32(penalty)
        keep = now >= high
        best[at], stay[at] = top, keep
        state[:n] = np.where(keep, now, high) + scores[at]
        state[:n] -= high
    current = state.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = int(active[t])
        at = first[:n] + t
        label[at] = current[:n]
        if t:
            current[:n] = np.where(stay[at, current[:n]], current[:n], best[at])
    return label


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, spans (runs of words: language, words) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by SLOTS and the number of languages

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m, words = shared.value, split(batch.column(1))
        n, k = len(words.counts), max(1, len(m.langs))
        names, share, spans = ["und"] * n, np.zeros(n), [""] * n
        if m.langs:
            scores, letters = m.scores(words.distinct)
            label = viterbi(scores[words.ids], words.counts)
            owner = np.repeat(np.arange(n), words.counts)
            weight = np.bincount(owner * k + label, letters[words.ids], n * k).reshape(n, k)
            total = weight.sum(1)
            share = np.where(total > 0, weight.max(1) / np.maximum(total, 1), 0.0)
            names = [m.langs[i] if some else "und" for i, some in zip(weight.argmax(1), total > 0, strict=True)]
            cut = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (label[1:] != label[:-1])])) if len(owner) else np.zeros(0, np.int64)
            runs = np.diff(np.append(cut, len(owner)))
            parts: list[list[str]] = [[] for _ in range(n)]
            for o, i, size in zip(owner[cut].tolist(), label[cut].tolist(), runs.tolist(), strict=True):
                parts[o].append(f"{m.langs[i]}:{size}")
            spans = [",".join(p) for p in parts]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names), pa.array(share), pa.array(spans)], ["doc_id", "lang_pred", "score", "spans"])

    return over_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, lang_pred string, score double, spans string")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.4) -> DataFrame:
    """docs without those that are `und` or whose best language has under `least` of the letters; columns are kept."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            m, words = shared.value, split(batch.column(at))
            n, k = len(words.counts), max(1, len(m.langs))
            keep = np.zeros(n, bool)
            if m.langs:
                scores, letters = m.scores(words.distinct)
                label = viterbi(scores[words.ids], words.counts)
                weight = np.bincount(np.repeat(np.arange(n), words.counts) * k + label, letters[words.ids], n * k).reshape(n, k)
                keep = (weight.sum(1) > 0) & (weight.max(1) >= least * weight.sum(1))
            yield batch.filter(pa.array(keep))
        freed()

    return docs.mapInArrow(run, docs.schema)
