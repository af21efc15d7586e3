"""Benchmark decontamination: a BM25 inverted index of the test items, every training passage as a query.

Texts and items are cut by the same rule: words between white space, in lower case and without outer punctuation, each
character by itself in scripts that put no spaces between words. A passage is a window of tokens twice as long as the
longest item, at every half window, so an item always lies whole in some passage. Impacts are divided by the item's
score against itself, so one threshold serves all items. Postings stand in blocks of items, each with the largest impact
of each term: passages whose sum of block maxima stays below the threshold are dropped for that block, and the rest go
through WAND, which returns every item at or above it. A hit is verified within stretches of the passage twice as long
as the item: by the share of the question's and of the answer's tokens that lie in trigrams the stretch also has; the
question is the item's first sentence (or its first half), the answer the rest. Items of under MIN_WORDS tokens must
stand there token by token.

Null and empty texts have no passages, items without a token match nothing; repeated items match alike, repeated rows
give one row each pair; extra columns are left behind by `matches` and kept by `clean`. Items are held in shards of about
SHARD, chosen by hash, one pass over the texts each; document frequencies and mean length are those of all items.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, freed, over_batches, stored, texts
from .langid import split

K1, B = 1.2, 0.75
THRESHOLD = 0.5
OVERLAP = 0.5
MIN_WORDS = 5
#: Items in a block at least, and blocks of an index at most.
BLOCK, MOST_BLOCKS = 4, 256
SHARD = 20_000
#: Sums of maxima may fall short of a sum of the same numbers in another order by rounding.
SLACK = 1e-9
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[\u3002\uff01\uff1f])\s*")
#: Thai, Lao, Myanmar, Khmer, Kana, Han: no spaces between words.
_SOLID = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_ANY_SOLID, _CUT_SOLID = re.compile(f"[{_SOLID}]"), re.compile(f"[{_SOLID}]|[^{_SOLID}]+")


def normal(word: str) -> str:
    return _EDGES.sub("", word)


def tokens_of(word: str) -> list[str]:
    """Tokens of a stretch without ASCII white space, in lower case."""
    if word.isascii() and word.isalnum():
        return [word]
    pieces = word.split()
    if not word.isascii() and _ANY_SOLID.search(word):
        pieces = [x for piece in pieces for x in _CUT_SOLID.findall(piece)]
    return [x for x in map(normal, pieces) if x]


def words_of(text: str) -> list[str]:
    words = split(pa.array([text], pa.string()))
    tokens = [tokens_of(w) for w in words.distinct.to_pylist()]
    return [t for k in words.ids.tolist() for t in tokens[k]]


def parts(text: str) -> tuple[list[str], list[str]]:
    """Tokens of the question and of the answer."""
    first, *rest = _SENTENCE.split(text.strip(), maxsplit=1)
    question, answer = words_of(first), words_of(rest[0] if rest else "")
    if len(question) < 3 or len(answer) < 3:
        both = question + answer
        question, answer = both[: len(both) // 2], both[len(both) // 2 :]
    return question, answer


def trigrams(words: list) -> set[tuple]:
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def covered(part: list, seen: set[tuple]) -> float:
    """Share of the tokens that lie in a trigram of `seen`."""
    marks = [False] * len(part)
    for i in range(len(part) - 2):
        if tuple(part[i : i + 3]) in seen:
            marks[i : i + 3] = [True] * 3
    return sum(marks) / len(part) if part else 1.0


def verified(window: list, question: list, answer: list, overlap: float) -> tuple[float, float] | None:
    """The overlaps of question and answer in the stretch that has most of both; null if one is below `overlap`."""
    whole = question + answer
    n = len(whole)
    if n < MIN_WORDS:
        return (1.0, 1.0) if any(window[i : i + n] == whole for i in range(len(window) - n + 1)) else None
    best = None
    for at in range(0, max(1, len(window) - n), n):
        seen = trigrams(window[at : at + 2 * n])
        found = covered(question, seen), covered(answer, seen)
        if min(found) >= overlap and (best is None or sum(found) > sum(best)):
            best = found
    return best


@dataclass(frozen=True)
class Index:
    ids: list[int]
    items: list[tuple[list[int], list[int]]]  # question and answer, as terms
    terms: dict[str, int]
    postings: list[dict[int, tuple[list[int], list[float]]]]  # of each block: by term, item positions and impacts
    block: int
    peaks: np.ndarray  # term, block: largest impact
    half: int  # words in half a passage


def build(rows: list[tuple[int, str]], n: int | None = None, mean: float | None = None, frequencies: dict[str, int] | None = None) -> Index:
    """Index of (id, text) rows. n, mean, frequencies: items, their mean length and document frequencies, if there are more."""
    terms: dict[str, int] = {}
    cut = [(i, parts(t or "")) for i, t in rows]
    cut = [(i, x) for i, x in cut if x[0] or x[1]]
    split_rows = [tuple([terms.setdefault(w, len(terms)) for w in part] for part in x) for _, x in cut]
    whole = [q + a for q, a in split_rows]
    df = np.zeros(len(terms))
    for item in whole:
        df[list(set(item))] += 1
    if frequencies is not None:
        df = np.array([frequencies[t] for t in terms], float)
    n = len(whole) if n is None else n
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    mean = sum(map(len, whole)) / max(1, len(whole)) if mean is None else mean
    lists: list[list[tuple[int, float]]] = [[] for _ in terms]
    for at, item in enumerate(whole):
        score = {t: idf[t] * k * (K1 + 1) / (k + K1 * (1 - B + B * len(item) / mean)) for t, k in Counter(item).items()}
        own = sum(score.values())
        for t, s in score.items():
            lists[t].append((at, s / own))
    block = max(BLOCK, -(-len(whole) // MOST_BLOCKS))
    peaks = np.zeros((len(terms), max(1, -(-len(whole) // block))))
    postings: list[dict[int, tuple[list[int], list[float]]]] = [{} for _ in range(peaks.shape[1])]
    for t, entries in enumerate(lists):
        for at, s in entries:
            peaks[t, at // block] = max(peaks[t, at // block], s)
            found = postings[at // block].setdefault(t, ([], []))
            found[0].append(at)
            found[1].append(s)
    return Index([i for i, _ in cut], split_rows, terms, postings, block, peaks, max(32, max(map(len, whole), default=0)))


def wand(index: Index, query: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
    """Items of one block whose score against the distinct terms is at least the threshold, by WAND."""
    here = index.postings[block]
    lists = [[*here[t], 0, float(index.peaks[t, block])] for t in query if t in here]
    if sum(x[3] for x in lists) < threshold - SLACK:
        return []
    out = []
    while lists:
        lists.sort(key=lambda x: x[0][x[2]])
        bound, pivot = 0.0, None
        for k, x in enumerate(lists):
            bound += x[3]
            if bound >= threshold - SLACK:
                pivot = x[0][x[2]]
                break
        if pivot is None:
            break
        if lists[0][0][lists[0][2]] == pivot:
            score = 0.0
            for x in lists:
                if x[0][x[2]] != pivot:
                    break
                score += x[1][x[2]]
            if score >= threshold:
                out.append((pivot, score))
            past = pivot + 1
        else:
            past = pivot
        for x in lists:
            while x[2] < len(x[0]) and x[0][x[2]] < past:
                x[2] += 1
        lists = [x for x in lists if x[2] < len(x[0])]
    return out


def search(index: Index, batch_texts: pa.Array, threshold: float, overlap: float) -> list[tuple[int, int, float, float, float]]:
    """(text, item position, score, question overlap, answer overlap) of every verified hit in the texts."""
    words = split(batch_texts)
    tokens = [tokens_of(w) for w in words.distinct.to_pylist()]
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    of = np.fromiter((index.terms.get(t, -1) for ts in tokens for t in ts), np.int64, int(lengths.sum()))
    owner = np.repeat(np.arange(len(words.counts)), words.counts)
    if (lengths == 1).all():
        term = of[words.ids]
    else:
        n = lengths[words.ids]
        term = of[np.repeat((np.cumsum(lengths) - lengths)[words.ids] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        owner = np.repeat(owner, n)
    if not len(term):
        return []
    sizes = np.bincount(owner, minlength=len(words.counts))
    start = np.cumsum(sizes) - sizes
    halves = np.maximum(1, -(-sizes // index.half))
    first_half = np.cumsum(halves) - halves
    half = first_half[owner] + (np.arange(len(term)) - start[owner]) // index.half
    known = term >= 0
    key = np.unique(half[known] * len(index.terms) + term[known])
    if not len(key):
        return []
    key_half, key_term = key // len(index.terms), key % len(index.terms)
    cut = np.flatnonzero(np.concatenate([[True], key_half[1:] != key_half[:-1]]))
    bounds = np.zeros((int(halves.sum()) + 1, index.peaks.shape[1]))
    for a in range(0, len(cut), 4096):  # a bounded piece of the gather at a time
        lo, hi = cut[a], cut[a + 4096] if a + 4096 < len(cut) else len(key)
        bounds[key_half[cut[a : a + 4096]]] = np.add.reduceat(index.peaks[key_term[lo:hi]], cut[a : a + 4096] - lo)
    last = first_half + halves - 1
    follows = np.ones(len(bounds), bool)
    follows[last] = False
    bounds[:-1] += np.where(follows[:-1, None], bounds[1:], 0)
    best: dict[tuple[int, int], tuple] = {}
    held, doc, window, distinct = -1, 0, [], []
    for h, block in np.argwhere(bounds >= threshold - SLACK).tolist():
        if held != h:
            doc = int(np.searchsorted(first_half, h, side="right") - 1)
            while not sizes[doc]:
                doc -= 1
            a = start[doc] + (h - first_half[doc]) * index.half
            window = term[a : min(a + 2 * index.half, start[doc] + sizes[doc])].tolist()
            held, distinct = h, sorted({t for t in window if t >= 0})
        for item, score in wand(index, distinct, block, threshold):
            if (doc, item) in best and best[doc, item][0] >= score:
                continue
            found = verified(window, *index.items[item], overlap)
            if found:
                best[doc, item] = (score, *found)
    return [(doc, item, *found) for (doc, item), found in sorted(best.items())]


def indexes(items: DataFrame, shard: int = SHARD) -> Iterator[Index]:
    """Indexes of all items, about `shard` in each; only one is held here at a time."""
    rows = items.where("text is not null and item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    count = rows.count()
    if count <= shard:
        yield build([tuple(r) for r in rows.orderBy("item_id", "text").collect()])  # at most `shard` items
        return

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        whole = [q + a for q, a in map(parts, batch.column(1).to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([sorted(set(w)) for w in whole], pa.list_(pa.string())), pa.array([len(w) for w in whole], pa.int64())], ["item_id", "text", "terms", "n"])

    shards = -(-count // shard)
    known = stored(over_batches(rows, cut, "item_id long, text string, terms array<string>, n long").where("n > 0").withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))), "items")
    n, mean = known.agg(F.count(F.lit(1)), F.avg("n")).first()
    frequencies = stored(known.select(F.explode("terms").alias("term")).groupBy("term").count(), "frequencies")
    for k in range(shards):
        mine = known.where(F.col("shard") == k)
        own = frequencies.join(mine.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi")
        yield build([(r.item_id, r.text) for r in mine.orderBy("item_id", "text").collect()], n, mean, dict(map(tuple, own.collect())))  # about `shard` items and their terms


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard: int = SHARD) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every verified pair of a document and a test item."""
    found, held = None, None
    for index in indexes(items, shard):
        if held is not None:  # one shard lives on the workers at a time
            found = stored(found, "matches")
            held.unpersist()
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batch: pa.RecordBatch, index=held) -> pa.RecordBatch:
            hits = search(index.value, batch.column(1), threshold, overlap)
            ids = batch.column(0).to_pylist()
            columns = [pa.array([ids[h[0]] for h in hits], pa.int64()), pa.array([index.value.ids[h[1]] for h in hits], pa.int64()), *(pa.array([float(h[k]) for h in hits], pa.float64()) for k in (2, 3, 4))]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        part = over_batches(texts(docs), run, "doc_id long, item_id long, score double, question_overlap double, answer_overlap double")
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard: int = SHARD) -> DataFrame:
    """docs without the rows whose text matches a test item; no row is shuffled."""
    bounded_batches(docs.sparkSession)
    kept, held, at = docs, None, docs.columns.index("text")
    for index in indexes(items, shard):
        if held is not None:
            kept = stored(kept, "clean")
            held.unpersist()
        held = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], index=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[h[0] for h in search(index.value, batch.column(at), threshold, overlap)]] = False
                yield batch.filter(pa.array(keep))
            freed()

        kept = kept.mapInArrow(run, docs.schema)
    return kept
