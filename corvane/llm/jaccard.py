"""Near copies by SimHash and the similarity of their shingle sets: all pairs at or above SHARE, none below.

Texts are linked by the SimHash fingerprints of their sets first: equal ones and those within RADIUS bits, each found by
exact bands, with the least text of what the fingerprints join. At a similarity of 0.8 most fingerprints are farther
apart than any bands can reach, so an exact way finds the rest:

Shingles are ordered by how often their slot of a fixed table of counts was met over all texts, rare ones first. Two
sets of similarity s share a shingle among the first n - ceil(s n) + 1 of each (prefix filter), so texts that share
one there are the candidates; sizes and the places of the shared shingle must allow the similarity. A candidate is a
link only once the similarity of both whole sets is computed. Texts with one set are one node. Each prefix shingle's
texts are compared with their least member first; then, where that left them in different components, with each other,
so no pair is lost and a group of copies isn't compared all against all.

Null texts and texts without words are copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, freed, over_batches, stored, texts
from .components import components
from .simhash import exact_bands, fingerprint, links, shingle_hashes

#: Fifths: a similarity of 0.8, in whole numbers.
SHARE = 4
WORDS = 5
#: Bits that the fingerprints of candidates differ by at most.
RADIUS = 4
#: Slots of the table of counts, a power of two.
SLOTS = 1 << 20
#: Keys that the links of one text are spread over, and those of the texts with one set.
SPREAD, SALTS = 64, 16


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= SHARE * (len(a) + len(b) - both)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(65 - SLOTS.bit_length())).astype(np.int64)


def digests(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """doc_id, digest and fingerprint (fp) of every text's set, and the counts of all slots. docs: doc_id, text."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        names = ["doc_id", "digest", "fp", "counts"]
        for batch in batches:
            out, fps = [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text)
                np.add.at(counts, _slot(found), 1)
                out.append(xxhash.xxh3_128_digest(found.tobytes()))
                fps.append(fingerprint(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), pa.array(fps, pa.binary()), pa.nulls(len(out), pa.binary())], names)
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([zstandard.compress(counts.astype("<u4").tobytes(), 1)], pa.binary())], names)
        freed()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += np.frombuffer(zstandard.decompress(data), "<u4")
        yield pa.RecordBatch.from_arrays([pa.array([zstandard.compress(total.astype("<u4").tobytes(), 1)], pa.binary())], ["counts"])

    both = stored(docs.mapInArrow(run, "doc_id long, digest binary, fp binary, counts binary"), "set-digests")
    counts = np.zeros(SLOTS, np.int64)
    for (data,) in both.where("counts is not null").select("counts").repartition(4).mapInArrow(merge, "counts binary").toLocalIterator():
        counts += np.frombuffer(zstandard.decompress(data), "<u4")
    return both.where("counts is null").select("doc_id", "digest", "fp"), counts


def alike(fps: DataFrame) -> DataFrame:
    """u, v (u < v): pairs that connect all texts whose fingerprints are at most RADIUS bits apart. fps: doc_id, fp."""
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n")), "set-fingerprints")
    # a fingerprint that many texts have meets its least one in SALTS places
    salted = distinct.where("n > 1").select("fp", "node", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    equal = fps.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, ["fp", "salt"]).select(F.col("node").alias("u"), F.col("doc_id").alias("v"))
    near = links(distinct, RADIUS, exact_bands(RADIUS, distinct.count()))
    return equal.unionByName(near).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u < v").distinct()


def prefixes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """shingle, node, size, at: the prefix of each text's set, with the set's size and the shingle's place."""
    shared = docs.sparkSession.sparkContext.broadcast(counts.astype("<u4"))  # of fixed size

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts, sizes, kept = [np.zeros(0, np.uint64)], [], []
        for text in batch.column(1).to_pylist():
            found = shingles(text)
            n = len(found)
            k = n - -(-SHARE * n // 5) + 1 if n else 0
            parts.append(found[np.lexsort((found, shared.value[_slot(found)]))[:k]])
            sizes.append(n)
            kept.append(k)
        k = np.array(kept, np.int64)
        at = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64)), batch.column(0).take(pa.array(np.repeat(np.arange(len(k)), k))), pa.array(np.repeat(np.array(sizes, np.int32), k)), pa.array(at.astype(np.int32))], ["shingle", "node", "size", "at"])

    return over_batches(docs, run, "shingle long, node long, size int, at int")


def possible(size_a, at_a, size_b, at_b) -> np.ndarray:
    """Whether sets whose first shared shingle stands at these places may be similar enough."""
    return 9 * (1 + np.minimum(size_a - at_a - 1, size_b - at_b - 1)) >= SHARE * (size_a + size_b)


def pairs(buckets: DataFrame, rooted: bool) -> DataFrame:
    """u, v (u < v), without repeats: of each bucket its least node with all others; rooted: all pairs of different roots."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(0)
        ends = np.cumsum(lists.value_lengths().to_numpy())
        flat = lists.flatten()
        node, size, at, root = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4))
        us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            if rooted:
                names, which = np.unique(root[a:b], return_inverse=True)
                if len(names) == 1:
                    continue
                sources = a + np.flatnonzero(which != np.bincount(which).argmax())
            else:
                sources = [a + int(node[a:b].argmin())]
            for i in sources:
                ok = possible(size[i], at[i], size[a:b], at[a:b]) & (node[a:b] != node[i])
                if rooted:
                    ok &= root[a:b] != root[i]
                other = node[a:b][ok]
                us.append(np.minimum(node[i], other))
                vs.append(np.maximum(node[i], other))
        found = np.unique(np.stack([np.concatenate(us), np.concatenate(vs)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["u", "v"])

    return over_batches(buckets.select("a"), run, "u long, v long").distinct()


def verified(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs of `found` whose whole sets are similar enough."""
    part = lambda name: F.pmod(F.xxhash64(name), F.lit(SPREAD)).cast("int")
    spread = stored(found.select("u", "v", part("v").alias("p"), part("u").alias("q")), "pairs")
    first = spread.select("u", "p").distinct().join(docs.select(F.col("doc_id").alias("u"), F.col("text").alias("a")), "u")
    second = spread.select("v", "q").distinct().join(docs.select(F.col("doc_id").alias("v"), F.col("text").alias("b")), "v")
    both = spread.join(first, ["u", "p"]).join(second, ["v", "q"])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held: dict[int, np.ndarray] = {}
        ok = []
        for u, a, b in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
            if u not in held:
                held = {u: shingles(a)}
            ok.append(similar(held[u], shingles(b)))
        return batch.select(["u", "v"]).filter(pa.array(ok))

    return stored(over_batches(both.select("u", "v", "a", "b"), run, "u long, v long"), "similar")


def copies(docs: DataFrame) -> DataFrame:
    """doc_id, root (the least doc_id reachable over links) of every document that isn't its own root."""
    rows = texts(docs)
    sets, counts = digests(rows)
    least = sets.groupBy("digest").agg(F.min("doc_id").alias("root"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # a set that many texts have meets its root in SALTS places
    salted = least.select("digest", "root", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    same = stored(sets.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"]).where("doc_id != root").select("doc_id", "root"), "same-sets")
    single = rows.join(same.select("doc_id"), "doc_id", "left_anti")
    by_fingerprint = verified(alike(sets.join(same.select("doc_id"), "doc_id", "left_anti").select("doc_id", "fp")), single)
    entry = F.struct("node", "size", "at", F.col("node").alias("root"))
    buckets = stored(prefixes(single, counts).groupBy("shingle").agg(F.collect_list(entry).alias("a")).where(F.size("a") > 1), "buckets")
    by_prefix = verified(pairs(buckets, False).join(by_fingerprint, ["u", "v"], "left_anti"), single)
    first = by_fingerprint.unionByName(by_prefix)
    roots = components(first, "first-components") if first.take(1) else None
    each = buckets.where(F.size("a") > 2).select("shingle", F.inline("a")).withColumnRenamed("root", "own")
    found = each.join(roots, "node", "left") if roots is not None else each.withColumn("root", F.lit(None).cast("long"))
    again = found.groupBy("shingle").agg(F.collect_list(F.struct("node", "size", "at", F.coalesce("root", "own").alias("root"))).alias("a"))
    more = verified(pairs(again, True), single)
    if more.take(1):
        roots = components(first.unionByName(more), "components")
    if roots is None:
        return same
    moved = roots.where("node != root")
    ends = same.join(moved.select(F.col("node").alias("root"), F.col("root").alias("end")), "root", "left").select("doc_id", F.coalesce("end", "root").alias("root"))
    return ends.unionByName(moved.select(F.col("node").alias("doc_id"), "root"))
