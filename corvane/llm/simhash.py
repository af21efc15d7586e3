"""SimHash near-duplicate groups with bit-sliced comparison.

Candidates share a key, a choice of fingerprint bits. `exact_bands` cuts the bits into m blocks and takes every choice
of m-r of them as a key: two fingerprints within radius r agree on one, so no link is lost. Within a bucket, bit planes
of the fingerprints stand vertically, 64 to a word: carry-save counters add the differing bits of many pairs at once,
and words whose 64 candidates all exceed the radius are abandoned. Large buckets are cut into chunks whose pairs are
spread over tasks. A task returns only a spanning star of what it linked, which loses no connection. Copies share a
fingerprint and are compared once. The pipeline's `keep_one` checks each such link by the similarity of the whole shingle
sets, and finds the similar texts whose fingerprints are farther apart by a prefix filter.

Nulls and texts without words have fingerprint zero, linked like any other; repeated rows are kept; an empty table
gives an empty result; extra columns are left behind (`keep_one` returns docs' own).
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import over_batches, stored, texts
from .components import components

#: Fingerprints in one chunk of a bucket.
CHUNK = 2048
#: Comparisons of one fingerprint with up to 64 others made side by side.
LANES = 1 << 15


def shingle_hashes(text: str, words_in_shingle: int) -> list[int]:
    """XXH64 (seed 42) of each shingle of the text, A-Z in lower case; a shorter text is one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= words_in_shingle:
        return [xxhash.xxh64_intdigest(joined, 42)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-words_in_shingle].tolist()]
    return list(map(xxhash.xxh64_intdigest, [joined[a:b] for a, b in zip(starts, (ends[words_in_shingle - 1 :] - 1).tolist(), strict=True)], repeat(42)))


def fingerprint(hashes: list[int] | np.ndarray, words: int = 1) -> bytes:
    """Bits set in over half the hashes; further words come from the hashes mixed anew."""
    if not len(hashes):
        return bytes(8 * words)
    h = np.array(hashes, np.uint64)
    out = []
    for k in range(words):
        z = h
        if k:
            z = z + np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1)
            z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            z = z ^ z >> np.uint64(31)
        bits = np.unpackbits(z.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        out.append(np.packbits(bits.sum(0, dtype=np.int64) * 2 > len(h)).tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, words_in_shingle: int = 4, words: int = 1) -> DataFrame:
    """doc_id, fp (8 bytes for each word) of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(shingle_hashes(text, words_in_shingle), words) for text in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.binary())], ["doc_id", "fp"])

    return over_batches(texts(docs), run, "doc_id long, fp binary")


def near(fps: np.ndarray, jobs: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of every pair of fingerprints at most `radius` bits apart, over all jobs at once.

    fps: bytes, a row each. jobs: (a, b, c, d), rows a to b are compared with rows c to d; none is empty.
    """
    full, size = ~np.uint64(0), (radius + 1).bit_length()
    bits = np.unpackbits(fps, axis=1).T.copy()
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    lanes = (jobs[:, 1] - jobs[:, 0]) * -(-(jobs[:, 3] - jobs[:, 2]) // 64)
    turns = np.cumsum(lanes) // LANES
    for turn in np.unique(turns).tolist():
        now = jobs[turns == turn]
        wide = now[:, 3] - now[:, 2]
        words = -(-wide // 64)
        first = np.cumsum(words) - words  # the job's first word
        place = np.repeat(first * 64 - np.cumsum(wide) + wide, wide) + np.arange(wide.sum())
        row_at = np.full(int(words.sum()) * 64, -1)
        row_at[place] = np.repeat(now[:, 2] - np.cumsum(wide) + wide, wide) + np.arange(wide.sum())
        filled = row_at >= 0
        upright = np.ascontiguousarray(np.packbits(np.where(filled, bits[:, row_at], 0), axis=1, bitorder="little")).view("<u8")
        none = ~np.packbits(filled, bitorder="little").view("<u8")
        count = now[:, 1] - now[:, 0]
        lane = count * words
        of = np.repeat(np.arange(len(now)), lane)
        inside = np.arange(len(of)) - np.repeat(np.cumsum(lane) - lane, lane)
        q, w = now[of, 0] + inside // words[of], first[of] + inside % words[of]
        counters = [np.zeros(len(q), np.uint64) for _ in range(size)]
        over = none[w]
        for p in range(len(bits)):
            carry = upright[p][w] ^ (np.uint64(0) - bits[p][q].astype(np.uint64))
            for k in range(min(size, (p + 1).bit_length())):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            if p + 1 >= 1 << size:
                over |= carry
            if (p % 8 == 7 and p >= radius) or p == len(bits) - 1:
                equal = ~over
                for k in reversed(range(size)):  # counts above the radius, from the highest bit
                    if radius >> k & 1:
                        equal &= counters[k]
                    else:
                        over |= equal & counters[k]
                        equal &= ~counters[k]
                keep = over != full
                if keep.sum() < 0.9 * len(keep):
                    q, w, over = q[keep], w[keep], over[keep]
                    counters = [c[keep] for c in counters]
                    if not len(q):
                        break
        if len(q):
            lane, bit = np.nonzero(np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            found_a.append(q[lane])
            found_b.append(row_at[w[lane] * 64 + bit])
    return np.concatenate(found_a), np.concatenate(found_b)


def stars(nodes: np.ndarray, fps: np.ndarray, jobs: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each linked node to the least node of its component within the jobs' rows."""
    u, v = near(fps, jobs, radius)
    order = np.argsort(nodes, kind="stable")
    rank = np.empty(len(nodes), np.int64)
    rank[order] = np.arange(len(nodes))
    label = rank.copy()
    while len(u):
        least = np.minimum(label[u], label[v])
        fresh = label.copy()
        np.minimum.at(fresh, u, least)
        np.minimum.at(fresh, v, least)
        fresh = np.minimum(fresh, fresh[order[fresh]])
        if (fresh == label).all():
            break
        label = fresh
    moved = np.flatnonzero(label != rank)
    return nodes[moved], nodes[order[label[moved]]]


def exact_bands(radius: int, n: int, bits: int = 64) -> list[np.ndarray]:
    """Bit positions of keys of which any two fingerprints within the radius share one; wider keys for more of them."""
    blocks = radius + (1 if n <= 1 << 20 else 2 if n <= 1 << 27 else 3)
    edges = [round(bits * k / blocks) for k in range(blocks + 1)]
    single = [np.arange(a, b) for a, b in zip(edges, edges[1:], strict=False)]
    return [np.concatenate(chosen) for chosen in combinations(single, blocks - radius)]


def links(distinct: DataFrame, radius: int, bands: list[np.ndarray], chunk: int = CHUNK) -> DataFrame:
    """(u, v): edges between nodes that connect all fingerprints sharing a band and at most radius bits apart.

    distinct: node, fp; no fingerprint twice.
    """

    def key(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, size = batch.num_rows, len(batch.column(1)[0].as_py())
        bits = np.unpackbits(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(n, size), axis=1).astype(np.int64)
        keys = [bits[:, b] @ (1 << np.arange(len(b), dtype=np.int64)) for b in bands]
        every = pa.array(np.tile(np.arange(n), len(bands)))
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(bands), dtype=np.int32), n)), pa.array(np.concatenate(keys)), batch.column(0).take(every), batch.column(1).take(every)], ["band", "key", "node", "fp"])

    keyed = over_batches(distinct.select("node", "fp"), key, "band int, key long, node long, fp binary")
    large = keyed.groupBy("band", "key").count().where(F.col("count") > chunk).select("band", "key", F.ceil(F.col("count") / chunk).cast("int").alias("parts"))
    large = stored(large, "large")
    some = bool(large.take(1))
    if some:
        keyed = keyed.join(large, ["band", "key"], "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("node"), F.col("parts")), F.lit(0)).cast("int"))
    else:
        keyed = keyed.withColumn("part", F.lit(0))
    chunks = stored(keyed.groupBy("band", "key", "part").agg(F.collect_list(F.struct("node", "fp")).alias("a")), "chunks")
    work = chunks.where(F.size("a") > 1).select("a", F.lit(0).alias("split"))
    if some:
        split = chunks.join(large.select("band", "key"), ["band", "key"], "left_semi")
        right = split.select("band", "key", F.col("part").alias("other"), F.col("a").alias("b"))
        pairs = split.join(right, ["band", "key"]).where("part < other").repartition("band", "key", "part", "other")
        work = work.unionByName(pairs.select(F.concat("a", "b").alias("a"), F.size("a").alias("split")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(0)
        sizes, split = lists.value_lengths().to_numpy(), batch.column(1).to_numpy()
        ends = np.cumsum(sizes)
        starts = ends - sizes
        members = lists.flatten()
        fps = np.frombuffer(b"".join(members.field(1).to_pylist()), np.uint8).reshape(len(members), -1)
        u, v = stars(members.field(0).to_numpy(), fps, np.stack([starts, np.where(split > 0, starts + split, ends), starts + split, ends], 1), radius)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return stored(over_batches(work, run, "u long, v long").distinct(), "links")


def group(docs: DataFrame, words_in_shingle: int = 4, radius: int = 4, words: int = 1) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links) of every document."""
    fps = stored(fingerprints(docs, words_in_shingle, words), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("node")), "fps")
    n = distinct.count()
    edges = links(distinct, radius, exact_bands(radius, n, 64 * words))
    of = distinct.withColumnRenamed("node", "component_id")
    if edges.take(1):
        roots = components(edges, "fp-components")
        of = distinct.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return fps.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without all but the document with the smallest doc_id of each group; rows with a null doc_id stay."""
    from .jaccard import copies

    return docs.join(copies(docs).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
