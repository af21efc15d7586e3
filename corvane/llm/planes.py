"""Token ids as shuffled planes: blocks of so many fixed-size ids are transposed into byte or bit planes, each plane is
compressed with zstandard, and an index gives every document's place.

A block is self-describing: magic, kind of plane, id size, whether its first document began in an earlier block and its
last one goes on in the next, number of documents and ids, the compressed length of each plane, the planes, then the
compressed index of document lengths, then a crc32 of all before it. A block holds BLOCK_IDS ids (a shard's last one the
rest), so documents may lie in several; memory is bounded by a block and one text. Blocks are written as binary rows of
a Parquet table in the shared folder by Spark's committer, so a lost executor leaves no half file. Shards are ranges of
doc_id: read in order of (shard, block) the documents ascend. Reading takes each block by itself; the checksums of a
document's parts are put together afterwards.

Ids are those of the tokenizers library's encode(text, add_special_tokens=False): the strings of added tokens in a text
become their ids. Null texts are empty and still get the end id; rows that repeat a doc_id are kept, in order of text;
rows without a doc_id and extra columns are left behind.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, freed, over_batches, stored, texts
from .memo import LETTERS, Units, checked, lettered, pre_tokens

BLOCK_IDS = 1 << 18
MAGIC = b"IDP2"
#: Entries of each memo's generation.
KEPT = 400_000
_HEAD = struct.Struct("<4sBBBBIQ")
_SPACE = LETTERS[32]
_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Byte planes (4), or bit planes (32), of little-endian 32-bit ids."""
    columns = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if not bits:
        return [row.tobytes() for row in columns]
    return [np.packbits(row >> bit & 1).tobytes() for row in columns for bit in range(8)]


def from_planes(planes: list[bytes], n: int, bits: bool = False) -> np.ndarray:
    if not bits:
        return np.ascontiguousarray(np.stack([np.frombuffer(x, np.uint8) for x in planes]).T).reshape(-1).view("<u4")[:n] if n else np.zeros(0, "<u4")
    out = np.zeros(n, np.uint32)
    for k, x in enumerate(planes):
        out |= np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(np.uint32) << np.uint32(k)
    return out.astype("<u4")


def pack(lengths: list[int], ids: np.ndarray, bits: bool = False, begun: bool = False, open_end: bool = False) -> bytes:
    press = zstandard.ZstdCompressor(level=1).compress
    planes = [press(x) for x in to_planes(ids, bits)]
    index = press(np.asarray(lengths, "<u8").tobytes())
    body = b"".join([_HEAD.pack(MAGIC, bits, 4, begun, open_end, len(lengths), len(ids)), struct.pack(f"<{len(planes) + 1}I", *map(len, planes), len(index)), *planes, index])
    return body + struct.pack("<I", zlib.crc32(body))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Document lengths and all ids of a block; ValueError if it is damaged."""
    if len(data) < _HEAD.size + 4 or zlib.crc32(memoryview(data)[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("damaged block")
    magic, bits, _, _, _, docs, n = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a block of planes")
    k = 32 if bits else 4
    sizes = struct.unpack_from(f"<{k + 1}I", data, _HEAD.size)
    at, parts, undo = _HEAD.size + 4 * (k + 1), [], zstandard.ZstdDecompressor().decompress
    for size in sizes:
        parts.append(undo(data[at : at + size], max_output_size=1) if size == 0 else undo(data[at : at + size]))
        at += size
    return np.frombuffer(parts[-1], "<u8")[:docs].astype(np.int64), from_planes(parts[:-1], n, bool(bits))


def ends(data: bytes) -> tuple[bool, bool]:
    """Whether a block's first document began earlier, and whether its last one goes on."""
    return bool(data[6]), bool(data[7])


def _zeros(matrix: list[int], crc: int) -> int:
    out, k = 0, 0
    while crc:
        if crc & 1:
            out ^= matrix[k]
        crc, k = crc >> 1, k + 1
    return out


def crc_joined(first: int, second: int, size: int) -> int:
    """crc32 of two byte strings one after another, from their own and the size of the second."""
    one = [0xEDB88320, *(1 << k for k in range(31))]  # a zero bit
    for _ in range(3):
        one = [_zeros(one, x) for x in one]
    while size:
        if size & 1:
            first = _zeros(one, first)
        one, size = [_zeros(one, x) for x in one], size >> 1
    return first ^ second


class LibraryBPE:
    """The tokenizers library: its model is asked once for each pre-token, the whole of it for texts with added tokens."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = checked(pattern)
        self.units = Units(self._units, KEPT)
        self.marks: dict[str, bytes] = {}

    def _units(self, units: list[str]) -> list[bytes]:
        first, later, marks, words, tokenize = self.units.first.new, self.units.later.new, self.marks, self.words, self.model.tokenize
        out: list[bytes] = [b""] * len(units)
        near: dict[str, bytes] = {}  # pieces of this call
        several = []
        for k, unit in enumerate(units):
            body = unit[1:] if unit[0] == " " else unit
            if body.isalpha() and body.isascii():  # one piece, its letters their own but for the space
                ids = [x.id for x in tokenize(body if body is unit else _SPACE + body)]
            else:
                pieces = pre_tokens(unit, words)
                if len(pieces) > 1:
                    several.append((k, pieces))
                    continue
                ids = [x.id for x in tokenize(lettered(unit))]
            out[k] = near[unit] = _PACK[len(ids)](*ids) if len(ids) < 64 else np.array(ids, "<u4").tobytes()
        for k, pieces in several:
            joined = []
            for piece in pieces:  # most have been met by themselves
                found = near.get(piece)
                if found is None:
                    found = later.get(piece[1:]) if piece[0] == " " else first.get(piece)
                if found is None:
                    found = marks.get(piece)
                if found is None:
                    ids = [x.id for x in tokenize(lettered(piece))]
                    found = near[piece] = _PACK[len(ids)](*ids) if len(ids) < 64 else np.array(ids, "<u4").tobytes()
                    if len(piece) < 5 and len(marks) < KEPT:
                        marks[piece] = found
                joined.append(found)
            out[k] = b"".join(joined)
        return out

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        whole = np.zeros(len(texts), bool)
        for content in self.added:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        return self.units.joined(texts, (b"",), whole, self._whole)[0].to_pylist()


@lru_cache(1)
def library(path: str, pattern: str) -> LibraryBPE:
    return LibraryBPE(path, pattern)


def write_planes(docs: DataFrame, tokenizer_path: str, pattern: str, end_id: int = 0, bits: bool = False, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Encode every whole text, append end_id, and write blocks of planes; returns the written table."""
    bounded_batches(docs.sparkSession, 4)  # units are looked up once a batch
    end = struct.pack("<I", end_id)
    names_of = ["shard", "block", "chain", "n_ids", "doc_ids", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, shard, block = library(tokenizer_path, pattern), TaskContext.get().partitionId(), 0
        names: list[int] = []
        held: list[bytes] = []
        n, begun, chain = 0, False, 0  # chain: the block in which the first document began

        def flush(open_end: bool) -> pa.RecordBatch:
            data = pack([len(x) // 4 for x in held], np.frombuffer(b"".join(held), "<u4"), bits, begun, open_end)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([chain if begun else block], pa.int32()), pa.array([n], pa.int64()), pa.array([np.asarray(names, "<i8").tobytes()], pa.binary()), pa.array([data], pa.binary())], names_of)

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), bpe.encode(batch.column(1)), strict=True):
                ids, at = ids + end, 0
                while at < len(ids):
                    part = ids[at : at + 4 * (block_ids - n)]
                    names.append(doc)
                    held.append(part)
                    n, at = n + len(part) // 4, at + len(part)
                    if n == block_ids:
                        yield flush(at < len(ids))
                        chain = chain if begun and len(held) == 1 else block
                        begun, block, n = at < len(ids), block + 1, 0
                        names.clear()
                        held.clear()
        if held:
            yield flush(False)
        freed()

    ranged = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blocks = stored(ranged.mapInArrow(run, "shard int, block int, chain int, n_ids long, doc_ids binary, data binary"), "planes")
    bounded_batches(docs.sparkSession)
    return blocks


def read_planes(blocks: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read back from the blocks."""
    schema = "shard int, block int, chain int, split boolean, doc_id long, within long, n_tokens long, ids_crc32 long"
    names_of = [x.split()[0] for x in schema.split(", ")]
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple] = []
        for shard, block, chain, names, data in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            lengths, ids = unpack(data)
            begun, open_end = ends(data)
            raw, last = memoryview(ids.tobytes()), len(lengths) - 1
            for k, (doc, size, stop) in enumerate(zip(np.frombuffer(names, "<i8").tolist(), lengths.tolist(), np.cumsum(lengths).tolist(), strict=True)):
                early, late = begun and k == 0, open_end and k == last
                rows.append((shard, block, chain if early else block, early or late, doc, stop - size, size, zlib.crc32(raw[4 * (stop - size) : 4 * stop])))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names_of) if rows else None

    def join(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for shard, doc, parts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            n, crc = 0, 0
            for part in parts:
                n, crc = n + part["n_tokens"], crc_joined(crc, part["ids_crc32"], 4 * part["n_tokens"])
            rows.append((shard, parts[0]["block"], doc, parts[0]["within"], n, crc))
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (kinds[0], kinds[1], *kinds[4:]), strict=True)], ["shard", "block", "doc_id", "within", "n_tokens", "ids_crc32"])

    parts = stored(over_batches(blocks.select("shard", "block", "chain", "doc_ids", "data"), run, schema), "parts")
    kept = ("shard", "block", "doc_id", "within", "n_tokens", "ids_crc32")
    # a document in several blocks: a row for each block
    split = parts.where("split").groupBy("shard", "chain", "doc_id").agg(F.array_sort(F.collect_list(F.struct("block", "within", "n_tokens", "ids_crc32"))).alias("parts"))
    joined = over_batches(split.select("shard", "doc_id", "parts"), join, "shard int, block int, doc_id long, within long, n_tokens long, ids_crc32 long")
    rows = parts.where("not split").select(*kept).unionByName(joined)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # one row a shard meets in one task here; documents and blocks do not
    shards = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before_shard"))
    starts = blocks.select("shard", "block", (F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")).alias("before_block")).join(shards, "shard")
    return rows.join(starts, ["shard", "block"]).select("doc_id", (F.col("before_shard") + F.col("before_block") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
