"""Byte-level BPE encoding and decoding through a sentencepiece model serialised straight from a rank file.

Each byte of a token becomes its printable letter, the piece's score is the negative rank, and the normaliser is the
identity, so sentencepiece merges in the order of the ranks. Texts are cut into pre-tokens first; ids map back to
bytes by the inverse letters. Nulls are empty texts (no ids); equal texts, equal ids; extra columns are left behind.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import over_batches, texts
from .memo import LETTERS, Units, checked, lettered, pre_tokens

#: Written in front of the vocabulary; sentencepiece asks for one unknown piece.
UNKNOWN = "⁇unknown"
#: Entries of each memo's generation; memos are emptied when a task ends, as the worker may serve another stage next.
KEPT = 150_000
_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    out = [b""] * len(pairs)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto: pieces of normal type scored by negative rank after one unknown piece."""
    letters = ["".join(LETTERS[b] for b in token) for token in tokens]
    pieces = [_block(1, _block(1, UNKNOWN.encode()) + b"\x15" + struct.pack("<f", 0.0) + _number(3, 2))]
    pieces += [_block(1, _block(1, x.encode()) + b"\x15" + struct.pack("<f", -float(rank))) for rank, x in enumerate(letters)]
    trainer = _number(3, 2) + _number(4, len(tokens) + 1) + _number(40, 0) + b"".join(_number(field, -1) for field in (41, 42, 43)) + _block(45, UNKNOWN.encode())
    normalizer = _block(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return b"".join(pieces) + _block(2, trainer) + _block(3, normalizer)


class ByteBPE:
    """Encodes texts to ids and ids to bytes, as the rank file says."""

    def __init__(self, rank_path: str, pattern: str):
        import sentencepiece

        self.tokens = read_ranks(rank_path)
        self.rank = {token: rank for rank, token in enumerate(self.tokens)}
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.tokens))
        self.words = checked(pattern)
        self.decimals = [str(k).encode() for k in range(len(self.tokens))]
        self.units = Units(self._units, KEPT)
        inverse = {letter: b for b, letter in enumerate(LETTERS)}
        back = [bytes(inverse[c] for c in self.processor.id_to_piece(i + 1)) for i in range(len(self.tokens))]
        self.lengths = np.array([len(x) for x in back], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.flat = np.frombuffer(b"".join(back), np.uint8)

    def _units(self, units: list[str]) -> list[tuple[bytes, bytes]]:
        """A word that is a token is its rank; all others go through the model at once."""
        words = [pre_tokens(unit, self.words) for unit in units]
        flat = [w for ws in words for w in ws]
        whole = [self.rank.get(word.encode()) for word in flat]
        coded = iter(self.processor.encode([lettered(word) for word, rank in zip(flat, whole, strict=True) if rank is None], num_threads=1))
        known, decimals, out = iter(whole), self.decimals, []
        for ws in words:
            ids: list[int] = []
            for _ in ws:
                rank = next(known)
                if rank is None:
                    ids += [i - 1 for i in next(coded)]
                else:
                    ids.append(rank)
            out.append((_PACK[len(ids)](*ids) if len(ids) < 64 else np.array(ids, "<u4").tobytes(), b" ".join([decimals[i] for i in ids])))
        return out

    def forget(self) -> None:
        self.units.forget()

    def encode(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Of each text its ids as little-endian 32-bit integers, and as decimals joined by a space."""
        ids, shown = self.units.joined(texts, (b"", b" "))
        return ids, shown

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of all ids, and the end of each id's bytes."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids):
            return b"", ends
        at = np.repeat(self.offsets[ids] - ends + lengths, lengths)
        at += np.arange(len(at))
        return self.flat[at].tobytes(), ends


@lru_cache(1)
def codec(rank_path: str, pattern: str) -> ByteBPE:
    """One codec for each worker process."""
    return ByteBPE(rank_path, pattern)


def _coded(bpe: ByteBPE, texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray, list[bytes]]:
    """Ids, their decimals, their number, and the decoded bytes of each text."""
    ids, shown = bpe.encode(texts)
    sizes = pc.binary_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    every, ends = bpe.decode(np.frombuffer(b"".join(ids.to_pylist()), "<u4"))
    stops = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])].tolist()
    return ids, shown, sizes, [every[a:b] for a, b in zip(stops, stops[1:], strict=False)]


def encode_decode(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, ids (little-endian 32-bit), ids_text (decimals), decoded (bytes) of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, shown, _, decoded = _coded(codec(rank_path, pattern), batch.column(1))
        return pa.RecordBatch.from_arrays([batch.column(0), ids, shown.cast(pa.string()), pa.array(decoded, pa.binary())], ["doc_id", "ids", "ids_text", "decoded"])

    return over_batches(texts(docs), run, "doc_id long, ids binary, ids_text string, decoded binary", lambda: codec(rank_path, pattern).forget())


def digests(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """As encode_decode, but hashed where the ids are made: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, shown, sizes, decoded = _coded(codec(rank_path, pattern), batch.column(1))
        sha = [hashlib.sha256(x).hexdigest() for x in shown.to_pylist()]
        back = [hashlib.sha256(x).hexdigest() for x in decoded]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(sha), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return over_batches(texts(docs), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", lambda: codec(rank_path, pattern).forget())
