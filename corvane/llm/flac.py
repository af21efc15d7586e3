"""FLAC media columns: bytes stored losslessly as 8-bit mono samples, read back with checksums verified.

The writer makes one stream for each payload: STREAMINFO, a SEEKTABLE with the sample and byte offset of every frame,
and frames of BLOCK samples with the cheapest of the fixed predictors of order 0 to 2 and a linear predictor of order
ORDER, fitted to the frame, and Rice-coded residuals. The reader takes frames by the seek table, checks CRC-8 and CRC-16
of every frame and the MD5 of the samples, decodes all frames of a batch side by side, and yields PCM blocks with their
sample offsets; `seek` reads from a sample on without decoding what stands before. Streams that others made, with
partitions, other orders, constant or verbatim subframes, go through `decode_stream`, which reads any mono 8-bit stream.

A payload is the UTF-8 text followed by zero bytes up to a positive multiple of 64; null and empty texts are 64 zero
bytes. Equal texts give equal streams. A damaged stream raises ValueError. Rows without a doc_id and extra columns are
left behind; rows that repeat a doc_id are kept.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import over_batches, stored, texts

BLOCK = 4096
#: The fitted predictor: its order, bits of a coefficient, and the right shift of its sum.
ORDER, PRECISION, SHIFT = 4, 12, 8
#: The media table is packed once more, in pages large enough to meet copies of a text.
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(8 << 20), "parquet.block.size": str(32 << 20)}
#: Bytes of payload encoded and decoded side by side.
SLICE = 2 << 20


@lru_cache
def _crc_table(width: int, polynomial: int) -> np.ndarray:
    out = np.arange(256, dtype=np.uint32) << (width - 8)
    for _ in range(8):
        out = np.where(out >> (width - 1) & 1, out << 1 ^ polynomial, out << 1) & ((1 << width) - 1)
    return out


def crc8(data: bytes) -> int:
    table, out = _small_table(), 0
    for b in data:
        out = table[out ^ b]
    return out


@lru_cache
def _small_table() -> list[int]:
    return _crc_table(8, 0x07).tolist()


@lru_cache(4)
def _reach(size: int) -> np.ndarray:
    """What a byte adds to the CRC-16 if `row` bytes follow it."""
    table = _crc_table(16, 0x8005)
    out = np.empty((size, 256), np.uint16)
    out[0] = table
    for k in range(1, size):
        out[k] = (out[k - 1].astype(np.uint32) << 8 & 0xFFFF) ^ table[out[k - 1] >> 8]
    return out.reshape(-1)


def crc16s(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-16 of each range of bytes (none empty), all at once."""
    sizes = ends - starts
    at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    left = np.repeat(ends, sizes) - 1 - at
    table = _reach(-(-int(sizes.max()) // 1024) * 1024)
    return np.bitwise_xor.reduceat(table[left * 256 + data[at]], np.cumsum(sizes) - sizes)


def payload(text: str) -> bytes:
    raw = text.encode("utf-8", "surrogatepass")
    return raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))


def _utf8_number(n: int) -> bytes:
    if n < 0x80:
        return bytes([n])
    tail = []
    limit = 0x3F
    while n > limit:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        limit = 0x1F if limit == 0x3F else limit >> 1
    lead = (0xFF << (7 - len(tail))) & 0xFF
    return bytes([lead | n, *reversed(tail)])


def _frame_header(number: int, samples: int) -> bytes:
    full = samples == BLOCK
    head = bytes([0xFF, 0xF8, 0xC0 if full else 0x70, 0x02]) + _utf8_number(number) + (b"" if full else (samples - 1).to_bytes(2, "big"))
    return head + bytes([crc8(head)])


def encode_many(payloads: list[bytes]) -> list[bytes]:
    """One FLAC stream for each payload of bytes (none empty)."""
    x = np.frombuffer(b"".join(payloads), np.uint8).astype(np.int32) - 128
    sizes = [len(p) for p in payloads]
    frames = [(d, k, min(BLOCK, n - k * BLOCK)) for d, n in enumerate(sizes) for k in range(-(-n // BLOCK))]
    counts = np.array([f[2] for f in frames], np.int64)
    starts = np.cumsum(counts) - counts
    inside = np.arange(len(x)) - np.repeat(starts, counts)
    residuals = [x]
    for order in (1, 2):
        r = residuals[-1].copy()
        r[1:] -= residuals[-1][:-1]
        residuals.append(r)
    fitted = _fit(x, inside, starts, counts)
    guess = np.zeros(len(x), np.int64)
    for j in range(ORDER):
        guess[j + 1 :] += np.repeat(fitted[:, j], counts)[j + 1 :] * x[: -j - 1]
    residuals.append((x - (guess >> SHIFT)).astype(np.int32))
    folded, means = [], []
    for order, r in zip((0, 1, 2, ORDER), residuals, strict=True):
        z = np.where(r < 0, -2 * r - 1, 2 * r)
        z[inside < order] = 0
        folded.append(z)
        means.append(np.add.reduceat(z, starts, dtype=np.float64) / np.maximum(counts - order, 1))
    means = np.stack(means)
    means[1:3, counts < 3] = np.inf
    means[3, counts < 32] = np.inf
    means[3] *= 1.02  # its coefficients take room
    chosen = means.argmin(0)
    order = np.array([0, 1, 2, ORDER])[chosen]
    linear = chosen == 3
    extra = np.where(linear, 9 + ORDER * PRECISION, 0) + 10  # bits between warm-up and codes
    k = np.clip(np.floor(np.log2(np.maximum(means.min(0), 1) * 0.75)), 0, 14).astype(np.int64)
    order_at, k_at = np.repeat(order, counts), np.repeat(k, counts)
    z = np.choose(np.repeat(chosen, counts), folded).astype(np.int64)
    coded = inside >= order_at
    z, k_at = z[coded], k_at[coded]
    lengths = (z >> k_at) + 1 + k_at
    values = ((1 << k_at) | z & ((1 << k_at) - 1)).astype(np.uint64)
    codes = counts - order
    first = np.cumsum(codes) - codes
    bits = extra + np.add.reduceat(lengths, first)
    heads = [_frame_header(number, n) for _, number, n in frames]
    body = np.array([len(h) for h in heads]) + 1 + order  # whole bytes before the residual section
    frame_bytes = body + -(-bits // 8) + 2
    per_doc = np.bincount([f[0] for f in frames], minlength=len(sizes))
    fronts = 42 + 4 + 18 * per_doc
    doc_of = np.array([f[0] for f in frames])
    doc_bytes = fronts + np.bincount(doc_of, frame_bytes, len(sizes)).astype(np.int64)
    doc_at = np.cumsum(doc_bytes) - doc_bytes
    new = np.concatenate([[True], doc_of[1:] != doc_of[:-1]])
    running = np.cumsum(frame_bytes) - frame_bytes
    offset = running - np.repeat(running[new], per_doc)  # from the first frame of the stream
    at = doc_at[doc_of] + fronts[doc_of] + offset
    ends = np.repeat((at + body) * 8 + extra - (np.cumsum(lengths)[first] - lengths[first]), codes) + np.cumsum(lengths)
    words = np.zeros(int(doc_bytes.sum()) // 8 + 2, np.uint64)
    word, shift = (ends - 1) >> 6, (63 - ((ends - 1) & 63)).astype(np.uint64)
    lead = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    words[word[lead]] = np.add.reduceat(values << shift, lead)
    over = np.where(shift > 0, values >> (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
    cross = np.flatnonzero(over)
    words[word[cross] - 1] |= over[cross]
    out = words.astype(">u8").view(np.uint8)[: int(doc_bytes.sum())].copy()
    for f, (head, a, b) in enumerate(zip(heads, at.tolist(), body.tolist(), strict=True)):
        warm = x[starts[f] : starts[f] + order[f]].astype(np.int8).tobytes()
        kind = 31 + ORDER if linear[f] else 8 + int(order[f])
        out[a : a + b] = np.frombuffer(head + bytes([kind << 1]) + warm, np.uint8)
        front, n = int(k[f]), int(extra[f])  # residual section: method 00, partition order 0000, then the parameter
        if linear[f]:
            front |= (PRECISION - 1) << n - 4 | SHIFT << n - 9
            for j, c in enumerate(fitted[f].tolist()):
                front |= (c & (1 << PRECISION) - 1) << n - 9 - PRECISION * (j + 1)
        size = -(-n // 8)
        out[a + b : a + b + size] |= np.frombuffer((front << 8 * size - n).to_bytes(size, "big"), np.uint8)
    stops = at + frame_bytes - 2
    sums = crc16s(out, at, stops)
    out[stops], out[stops + 1] = sums >> 8, sums & 0xFF
    f = 0
    for d, data in enumerate(payloads):
        n = len(data)
        mine = frame_bytes[f : f + per_doc[d]]
        signed = (np.frombuffer(data, np.uint8) ^ 128).tobytes()
        info = BLOCK.to_bytes(2, "big") * 2 + int(mine.min()).to_bytes(3, "big") + int(mine.max()).to_bytes(3, "big") + (8000 << 44 | 0 << 41 | 7 << 36 | n).to_bytes(8, "big") + hashlib.md5(signed).digest()
        seek = np.empty((per_doc[d], 18), np.uint8)
        seek[:, :8] = (np.arange(per_doc[d]) * BLOCK).astype(">u8").view(np.uint8).reshape(-1, 8)
        seek[:, 8:16] = offset[f : f + per_doc[d]].astype(">u8").view(np.uint8).reshape(-1, 8)
        seek[:, 16:] = counts[f : f + per_doc[d]].astype(">u2").view(np.uint8).reshape(-1, 2)
        front = b"fLaC\x00" + (34).to_bytes(3, "big") + info + b"\x83" + (18 * int(per_doc[d])).to_bytes(3, "big") + seek.tobytes()
        out[doc_at[d] : doc_at[d] + fronts[d]] = np.frombuffer(front, np.uint8)
        f += per_doc[d]
    whole = out.tobytes()
    return [whole[a : a + n] for a, n in zip(doc_at.tolist(), doc_bytes.tolist(), strict=True)]


def _fit(x: np.ndarray, inside: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Quantised coefficients of each frame's linear predictor, from its autocorrelation by Levinson and Durbin."""
    wide = x.astype(np.float64)
    r = []
    for lag in range(ORDER + 1):
        product = wide.copy()
        product[lag:] *= wide[: len(wide) - lag]
        if lag:
            product[inside < lag] = 0
        r.append(np.add.reduceat(product, starts))
    a, error = np.zeros((len(counts), ORDER)), r[0] * (1 + 1e-9) + 1e-9
    for i in range(ORDER):
        turn = (r[i + 1] - sum((a[:, j] * r[i - j] for j in range(i)), np.zeros(len(counts)))) / error
        before = a.copy()
        for j in range(i):
            a[:, j] = before[:, j] - turn * before[:, i - 1 - j]
        a[:, i] = turn
        error = np.maximum(error * (1 - turn * turn), 1e-9)
    most = (1 << PRECISION - 1) - 1
    return np.clip(np.rint(a * (1 << SHIFT)), -most, most).astype(np.int64)


def _fronts(stream: bytes) -> tuple[bytes, bytes, int]:
    """STREAMINFO, SEEKTABLE (may be empty) and where the frames begin."""
    if stream[:4] != b"fLaC":
        raise ValueError("not a FLAC stream")
    at, info, seek, last = 4, b"", b"", False
    while not last:
        kind, size = stream[at], int.from_bytes(stream[at + 1 : at + 4], "big")
        last, kind = kind >> 7, kind & 127
        info, seek = (stream[at + 4 : at + 4 + size] if kind == 0 else info), (stream[at + 4 : at + 4 + size] if kind == 3 else seek)
        at += 4 + size
    if len(info) != 34:
        raise ValueError("no STREAMINFO")
    return info, seek, at


def decode_many(streams: list[bytes]) -> list[bytes]:
    """Payload bytes of streams as encode_many writes them, all checksums verified."""
    data = np.frombuffer(b"".join(streams) + bytes(16), np.uint8)
    base, starts, stops, counts, owners, totals, digests = 0, [], [], [], [], [], []
    for d, stream in enumerate(streams):
        info, seek, front = _fronts(stream)
        points = np.frombuffer(seek, np.uint8).reshape(-1, 18)
        offsets = np.ascontiguousarray(points[:, 8:16]).view(">u8").reshape(-1).astype(np.int64) + base + front
        starts.append(offsets)
        stops.append(np.append(offsets[1:], base + len(stream)))
        counts.append(np.ascontiguousarray(points[:, 16:]).view(">u2").reshape(-1).astype(np.int64))
        owners.append(len(points))
        totals.append(int.from_bytes(info[10:18], "big") & (1 << 36) - 1)
        digests.append(info[18:])
        base += len(stream)
    starts, stops, counts = np.concatenate(starts), np.concatenate(stops), np.concatenate(counts)
    if ((crc16s(data, starts, stops - 2) >> 8 != data[stops - 2]) | (crc16s(data, starts, stops - 2) & 0xFF != data[stops - 1])).any():
        raise ValueError("CRC-16 of a frame differs")
    body, order, lead, k = (np.empty(len(starts), np.int64) for _ in range(4))
    weights = np.zeros((len(starts), ORDER), np.int64)
    for f, (a, n) in enumerate(zip(starts.tolist(), counts.tolist(), strict=True)):
        first = int(data[a + 4])
        size = 4 + (1 if first < 128 else 8 - (~first & 0xFF).bit_length()) + (0 if data[a + 2] == 0xC0 else 2)
        if crc8(data[a : a + size].tobytes()) != data[a + size]:
            raise ValueError("CRC-8 of a frame differs")
        kind, at = int(data[a + size + 1]) >> 1, a + size + 2
        if 8 <= kind <= 10:
            body[f], order[f], lead[f] = at + kind - 8, kind - 8, 10
            front = int.from_bytes(data[body[f] : body[f] + 2].tobytes(), "big") >> 6
        elif kind == 31 + ORDER:
            body[f], order[f], lead[f] = at + ORDER, ORDER, 19 + ORDER * PRECISION
            room = -(-int(lead[f]) // 8)
            front = int.from_bytes(data[body[f] : body[f] + room].tobytes(), "big") >> 8 * room - int(lead[f])
            top = front >> int(lead[f]) - 9
            if top != (PRECISION - 1) << 5 | SHIFT:
                raise ValueError("a predictor of another form; use decode_stream")
            for j in range(ORDER):
                c = front >> int(lead[f]) - 9 - PRECISION * (j + 1) & (1 << PRECISION) - 1
                weights[f, j] = c - (c >> PRECISION - 1 << PRECISION)
        else:
            raise ValueError("a subframe of another kind; use decode_stream")
        if front >> 4 & 63:
            raise ValueError("residuals of another form; use decode_stream")
        k[f] = front & 15
    wide = np.zeros(len(data), np.uint64)
    for shift in range(8):
        wide[: len(data) - shift] |= data[shift:].astype(np.uint64) << np.uint64(56 - 8 * shift)
    by_size = np.argsort(-counts, kind="stable")
    longest = int(counts.max())
    grid = np.zeros((longest, len(counts)), np.int32)
    p, kk = (body * 8 + lead)[by_size], k[by_size]
    todo = (counts - order)[by_size]
    todo_order = np.argsort(-todo, kind="stable")
    by_size, p, kk, todo = by_size[todo_order], p[todo_order], kk[todo_order], todo[todo_order]
    shift_k, low = np.uint64(64) - kk.astype(np.uint64), kk > 0
    actives = np.searchsorted(-todo, -np.arange(longest), side="left")
    for step in range(int(todo[0])):
        n = int(actives[step])
        at, w, = p[:n], wide[p[:n] >> 3] << (p[:n] & 7).astype(np.uint64)
        zeros = 53 - np.frexp((w >> np.uint64(11)).astype(np.float64))[1].astype(np.int64)
        short = (zeros >= 53) | (zeros + 1 + kk[:n] > 56)
        rest = (w << (zeros + 1).astype(np.uint64)) >> shift_k[:n]
        value = (zeros << kk[:n]) | np.where(low[:n], rest, 0).astype(np.int64)
        if short.any():
            for i in np.flatnonzero(short):
                value[i], zeros[i] = _slow(data, int(at[i]), int(kk[i]))
        grid[step, :n] = (value >> 1) ^ -(value & 1)
        p[:n] = at + zeros + 1 + kk[:n]
    out = np.empty((len(counts), longest), np.int32)
    out[by_size] = grid.T
    flat = np.empty(int(counts.sum()), np.uint8)
    ends = np.cumsum(counts)
    for f in np.flatnonzero(order < ORDER).tolist():  # a frame at a time: sums of different orders
        n, o = int(counts[f]), int(order[f])
        r = out[f, : n - o]
        if o:
            warm = data[body[f] - o : body[f]].view(np.int8).astype(np.int32)
            seeds = [np.diff(warm, j)[-1] for j in range(o)]
            for j in reversed(range(o)):
                r = np.cumsum(np.concatenate([[seeds[j]], r]))[1:] if j else np.concatenate([warm, np.cumsum(np.concatenate([[seeds[0]], r]))[1:]])
        flat[ends[f] - n : ends[f]] = (r + 128).astype(np.uint8)
    fitted = np.flatnonzero(order == ORDER)
    if len(fitted):  # a sample at a time of all such frames, the longest first
        fitted = fitted[np.argsort(-counts[fitted], kind="stable")]
        n, w = counts[fitted], weights[fitted]
        pcm = np.zeros((int(n[0]), len(fitted)), np.int64)
        for j in range(ORDER):
            pcm[j] = data[body[fitted] - ORDER + j].view(np.int8)
        residual = np.ascontiguousarray(out[fitted].T).astype(np.int64)
        going = np.searchsorted(-n, -np.arange(int(n[0])), side="left")
        columns = [np.ascontiguousarray(w[:, j]) for j in range(ORDER)]
        for t in range(ORDER, int(n[0])):
            m = int(going[t])
            total = columns[0][:m] * pcm[t - 1, :m]
            for j in range(1, ORDER):
                total += columns[j][:m] * pcm[t - 1 - j, :m]
            pcm[t, :m] = residual[t - ORDER, :m] + (total >> SHIFT)
        samples = (pcm.T + 128).astype(np.uint8)
        for row, f in enumerate(fitted.tolist()):
            flat[ends[f] - counts[f] : ends[f]] = samples[row, : counts[f]]
    whole, result, a = flat.tobytes(), [], 0
    for n, digest in zip(totals, digests, strict=True):
        part = whole[a : a + n]
        if len(part) != n or hashlib.md5((np.frombuffer(part, np.uint8) ^ 128).tobytes()).digest() != digest:
            raise ValueError("MD5 of a stream differs")
        result.append(part)
        a += n
    return result


def _slow(data: np.ndarray, at: int, k: int) -> tuple[int, int]:
    zeros = 0
    while not data[at + zeros >> 3] >> (7 - (at + zeros & 7)) & 1:
        zeros += 1
    low = 0
    for i in range(at + zeros + 1, at + zeros + 1 + k):
        low = low << 1 | int(data[i >> 3]) >> (7 - (i & 7)) & 1
    return zeros << k | low, zeros


class _Bits:
    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at * 8

    def take(self, n: int) -> int:
        a, b = self.at >> 3, self.at + n + 7 >> 3
        if b > len(self.data):
            raise ValueError("the stream ends early")
        out = int.from_bytes(self.data[a:b], "big") >> (b * 8 - self.at - n) & (1 << n) - 1
        self.at += n
        return out

    def signed(self, n: int) -> int:
        x = self.take(n)
        return x - (1 << n) if n and x >> n - 1 else x

    def unary(self) -> int:
        n = 0
        while not self.take(1):
            n += 1
        return n


#: Coefficients of the fixed predictors of order 0 to 4, and the block sizes that a code names; fixed by the format.
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))
BLOCK_SIZES = {1: 192, 2: 576, 3: 1152, 4: 2304, 5: 4608} | {8 + n: 256 << n for n in range(8)}


def _frame(stream: bytes, at: int) -> tuple[bytes, int]:
    """Samples of the frame that begins at a byte, and where the next one begins; checksums verified."""
    bits = _Bits(stream, at)
    if bits.take(14) != 0x3FFE:
        raise ValueError("a frame is missing")
    bits.take(2)
    size_code, rate_code = bits.take(4), bits.take(4)
    if bits.take(4) != 0:
        raise ValueError("more than one channel")
    bits.take(4)
    lead = bits.take(8)
    for _ in range(0 if lead < 128 else 7 - (~lead & 0xFF).bit_length()):
        bits.take(8)
    n = bits.take(8 * (size_code - 5)) + 1 if size_code in (6, 7) else BLOCK_SIZES[size_code]
    bits.take({12: 8, 13: 16, 14: 16}.get(rate_code, 0))
    if crc8(stream[at : bits.at >> 3]) != bits.take(8):
        raise ValueError("CRC-8 of a frame differs")
    block = _subframe(bits, n)
    bits.at = bits.at + 7 & ~7
    stop = bits.at >> 3
    if int(crc16s(np.frombuffer(stream, np.uint8), np.array([at]), np.array([stop]))[0]) != bits.take(16):
        raise ValueError("CRC-16 of a frame differs")
    return np.array(block, np.int8).tobytes(), stop + 2


def decode_stream(stream: bytes):
    """(sample offset, PCM block) of each frame of any mono 8-bit stream, in order; checksums verified."""
    info, _, at = _fronts(stream)
    total, done, seen = int.from_bytes(info[10:18], "big") & (1 << 36) - 1, 0, hashlib.md5()
    while done < total:
        pcm, at = _frame(stream, at)
        seen.update(pcm)
        yield done, pcm
        done += len(pcm)
    if any(info[18:]) and seen.digest() != info[18:]:
        raise ValueError("MD5 of a stream differs")


def _subframe(bits: _Bits, n: int) -> list[int]:
    bits.take(1)
    kind, wasted = bits.take(6), bits.take(1)
    wasted = bits.unary() + 1 if wasted else 0
    depth = 8 - wasted
    if kind == 0:
        out = [bits.signed(depth)] * n
    elif kind == 1:
        out = [bits.signed(depth) for _ in range(n)]
    else:
        order = kind - 31 if kind >= 32 else kind - 8
        out = [bits.signed(depth) for _ in range(order)]
        if kind >= 32:
            precision, shift = bits.take(4) + 1, bits.signed(5)
            weights = [bits.signed(precision) for _ in range(order)]
        else:
            weights, shift = FIXED[order], 0
        wide, parts = 4 + bits.take(2), bits.take(4)
        for part in range(1 << parts):
            k = bits.take(wide)
            raw = bits.take(5) if k == (1 << wide) - 1 else None
            for _ in range((n >> parts) - (order if part == 0 else 0)):
                if raw is None:
                    z = bits.unary() << k
                    z |= bits.take(k)
                    r = z >> 1 ^ -(z & 1)
                else:
                    r = bits.signed(raw)
                out.append(r + (sum(w * out[-1 - j] for j, w in enumerate(weights)) >> shift))
    return [x << wasted for x in out]


def feature(pcm: bytes) -> str:
    """Integer statistics of the samples: count, sum, energy, peak, crossings of zero, sum of steps."""
    x = np.frombuffer(pcm, np.uint8).astype(np.int64) - 128
    steps = np.abs(np.diff(x))
    return f"n={len(x)};sum={int(x.sum())};energy={int((x * x).sum())};peak={int(np.abs(x).max())};cross={int(((x[1:] >= 0) != (x[:-1] >= 0)).sum())};steps={int(steps.sum())}"


def slices(items: list[bytes]) -> list[tuple[int, int]]:
    """Ranges of items of about SLICE bytes."""
    out, a, n = [], 0, 0
    for i, x in enumerate(items):
        n += len(x)
        if n >= SLICE:
            out.append((a, i + 1))
            a, n = i + 1, 0
    return out + ([(a, len(items))] if a < len(items) else [])


def store(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: the FLAC stream of every whole text, written to the shared folder."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column(1).to_pylist()
        payloads = [payload(t) for t in raw]
        media = [m for a, b in slices(payloads) for m in encode_many(payloads[a:b])]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in raw], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return stored(over_batches(texts(docs), run, "doc_id long, n_bytes long, media binary"), "media", **PACKED)


def blocks_of(streams: list[bytes]) -> list[list[tuple[int, bytes]]]:
    """(sample offset, unsigned PCM) blocks of each stream, in order."""
    return [[(at, p[at : at + BLOCK]) for at in range(0, len(p), BLOCK)] for a, b in slices(streams) for p in decode_many(streams[a:b])]


def seek(stream: bytes, sample: int) -> tuple[int, bytes]:
    """(sample offset, unsigned PCM) of the frame that holds a sample, found by the seek table; its checksums verified."""
    _, table, front = _fronts(stream)
    points = [(int.from_bytes(table[k : k + 8], "big"), int.from_bytes(table[k + 8 : k + 16], "big"), int.from_bytes(table[k + 16 : k + 18], "big")) for k in range(0, len(table), 18)]
    found = max((p for p in points if p[0] <= sample), default=None)
    if found is None or sample >= found[0] + found[2]:
        raise ValueError("no such sample")
    return found[0], bytes(b ^ 128 for b in _frame(stream, front + found[1])[0])


def read_back(media: DataFrame) -> DataFrame:
    """The stored streams decoded to PCM blocks: digests of payload and media, and a feature of the samples."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        streams = batch.column(2).to_pylist()
        pcm = [b"".join([block for _, block in blocks]) for blocks in blocks_of(streams)]
        columns = [
            batch.column(0), batch.column(1), pa.array([len(p) for p in pcm], pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in pcm]),
            pa.array([zlib.crc32(p[-64:]) for p in pcm], pa.int64()), pa.array([len(m) for m in streams], pa.int64()), pa.array([hashlib.sha256(m).hexdigest() for m in streams]), pa.array([feature(p) for p in pcm]),
        ]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    return over_batches(media.select("doc_id", "n_bytes", "media"), run, schema)


def pcm_blocks(media: DataFrame) -> DataFrame:
    """doc_id, sample_offset, pcm: seekable blocks of unsigned samples."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(doc, at, pcm) for doc, blocks in zip(batch.column(0).to_pylist(), blocks_of(batch.column(1).to_pylist()), strict=True) for at, pcm in blocks]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["doc_id", "sample_offset", "pcm"])

    return over_batches(media.select("doc_id", "media"), run, "doc_id long, sample_offset long, pcm binary")
