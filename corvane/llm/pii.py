"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions, trained in numpy.

Base spans (email, ip, card, phone) come from linear scans that find what the patterns in the docstrings match,
leftmost and non-overlapping, each kind by itself. The tagger is trained from labelled spans that `examples` makes
from templates: the four kinds in many spellings (letters of any alphabet, "at" and "dot" in words, dots in brackets,
numbers grouped in many ways) among words, versions, dates, keys and plain numbers. It reads windows of WINDOW
characters that overlap by half; those that hold a digit, an at sign, a plus, or the word dot or at in brackets are
read, since every spelling it learns holds one. The emissions of overlapping windows are blended by distance from their
middles, and each run of windows is decoded once as a whole under the transitions. A span is added if its characters
are surer on average than SURE, it makes sense for its kind (an at, four numbers up to 255, digits that pass Luhn, 9 to
15 digits), and it touches no base span.

Null and empty texts have no spans; repeated rows are kept; extra columns are left behind by `find` and kept by
`redact`, whose null texts stay null and whose rows without a doc_id stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, freed, over_batches, texts

KINDS = ("email", "ip", "card", "phone")
WINDOW = 64
HIDDEN = 20
#: Mean difference of the emissions of a span's tags and of no span, at least.
SURE = 1.0
#: Windows decoded side by side; one text's stay together.
TOGETHER = 4096
SYMBOLS = 98  # printable ASCII, white space, other letters, the rest
TAGS = 9  # outside, and first and further characters of each kind

Span = tuple[int, int, int]  # kind, start, end

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@+]|\bdot\b|[(\[]at[)\]]", re.I)
_AT = re.compile(r"@|\bat\b", re.I)
_NUMBERS = re.compile(r"[0-9]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def valid(kind: int, text: str) -> bool:
    """Whether a match of the kind's pattern is kept."""
    if kind == 0:
        return "@" in text
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    n = len(_digits(text))
    return 13 <= n <= 19 and luhn(_digits(text)) if kind == 2 else 9 <= n <= 15


def emails(text: str) -> list[tuple[int, int]]:
    """`[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from each at sign outwards."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            done = found.end()
        else:
            done = max(done, at)
        at = text.find("@", at + 1)
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    """`[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)`: each four parts of a dotted chain."""
    out = []
    for chain in _CHAIN.finditer(text):
        if chain[0].count(".") >= 3:
            parts, at = chain[0].split("."), chain.start()
            ends = (np.cumsum([len(p) + 1 for p in parts]) + at - 1).tolist()
            out += [(at if k == 0 else ends[k - 1] + 1, ends[k + 3]) for k in range(0, len(parts) - 3, 4)]
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, by kind, then start."""
    if not _TRIGGER.search(text):
        return []
    found = [emails(text), addresses(text), [m.span() for m in _CARD.finditer(text)], [m.span() for m in _PHONE.finditer(text)]]
    return [(kind, a, b) for kind, spans in enumerate(found) for a, b in spans if valid(kind, text[a:b])]


def _symbol_table() -> np.ndarray:
    out = np.full(256, 97)
    out[32:127] = np.arange(95)
    out[[9, 10, 11, 12, 13]] = 95
    out[[c for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]] = 96
    return out


_SYMBOLS = _symbol_table()


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(codes < 256, _SYMBOLS[np.minimum(codes, 255)], 96)


# training spans


def _spelling(kind: int, rng: np.random.Generator, word) -> str:
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    odd = rng.random() < 0.35
    if kind == 0:
        local = str(rng.choice(["{a}", "{a}.{b}", "{a}.{n}", "{a}_{b}", "{a}{n}", "{a}+{b}"])).format(a=word(odd), b=word(odd), n=d(2))
        at, dot = [("@", "."), (" at ", " dot "), ("(at)", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), (" at ", " dot ")][rng.integers(0, 6)] if odd else ("@", ".")
        if at == " at ":  # names of one word only, else the words before would be drawn in
            local = word(False)
        return local + at + dot.join([word(odd) + (d(1) if rng.random() < 0.3 else ""), *([word(False)] if rng.random() < 0.5 else []), str(rng.choice(["com", "org", "net", "de", "fr", "es", "io", "edu"]))])
    if kind == 1:
        return (str(rng.choice(["[.]", "(.)", " . "])) if odd else ".").join(str(x) for x in rng.integers(0, 256, 4))
    if kind == 2:
        n = int(rng.choice([13, 15, 16, 16, 16, 19]))
        body = str(rng.choice(["4", "5", "3", "6"])) + d(n - 2)
        digits = next(body + str(c) for c in range(10) if luhn(body + str(c)))
        gap = str(rng.choice([".", "/", "  ", "_"])) if odd else str(rng.choice(["", "", " ", "-"]))
        return gap.join(digits[i : i + 4] for i in range(0, n, 4))
    form = str(rng.choice(["+1 (AAA) AAA-AAAA", "+AA AAA AAAAAAA", "+AA (A) AAA AAAAAA", "(AAA) AAA-AAAA", "AAA-AAA-AAAA", "+AA.AAA.AAA.AAAA", "+AAAAAAAAAAA", "AAA.AAA.AAAA", "(0AA) AAAAAAAA", "0AA / AAAAAAA", "00AA AAA AAA AAA", "(AAA)AAA-AAAA"]))
    return re.sub("A", lambda _: d(1), form)


def _other(rng: np.random.Generator, word) -> str:
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    forms = (
        lambda: d(int(rng.integers(1, 13))), lambda: f"{d(1)}.{d(1)}", lambda: f"{d(1)}.{d(1)}.{d(1)}", lambda: f"20{d(2)}-{d(2)}-{d(2)}", lambda: f'"{rng.integers(0, 2**62):x}"', lambda: f"{d(2)}:{d(2)}",
        lambda: f"{word()}{d(3)}{word().upper()}{d(2)}", lambda: f"@{word()} + {word()}={d(2)}", lambda: f"{word()} at {word()}", lambda: f"{word()} dot {word()}", lambda: f"{word()} at {word()} dot {word()}", lambda: f"{d(3)},{d(3)},{d(3)}", lambda: f"{d(2)}/{d(2)}/20{d(2)}", lambda: f"${d(4)}.{d(2)}",
    )
    return forms[rng.integers(0, len(forms))]()


def examples(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of n labelled windows."""
    rng = np.random.default_rng(seed)
    letters = list("etaoinshrdlucmfgéñüçßó")

    def word() -> str:
        return "".join(rng.choice(letters, int(rng.integers(2, 9))))

    x, y = np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), np.int64)
    for row in range(n):
        text, tags = "", []
        while len(text) < 2 * WINDOW:
            kind = int(rng.integers(0, 4)) if rng.random() < 0.3 else -1
            piece = _spelling(kind, rng, lambda odd: "".join(rng.choice(letters if odd else letters[:14], int(rng.integers(2, 8))))) if kind >= 0 else _other(rng, word) if rng.random() < 0.25 else word()
            tags += [2 * kind + 1, *[2 * kind + 2] * (len(piece) - 1)] if kind >= 0 else [0] * len(piece)
            gap = str(rng.choice([" ", " ", " ", ", ", ".\n", ". "]))
            text, tags = text + piece + gap, tags + [0] * len(gap)
        at = int(rng.integers(0, WINDOW))
        x[row], y[row] = symbols(text)[at : at + WINDOW], tags[at : at + WINDOW]
    return x, y


# the network


@dataclass
class Tagger:
    """table: symbol to the four gates' inputs; turn: hidden to gates, by direction; out, bias: to tags; moves: CRF."""

    table: np.ndarray
    turn: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    moves: np.ndarray

    def run(self, x: np.ndarray, way: int, keep: bool = False):
        """Hidden states (time, window, HIDDEN) of one direction, with what the gradient needs."""
        n, size = x.shape
        h, c, out, kept = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32), np.zeros((size, n, HIDDEN), np.float32), []
        for t in range(size) if way == 0 else range(size - 1, -1, -1):
            z = self.table[way][x[:, t]] + h @ self.turn[way]
            z[:, : 3 * HIDDEN] *= 0.5
            z = np.tanh(z)
            z[:, : 3 * HIDDEN] = z[:, : 3 * HIDDEN] * 0.5 + 0.5
            i, f, o, g = (z[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
            before, held = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep:
                kept.append((t, before, held, i, f, o, g, tc))
        return out, kept

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(time, window, tag)."""
        return np.concatenate([self.run(x, 0)[0], self.run(x, 1)[0]], 2) @ self.out + self.bias

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tags (window, time) of windows by themselves."""
        e = self.emissions(x).transpose(1, 0, 2)
        return best_path(np.ascontiguousarray(e).reshape(-1, TAGS), np.full(len(x), x.shape[1]), self.moves).reshape(x.shape)


def _crf(e: np.ndarray, moves: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the negative log likelihood to emissions and transitions."""
    size, n, _ = e.shape
    lse = lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
    alpha, beta = e.copy(), np.zeros_like(e)
    for t in range(1, size):
        alpha[t] += lse(alpha[t - 1][:, :, None] + moves, 1)
    for t in range(size - 2, -1, -1):
        beta[t] = lse(moves[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    total = lse(alpha[-1], 1)
    de = np.exp(alpha + beta - total[None, :, None])
    dm = np.exp(alpha[:-1, :, :, None] + moves + (e[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None]).sum((0, 1))
    rows = np.arange(n)
    for t in range(size):
        de[t, rows, y[:, t]] -= 1
    np.subtract.at(dm, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    return de / n, dm / n


@lru_cache(2)
def train(steps: int = 500, batch: int = 48, rate: float = 0.02, seed: int = 7) -> Tagger:
    """Adam on windows of `examples`; the same tagger every time."""
    rng = np.random.default_rng(seed)
    x, y = examples(min(6000, steps * batch), seed)
    g = 4 * HIDDEN
    m = Tagger(*(a.astype(np.float32) for a in (rng.normal(0, 0.3, (2, SYMBOLS, g)), rng.normal(0, 0.25, (2, HIDDEN, g)), rng.normal(0, 0.3, (2 * HIDDEN, TAGS)), np.zeros(TAGS), np.zeros((TAGS, TAGS)))))
    m.table[:, :, HIDDEN : 2 * HIDDEN] += 1
    names = ("table", "turn", "out", "bias", "moves")
    first, second = ({k: np.zeros_like(getattr(m, k)) for k in names} for _ in range(2))
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(x), batch)
        xs, ys = x[pick], y[pick]
        runs = [m.run(xs, way, True) for way in (0, 1)]
        hidden = np.concatenate([r[0] for r in runs], 2)
        de, dm = _crf((hidden @ m.out + m.bias).astype(np.float64), m.moves.astype(np.float64), ys)
        de = de.astype(np.float32)
        grads = {"out": np.einsum("tnh,tnk->hk", hidden, de), "bias": de.sum((0, 1)), "moves": dm, "table": np.zeros_like(m.table), "turn": np.zeros_like(m.turn)}
        dh_out = de @ m.out.T
        for way in (0, 1):
            dh, dc = np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
            for t, before, held, i, f, o, gg, tc in reversed(runs[way][1]):
                dh = dh + dh_out[t, :, way * HIDDEN : (way + 1) * HIDDEN]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * gg * i * (1 - i), dc * held * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - gg * gg)], 1)
                np.add.at(grads["table"][way], xs[:, t], dz)
                grads["turn"][way] += before.T @ dz
                dh, dc = dz @ m.turn[way].T, dc * f
        norm = np.sqrt(sum(float((v.astype(float) ** 2).sum()) for v in grads.values()))
        for k in names:
            v = grads[k] * min(1.0, 5.0 / norm)
            first[k] += 0.1 * (v - first[k])
            second[k] += 0.01 * (v * v - second[k])
            now = rate * min(1.0, 2.5 * (1 - step / (steps + 1)))
            setattr(m, k, (getattr(m, k) - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32))
    return m


# whole texts


def best_path(e: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tag of each row of e under the transitions; runs of so many rows stand one after another."""
    order = np.argsort(-sizes, kind="stable")
    sizes, first = sizes[order], (np.cumsum(sizes) - sizes)[order]
    longest = int(sizes.max(initial=0))
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    back, tags = np.zeros(e.shape, np.int8), np.zeros(len(e), np.int8)
    state = e[first].copy() if len(sizes) else e[:0]
    for t in range(1, longest):
        n = int(active[t])
        both = state[:n, :, None] + moves
        back[first[:n] + t] = both.argmax(1)
        state[:n] = both.max(1) + e[first[:n] + t]
        state[:n] -= state[:n].max(1, keepdims=True)
    now = state.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = int(active[t])
        at = first[:n] + t
        tags[at] = now[:n]
        now[:n] = back[at, now[:n]]
    return tags


def _decode(jobs: list[tuple[int, np.ndarray, np.ndarray]], model: Tagger, out: list[list[tuple[int, int, int, float]]]) -> None:
    """jobs: text, its symbols, the numbers of its windows; adds (kind, start, end, sureness) to the texts' lists."""
    half = WINDOW // 2
    weight = (half - np.abs(np.arange(WINDOW) - half + 0.5)).astype(np.float32)
    texts_of, steps = np.concatenate([np.full(len(s), k) for k, (_, _, s) in enumerate(jobs)]), np.concatenate([s for _, _, s in jobs])
    new = np.concatenate([[True], (texts_of[1:] != texts_of[:-1]) | (steps[1:] != steps[:-1] + 1)])
    run = np.cumsum(new) - 1
    windows = np.bincount(run)
    sizes = (windows - 1) * half + WINDOW
    begin = np.cumsum(sizes) - sizes
    inside = np.arange(len(steps)) - np.flatnonzero(new)[run]
    at = begin[run] + inside * half
    e, mass = np.zeros((int(sizes.sum()), TAGS), np.float32), np.zeros(int(sizes.sum()), np.float32)
    for a in range(0, len(steps), 1024):
        rows = slice(a, a + 1024)
        x = np.stack([jobs[k][1][s * half : s * half + WINDOW] for k, s in zip(texts_of[rows].tolist(), steps[rows].tolist(), strict=True)])
        found = model.emissions(x).transpose(1, 0, 2) * weight[None, :, None]
        for odd in (0, 1):  # windows of one parity don't overlap
            mine = np.flatnonzero(inside[rows] % 2 == odd)
            place = at[rows][mine, None] + np.arange(WINDOW)
            e[place] += found[mine]
            mass[place] += weight
    e /= mass[:, None]
    tags = best_path(e, sizes, model.moves)
    kind = np.where(tags > 0, (tags - 1) // 2, -1)
    fresh = np.zeros(len(tags), bool)
    fresh[begin] = True
    starts = np.flatnonzero((kind >= 0) & (fresh | (tags % 2 == 1) | (kind != np.concatenate([[-1], kind[:-1]]))))
    # a span goes on while the kind stays and no other one begins
    stop = np.flatnonzero(np.concatenate([fresh[1:] | (kind[1:] != kind[:-1]) | (tags[1:] % 2 == 1), [True]])) + 1
    finish = stop[np.searchsorted(stop, starts, side="right")] if len(starts) else starts
    sure = np.concatenate([[0], np.cumsum(e[np.arange(len(e)), tags] - e[:, 0], dtype=np.float64)])
    where = np.repeat(np.arange(len(sizes)), sizes)
    lead = steps[new] * half - begin
    owner = texts_of[new]
    for s, f in zip(starts.tolist(), finish.tolist(), strict=True):
        r = where[s]
        out[jobs[owner[r]][0]].append((int(kind[s]), int(s + lead[r]), int(f + lead[r]), float(sure[f] - sure[s]) / (f - s)))


def tagged(found: list[str], model: Tagger) -> list[list[tuple[int, int, int, float]]]:
    """Spans that the tagger sees in each text, with their sureness; ends may lie beyond the text's by padding."""
    half = WINDOW // 2
    out: list[list[tuple[int, int, int, float]]] = [[] for _ in found]
    jobs, n = [], 0
    for k, text in enumerate(found):
        at = np.array([m.start() for m in _TRIGGER.finditer(text)], np.int64)
        if len(at):
            steps = np.unique(np.concatenate([at // half, np.maximum(at // half - 1, 0)]))
            jobs.append((k, np.concatenate([symbols(text), np.full(WINDOW, 95)]), steps))
            n += len(steps)
            if n >= TOGETHER:
                _decode(jobs, model, out)
                jobs, n = [], 0
    if jobs:
        _decode(jobs, model, out)
    return out


def sensible(kind: int, text: str) -> bool:
    """Whether what the tagger found can be of its kind."""
    if kind == 0:
        return len(text) > 4 and bool(_AT.search(text[1:-1]))
    if kind == 1:
        numbers = _NUMBERS.findall(text)
        return len(numbers) == 4 and valid(1, ".".join(numbers))
    return valid(kind, text)


def spans(found: list[str], model: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """(base, all) spans of each text; all are ordered by kind, then start."""
    result = []
    for text, more in zip(found, tagged(found, model), strict=True):
        base = base_spans(text)
        extra = []
        if more:
            taken = sorted((a, b) for _, a, b in base)
            starts, reach = [a for a, _ in taken], [0]
            for _, b in taken:
                reach.append(max(reach[-1], b))
            for kind, a, b, sure in more:
                b = min(b, len(text))
                while b > a and text[b - 1].isspace():
                    b -= 1
                while a < b and text[a].isspace():
                    a += 1
                if sure < SURE or reach[bisect_left(starts, b)] > a or not sensible(kind, text[a:b]):
                    continue
                if not (a and text[a - 1].isalnum()) and not (b < len(text) and text[b].isalnum()):
                    extra.append((kind, a, b))
        result.append((base, sorted([*base, *extra])))
    return result


def listed(some: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in some)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans (kind:start:end lists), and the base counts by kind, of every whole text."""
    model = docs.sparkSession.sparkContext.broadcast(train())  # of fixed size
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, spans string"

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = spans(batch.column(1).to_pylist(), model.value)
        counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in range(4)]
        return pa.RecordBatch.from_arrays([batch.column(0), *counts, pa.array([listed(b) for b, _ in found]), pa.array([listed(s) for _, s in found])], [x.split()[0] for x in schema.split(", ")])

    return over_batches(texts(docs), run, schema)


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in angle brackets, and n_chars (if there is one) counted anew."""
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train())
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            raw, out = batch.column(at).to_pylist(), []
            for text, (_, some) in zip(raw, spans([t or "" for t in raw], model.value), strict=True):
                end, parts = 0, []
                for kind, a, b in sorted(some, key=lambda s: (s[1], -s[2])):
                    if a >= end:
                        parts += [text[end:a], f"<{KINDS[kind]}>"]
                    end = max(end, b)
                out.append("".join([*parts, text[end:]]) if parts else text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))
        freed()

    done = docs.mapInArrow(run, docs.schema)
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done
