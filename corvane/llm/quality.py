"""Quality scores by a sparse rule ensemble: statistics of each text, rules from the paths of boosted trees, lasso
logistic weights, and the rules compiled into Spark column expressions.

Statistics are taken from whole texts. Trees and weights are fitted on at most MAX_TRAIN labelled rows: they are
counted, and those whose hash of doc_id lies below the share wanted go to the driver, so tasks send no more than that.
Null and empty texts have zero statistics and a score like any other. Without labels, or with labels of one kind only,
no rule is learned and every score is the smoothed share of label 1. A doc_id labelled more than once counts once with
its largest label, one with several texts with the least of their statistics; rows that repeat are kept; extra columns
are left behind.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import over_batches, stored

#: Labelled rows that a fit takes at most.
MAX_TRAIN = 20_000
STATISTICS = (
    "n_bytes", "n_words", "n_lines", "word_bytes", "upper", "digit", "punctuation", "marks", "bang", "bar", "high", "distinct", "top_word", "doubled", "bare", "line_words", "line_distinct", "control",
)
_BYTE = np.zeros((9, 256))
for _row, _those in enumerate((range(65, 91), range(48, 58), [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)], b"#$%&*", b"!", b"|", range(128, 256), [*range(9), *range(14, 32), 127], b"\n")):
    _BYTE[_row, list(_those)] = 1


def statistics(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = _BYTE @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, digit, punctuation, marks, bang, bar, high, control, breaks = (counts / max(1, len(raw))).tolist()
    words, lines = raw.split(), raw.split(b"\n")
    n = max(1, len(words))
    tally = Counter(words)
    return [
        float(len(raw)), float(len(words)), float(len(lines)), sum(map(len, words)) / n, upper, digit, punctuation, marks, bang, bar, high, len(tally) / n,
        max(tally.values(), default=0) / n, sum(map(eq, words, words[1:])) / n, sum(map(bytes.isalpha, words)) / n, n / len(lines), len(set(lines)) / len(lines), control,
    ]


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.array([statistics(t) for t in batch.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in rows.T)], ["doc_id", *STATISTICS])

    return over_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))


#: A condition is (statistic, is it above?, threshold); a rule is a set of them, all of which must hold.
Condition = tuple[int, bool, float]
Rule = frozenset[Condition]


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        """The score as an expression over the columns of statistics."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for statistic, above, threshold in sorted(rule):
                at = F.col(STATISTICS[statistic])
                holds = holds & (at > threshold if above else at <= threshold)
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + applied(self.rules, x) @ np.array(self.weights, float))))


def applied(rules: tuple[Rule, ...] | list[Rule], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for k, rule in enumerate(rules):
        for statistic, above, threshold in rule:
            out[:, k] *= x[:, statistic] > threshold if above else x[:, statistic] <= threshold
    return out


def grow(x: np.ndarray, cuts: list[np.ndarray], binned: np.ndarray, gradient: np.ndarray, curve: np.ndarray, depth: int, least: int, path: Rule, rules: list[Rule], value: np.ndarray, rows: np.ndarray) -> None:
    """One regression tree on the gradients; its paths are added to rules, its leaves' steps to value."""
    if path:
        rules.append(path)
    g, h = gradient[rows].sum(), curve[rows].sum()
    best = (1e-6, None)
    if depth and len(rows) >= 2 * least:
        for s, at in enumerate(cuts):
            if not len(at):
                continue
            b = binned[rows, s]
            n, gs, hs = (np.cumsum(np.bincount(b, w, len(at) + 1))[:-1] for w in (None, gradient[rows], curve[rows]))
            fit = (n >= least) & (len(rows) - n >= least)
            gain = np.where(fit, gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1), -1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (s, k))
    if best[1] is None:
        value[rows] += 0.3 * g / (h + 1)
        return
    s, k = best[1]
    low = binned[rows, s] <= k
    for side, above in ((rows[low], False), (rows[~low], True)):
        grow(x, cuts, binned, gradient, curve, depth - 1, least, path | {(s, above, float(cuts[s][k]))}, rules, value, side)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, penalty: float = 2e-4, steps: int = 400) -> Ensemble:
    """Rules from boosted trees, then lasso logistic weights by accelerated proximal gradient."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if len(set(y.tolist())) < 2:
        return Ensemble((), (), base)
    cuts = [np.unique(np.quantile(c, np.linspace(0.01, 0.99, 48))) for c in x.T]
    binned = np.stack([np.searchsorted(at, c, side="left") for at, c in zip(cuts, x.T, strict=True)], 1)
    value, found = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-value))
        grow(x, cuts, binned, y - p, p * (1 - p), depth, max(3, len(y) // 1000), frozenset(), found, value, np.arange(len(y)))
    rules = list(dict.fromkeys(found))
    z = applied(rules, x)
    support = z.mean(0)
    keep = (support > 0) & (support < 1)
    rules, z = [r for r, k in zip(rules, keep, strict=True) if k], z[:, keep]
    scale = np.maximum(z.std(0), 0.05)
    z = (z - z.mean(0)) / scale
    w = v = np.zeros(z.shape[1])
    b = bv = base
    t, rate = 1.0, 4.0 / max(1.0, float(np.linalg.eigvalsh(z.T @ z / len(z))[-1]) + 1)
    for _ in range(steps):
        e = 1 / (1 + np.exp(-(z @ v + bv))) - y
        step = v - rate * (z.T @ e) / len(y)
        new, nb = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0), bv - rate * e.mean()
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, bv, w, b, t = new + (t - 1) / u * (new - w), nb + (t - 1) / u * (nb - b), new, nb, u
    raw = w / scale
    chosen = np.flatnonzero(np.abs(w) > 1e-6)
    means = applied([rules[i] for i in chosen], x).mean(0) if len(chosen) else np.zeros(0)
    return Ensemble(tuple(rules[i] for i in chosen), tuple(float(raw[i]) for i in chosen), float(b - means @ raw[chosen]))


def train(measured: DataFrame, labels: DataFrame, bound: int = MAX_TRAIN) -> Ensemble:
    """Fit on (doc_id, quality) rows; at most `bound` of them reach the driver."""
    marks = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("double")).alias("y"))
    one = measured.groupBy("doc_id").agg(F.min(F.struct(*STATISTICS)).alias("s"))
    rows = stored(one.join(marks, "doc_id").select("doc_id", "s.*", "y"), "labelled")
    count = rows.count()
    if count > bound:  # a little less is aimed at than may come
        steps = 1 << 30
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < int(steps * max(0.5, 1 - 4 / bound**0.5) * bound / count))
    found = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound).select(*STATISTICS, "y").toArrow()
    x = np.stack([c.to_numpy() for c in found.columns], 1)
    return fit(x[:, :-1], x[:, -1])


def score(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Ensemble]:
    """(doc_id, statistics, score) of every document, and the ensemble that labels (already chosen) gave."""
    measured = stored(measure(docs), "statistics")
    model = train(measured, labels)
    return measured.withColumn("score", model.column()), model
