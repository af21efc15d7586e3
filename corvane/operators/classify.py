"""Models as plug-ins over Arrow batches: language labels, encoder, generator, each with a deterministic default."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

GRAMS = 1 << 14


def _grams(text: str) -> np.ndarray:
    flat = f" {' '.join(text.lower().split())} ".encode("utf-8", "surrogatepass")
    data = np.frombuffer(flat, np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    mixed = (data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA77) ^ data[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(18)
    return mixed.astype(np.int64)


def learn_labels(rows: DataFrame, text: str = "text", label: str = "lang") -> tuple[list[str], np.ndarray]:
    """Labels and log frequencies of hashed trigrams, counted over all labelled rows."""

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[name] = held.get(name, 0) + np.bincount(_grams(t), minlength=GRAMS)
        for name, counts in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([counts.astype("<f8").tobytes()], pa.binary())], ["label", "counts"])

    found: dict[str, np.ndarray] = {}
    for row in rows.where(f"{text} is not null and {label} is not null").select(text, label).mapInArrow(count, "label string, counts binary").toLocalIterator():
        found[row[0]] = found.get(row[0], 0) + np.frombuffer(bytes(row[1]), "<f8")  # a table of fixed size for each label
    names = sorted(found)
    counts = np.stack([found[n] for n in names]) if names else np.zeros((0, GRAMS))
    return names, np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * GRAMS))


def label_column(model: tuple[list[str], np.ndarray], top: int = 4) -> Callable[[Column], Column]:
    """array<struct<label, score>> of the best labels; null for texts without a trigram."""
    names, weights = model

    @F.pandas_udf("array<struct<label:string,score:double>>")
    def predict(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            grams = _grams(t or "")
            if not len(grams) or not names:
                out.append(None)
                continue
            total = weights[:, grams].mean(1) * min(len(grams), 40)
            p = np.exp(total - total.max())
            p /= p.sum()
            out.append([{"label": names[k], "score": float(p[k])} for k in np.argsort(-p, kind="stable")[:top]])
        return pd.Series(out)

    return predict


def hashed_vector(text: str, size: int = 64) -> list[float]:
    """Signed feature hashing of the tokens, of unit length."""
    out = np.zeros(size)
    for token in (text or "").lower().split():
        h = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        out[h % size] += 1.0 if h >> 16 & 1 else -1.0
    length = np.linalg.norm(out)
    return (out / max(length, 1e-12)).tolist()


def encode(rows: DataFrame, text: Column, encoder: Callable[[str], list[float]] = hashed_vector, as_query_task: str | None = None) -> DataFrame:
    """rows with `embedding array<float>`."""

    @F.pandas_udf("array<float>")
    def vectors(texts: pd.Series) -> pd.Series:
        return texts.map(encoder)

    return rows.withColumn("embedding", vectors(T.query_format(text, as_query_task) if as_query_task else T.passage_format(text)))


def first_sentence(prompt: str, passages: list[str]) -> str:
    """The default generator: the first sentence of the best passage."""
    for passage in passages:
        for sentence in passage.replace("\n", " ").split(". "):
            if sentence.strip():
                return sentence.strip()
    return ""


def generate(rows: DataFrame, generator: Callable[[str, list[str]], str] = first_sentence) -> DataFrame:
    """rows (prompt, passages) with `answer`."""

    @F.pandas_udf("string")
    def answers(prompts: pd.Series, passages: pd.Series) -> pd.Series:
        return pd.Series([generator(p, list(x) if x is not None else []) for p, x in zip(prompts, passages, strict=True)])

    return rows.withColumn("answer", answers("prompt", "passages"))
