"""Language of each document: sparse multinomial logistic regression on character n-grams.

One to three letters are hashed to ``BUCKETS`` features, weighted by term and inverse document frequency and scaled to length one.
The weights are learned by follow-the-regularised-leader with elastic-net penalties, and a temperature is
fitted on rows kept apart.

Defined cases: null texts and texts without a letter are ``und`` with score 0; every row gives one row; without learning rows
everything is ``und``; with one language only, that language with score 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.textbytes import slices
from weftwork.llm.training import held_out

BUCKETS = 8192
PER_LANGUAGE = 500  # documents of each language to learn from, about
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-4, 1e-4
BATCH = 64  # documents counted at once
UNDETERMINED = "und"

_CODES = np.arange(128)
_FOLD = np.where(((_CODES >= 97) & (_CODES < 123)), _CODES, 32).astype(np.uint32)


def _grams(texts: list[str]):
    """Counts of the hashed n-grams: one row per text."""
    data = np.frombuffer("\0\0".join(texts).encode("utf-32-le", "replace"), np.uint32)
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = np.where(data < 128, _FOLD[np.minimum(data, 127)], data)
    codes = np.where(data == 0, 0, codes)
    starts = np.concatenate([[0], np.cumsum(lengths + 2)[:-1]])
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), lengths + 2)[:len(codes)] * BUCKETS
    inside = np.zeros(len(codes) + 2, bool)
    for s, n in zip(starts, lengths):
        inside[s:s + n] = True
    counts = np.zeros(len(texts) * BUCKETS, np.float32)
    key = np.zeros(len(codes), np.uint32)
    valid = inside[:len(codes)].copy()
    for order in (1, 2, 3):
        shifted = np.zeros(len(codes), np.uint32)
        stop = len(codes) - order + 1
        if stop <= 0:
            break
        shifted[:stop] = codes[order - 1:]
        key = key * np.uint32(0x01000193) + shifted + np.uint32(order)
        valid[:stop] &= inside[order - 1:order - 1 + stop]
        valid[stop:] = False
        bucket = ((key * np.uint32(2654435769)) >> np.uint32(19)).astype(np.int64)
        counts += np.bincount((doc + bucket)[valid], minlength=len(counts)).astype(np.float32)
    return counts.reshape(len(texts), BUCKETS)


def _batches(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    for a, b in slices(column, 1 << 19):
        for i in range(a, b, BATCH):
            j = min(b, i + BATCH)
            yield i, j, pc.utf8_lower(pc.fill_null(column[i:j], "")).to_pylist()


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, rows = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for _, _, texts in _batches(batch.column(0)):
            seen += (_grams(texts) > 0).sum(axis=0)
            rows += len(texts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(-1, BUCKETS, dtype=np.int32)), pa.array(np.concatenate([[rows], seen]))], names=["bucket", "n"]
    )


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return x / np.maximum(1e-9, np.sqrt((x * x).sum(axis=1, keepdims=True)))


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, classes: int) -> np.ndarray:
    """Weights after ``EPOCHS`` passes over sparse rows of (features, values)."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))
    order = np.random.default_rng(7)

    def leader(at):
        return np.where(
            np.abs(z[at]) > L1, -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0
        )

    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, value = rows[i]
            w = leader(at)
            p = _softmax(10 * (value @ w))
            p[target[i]] -= 1
            gradient = value[:, None] * p[None]
            z[at] += gradient - (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / ALPHA * w
            n[at] += gradient**2
    return leader(np.arange(BUCKETS))


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Document frequencies of all learning rows; weights from about ``per_language`` rows of each language."""
    rows = documents.select("doc_id", "text", "lang").where(
        ~held_out("doc_id", 4, 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    found = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(found)
    seen = dict(
        rows.select("text").mapInArrow(_document_counts, "bucket int, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()[["bucket", "n"]].to_numpy().tolist()
    ) if found else {}
    total = seen.get(-1, 0)
    idf = np.array([np.log((1 + total) / (1 + seen.get(b, 0))) + 1 for b in range(BUCKETS)])
    if len(languages) < 2:
        return Model(languages, idf, np.zeros((BUCKETS, len(languages))), 1.0)

    # About so many rows of each language, chosen by the hash of the id: a bound on what the driver reads.
    chance = F.lit(0.0)
    for name, count in found.items():
        chance = F.when(F.col("lang") == name, F.lit(per_language / count)).otherwise(chance)
    draw = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30)) / float(1 << 30)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in _batches(batch.column(0)):
                x = _weighted(_grams(texts), idf)
                at = [np.flatnonzero(r) for r in x]
                yield pa.RecordBatch.from_arrays([
                    batch.column(1)[a:b], pa.array([i.astype(np.uint16).tobytes() for i in at], pa.binary()),
                    pa.array([r[i].astype(np.float32).tobytes() for r, i in zip(x, at)], pa.binary()),
                ], names=["lang", "at", "value"])

    sample = (
        rows.where(draw < chance).select("text", "lang").mapInArrow(sparse, "lang string, at binary, value binary").toPandas()
    )
    target = np.searchsorted(np.array(languages), sample["lang"].to_numpy(str)) if len(sample) else np.zeros(0, int)
    vectors = [
        (np.frombuffer(i, np.uint16).astype(np.int64), np.frombuffer(v, np.float32).astype(np.float64))
        for i, v in zip(sample["at"], sample["value"])
    ]
    apart = np.arange(len(vectors)) % 5 == 0
    weights = follow_the_leader(
        [v for v, out in zip(vectors, apart) if not out], target[~apart], len(languages)
    )
    logits = np.array([v @ weights[at] for (at, v), out in zip(vectors, apart) if out]).reshape(-1, len(languages))
    grid = np.geomspace(0.01, 10, 61)
    losses = [
        -np.log(np.maximum(1e-12, _softmax(logits / t)[np.arange(len(logits)), target[apart]])).sum() for t in grid
    ]
    return Model(languages, idf, weights, float(grid[int(np.argmin(losses))]))


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in _batches(batch.column(2)):
                lettered = np.array([any(c.isalpha() for c in t) for t in texts], bool)
                names, best = np.full(b - a, UNDETERMINED, object), np.zeros(b - a)
                if model.languages and lettered.any():
                    p = _softmax(_weighted(_grams(texts), model.idf) @ model.weights / model.temperature)
                    names[lettered] = np.array(model.languages, object)[p.argmax(axis=1)][lettered]
                    best[lettered] = p.max(axis=1)[lettered]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(names, pa.string()), pa.array(best)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = documents.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
