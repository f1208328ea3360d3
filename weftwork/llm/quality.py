"""Document quality from lines: a linear-chain conditional random field.

Every line is described by shares of its characters and words and by the same shares of the lines beside it. The field labels
each line good or bad; forward and backward passes give each line's probability of being good, and their mean, weighted by the
lines' lengths, is the document's. That mean is calibrated to the labels.

Defined cases: null and empty texts are one empty line; every row gives one row, repeated rows too; without labelled rows of both
kinds all scores are the share of good labels (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weftwork.llm.textbytes import NOT_SPACE, flat, hashes, runs, slices
from weftwork.llm.training import held_out, labelled_sample, logistic, sigmoid

SAMPLE = 6_000  # labelled documents to learn from, at most
ACCEPT = 0.7
STEPS = 120
PENALTY = 2e-3

_CLASSES = {
    "upper": range(65, 91), "digit": range(48, 58), "pipe": [124],
    "mark": [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-()|"], "stop": [44, 46, 58, 59],
}
_TABLES = {}
for _name, _members in _CLASSES.items():
    _TABLES[_name] = np.zeros(256, bool)
    _TABLES[_name][list(_members)] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(192, 256)]] = True
_NOT_BREAK = np.ones(256, bool)
_NOT_BREAK[10] = False


def _share(data: np.ndarray, table: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
    return (sums[ends] - sums[starts]).astype(np.float64)


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines with anything in them, their lengths in bytes, and the borders between documents.

    A document without such a line has one empty line.
    """
    data, borders = flat(texts)
    starts, ends = runs(data, borders, _NOT_BREAK)
    counts = np.diff(np.searchsorted(starts, borders, side="left"))
    bare = np.flatnonzero(counts == 0)
    if len(bare):
        at = np.searchsorted(starts, borders[bare], side="left")
        starts, ends = np.insert(starts, at, borders[bare]), np.insert(ends, at, borders[bare])
        counts[bare] = 1
    of_doc = np.concatenate([[0], np.cumsum(counts)])
    first, last = runs(data, borders, NOT_SPACE)
    keys = hashes(data, first, last)
    again = np.zeros(len(first) + 1)
    again[2:] = np.cumsum(keys[1:] == keys[:-1]) if len(first) > 1 else again[2:]
    low, high = np.searchsorted(first, starts, side="left"), np.searchsorted(first, ends, side="left")
    words = (high - low).astype(np.float64)
    inner = np.maximum(high, low + 1)
    repeated = again[np.minimum(inner, len(first))] - again[np.minimum(low + 1, len(first))]
    length = np.maximum(1.0, (ends - starts).astype(np.float64))
    letters = np.maximum(1.0, _share(data, _LETTER, starts, ends))
    shares = {name: _share(data, table, starts, ends) for name, table in _TABLES.items()}
    per_word = {name: shares[name] / np.maximum(1.0, words) for name in ("upper", "digit", "pipe", "mark", "stop")}
    own = np.column_stack([
        np.ones(len(starts)), np.minimum(1.0, np.log1p(words) / 6), np.minimum(2.0, length / np.maximum(1.0, words) / 8),
        shares["upper"] / letters, np.minimum(1.0, 3 * shares["upper"] / letters), letters / length,
        np.minimum(1.0, per_word["mark"]), np.minimum(1.0, 5 * per_word["mark"]), np.minimum(1.0, per_word["pipe"]),
        np.minimum(1.0, 5 * per_word["pipe"]), np.minimum(1.0, per_word["digit"]), np.minimum(1.0, 5 * per_word["stop"]),
        repeated / np.maximum(1.0, words), np.minimum(1.0, 4 * repeated / np.maximum(1.0, words)),
    ])
    side = own[:, 1:]
    before, after = np.vstack([side[:1], side[:-1]]), np.vstack([side[1:], side[-1:]])
    before[of_doc[:-1]] = side[of_doc[:-1]]
    after[of_doc[1:] - 1] = side[of_doc[1:] - 1]
    return np.hstack([own, before, after]), length, of_doc


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of a line's features, for good against bad
    change: np.ndarray  # 2 x 2 scores of one label after another
    slope: float
    bias: float


def _layout(of_doc: np.ndarray):
    """Documents by falling number of lines, and how many have more than t lines."""
    counts = np.diff(of_doc)
    order = np.argsort(-counts, kind="stable")
    falling = counts[order]
    return order, falling, len(falling) - np.searchsorted(falling[::-1], np.arange(falling[0] if len(falling) else 0), side="right")


def marginals(good: np.ndarray, change: np.ndarray, of_doc: np.ndarray):
    """Each line's probability of being good, and the expected changes of label, of all documents.

    ``good`` is each line's score for good against bad. The two passes go over all documents at once, line by line.
    """
    order, counts, active = _layout(of_doc)
    begin = of_doc[order]
    steps = len(active)
    forward = np.zeros((len(good), 2))
    backward = np.zeros((len(good), 2))
    scores = np.column_stack([np.zeros(len(good)), good])
    for t in range(steps):
        at = begin[:active[t]] + t
        if t == 0:
            forward[at] = scores[at]
        else:
            past = forward[at - 1]
            forward[at] = scores[at] + np.column_stack([
                np.logaddexp(past[:, 0] + change[0, j], past[:, 1] + change[1, j]) for j in (0, 1)
            ])
        forward[at] -= forward[at].max(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        at = begin[:active[t + 1]] + t
        ahead = backward[at + 1] + scores[at + 1]
        backward[at] = np.column_stack([
            np.logaddexp(ahead[:, 0] + change[i, 0], ahead[:, 1] + change[i, 1]) for i in (0, 1)
        ])
        backward[at] -= backward[at].max(axis=1, keepdims=True)
    belief = sigmoid((forward + backward)[:, 1] - (forward + backward)[:, 0])
    heads = np.ones(len(good), bool)
    heads[of_doc[:-1]] = False
    at = np.flatnonzero(heads)
    pair = forward[at - 1][:, :, None] + change[None] + (scores[at] + backward[at])[:, None, :]
    pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
    return belief, pair / pair.sum(axis=(1, 2), keepdims=True)


def train(features: np.ndarray, of_doc: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and changes of label that make the documents' labels, given to all their lines, likely.

    Each document counts once, whatever its number of lines.
    """
    counts = np.diff(of_doc)
    line_good = np.repeat(good.astype(float), counts)
    share = np.repeat(1.0 / counts, counts) / len(counts)
    kinds = np.where(good, 1, 0)
    observed = np.zeros((2, 2))
    np.add.at(observed, (kinds, kinds), (counts - 1) / counts / len(counts))
    heads = np.ones(len(features), bool)
    heads[of_doc[:-1]] = False
    size = features.shape[1]
    theta, m, v = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    for step in range(1, STEPS + 1):
        weights, change = theta[:size], theta[size:].reshape(2, 2)
        belief, pair = marginals(features @ weights, change, of_doc)
        gradient = np.concatenate([
            features.T @ ((belief - line_good) * share),
            ((pair * share[heads][:, None, None]).sum(axis=0) - observed).ravel(),
        ]) + PENALTY * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta = theta - 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:size], theta[size:].reshape(2, 2)


def _documents(model_weights, change, features, length, of_doc) -> np.ndarray:
    belief, _ = marginals(features @ model_weights, change, of_doc)
    total = np.add.reduceat(length, of_doc[:-1])
    return np.add.reduceat(belief * length, of_doc[:-1]) / total


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _features_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.column(0)):
            features, length, of_doc = line_features(batch.column(0)[a:b])
            packed = [features[x:y].astype(np.float32).tobytes() for x, y in zip(of_doc[:-1], of_doc[1:])]
            sizes = [length[x:y].tobytes() for x, y in zip(of_doc[:-1], of_doc[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1)[a:b], pa.array(packed, pa.binary()), pa.array(sizes, pa.binary())],
                names=["label", "features", "lengths"],
            )


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled documents that are not held out (crc32 mod 4 is not 2)."""
    rows = labelled_sample(documents, labels, "quality", 4, 2, sample).mapInArrow(
        _features_out, "label int, features binary, lengths binary"
    ).toPandas()
    good = rows["label"].to_numpy() > 0
    width = 14 + 2 * 13
    if len(good) == 0 or good.all() or not good.any():
        return Model(np.zeros(width), np.zeros((2, 2)), 0.0, 0.0 if not len(good) else (50.0 if good.all() else -50.0))
    features = np.frombuffer(b"".join(rows["features"]), np.float32).reshape(-1, width).astype(np.float64)
    length = np.frombuffer(b"".join(rows["lengths"]), np.float64)
    of_doc = np.concatenate([[0], np.cumsum([len(x) // 8 for x in rows["lengths"]])])
    weights, change = train(features, of_doc, good)
    belief = _documents(weights, change, features, length, of_doc)
    slope, bias = logistic(_logit(belief)[:, None], good.astype(float))
    return Model(weights, change, max(0.0, float(slope)), float(bias))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for a, b in slices(texts):
                features, length, of_doc = line_features(texts[a:b])
                belief = _documents(model.weights, model.change, features, length, of_doc)
                result = sigmoid(model.slope * _logit(belief) + model.bias)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(result)], names=["doc_id", "held_out", "score"]
                )

    rows = documents.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")


def keep_accepted(documents: DataFrame, model: Model, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``documents``, all columns, whose score is at least ``accept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for a, b in slices(texts):
                features, length, of_doc = line_features(texts[a:b])
                belief = _documents(model.weights, model.change, features, length, of_doc)
                good = sigmoid(model.slope * _logit(belief) + model.bias) >= accept
                yield batch.slice(a, b - a).filter(pa.array(good))

    return documents.mapInArrow(run, documents.schema)
