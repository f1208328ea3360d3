"""Toxic passages by maximum-scoring segments.

Each word scores its log-odds of standing in a toxic document, under a Dirichlet prior whose mean comes from all
words that begin alike, less a standard deviation and a drift. A linear-time scan then finds every maximal segment of
positive sum. The largest sum of chance segments follows an extreme-value law with parameters lambda and K, which
turns a sum S in n words into the expected number K n exp(-lambda S) of such segments. All passages of a document count: the r
best of them together are as likely by chance as the law of the sum of the r largest says, and the r that is least likely stands for
the document. The logarithm is calibrated to the labels.

Defined cases: null and empty texts have no segment and get the score of no evidence; every row of ``documents`` gives one
row, repeated rows too; without labelled rows of both kinds no word scores and all get the share of toxic labels (0 if none).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.textbytes import WORD_BYTES, flat, hashes, lookup, mix, runs, slices
from weftwork.llm.training import held_out, labelled_sample, logistic, sigmoid

STEM = 4  # bytes of a word that name its prior class
PRIOR = 10.0  # pseudo-counts of a word, shared out as in its class
STEM_PRIOR = 30.0  # pseudo-counts of a class, shared out as in the corpus
DRIFT = 0.4
DEVIATIONS = 1.0  # how far below its estimate a word scores
SAMPLE = 10_000  # labelled documents to learn from, at most
LEAST_COUNT = 2  # words seen less often score as their class


@dataclass(frozen=True)
class Model:
    words: np.ndarray
    word_scores: np.ndarray
    stems: np.ndarray
    stem_scores: np.ndarray
    unseen: float
    lam: float
    k: float
    weight: float  # of the best segment
    more_weight: float  # of what further segments add
    bias: float


def _tokens(texts: pa.Array):
    data, borders = flat(pc.utf8_lower(pc.fill_null(texts, "")))
    starts, ends = runs(data, borders, WORD_BYTES)
    words = hashes(data, starts, ends)
    stems = mix(hashes(data, starts, np.minimum(starts + STEM, ends)) + np.uint64(1))
    return data, borders, starts, ends, words, stems


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, labels = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        for a, b in slices(texts):
            _, borders, starts, _, words, stems = _tokens(texts[a:b])
            of_doc = np.searchsorted(starts, borders[1:], side="left")
            of_word = np.repeat(np.arange(b - a), np.diff(of_doc, prepend=0))
            for kind, keys in ((0, words), (1, stems)):
                unique, at, inverse = np.unique(keys, return_index=True, return_inverse=True)
                pairs = np.unique(of_word * len(unique) + inverse)  # a word counts once in a document
                toxic, inverse = (labels[a:b] > 0)[pairs // max(1, len(unique))], pairs % max(1, len(unique))
                ones = np.bincount(inverse, toxic, len(unique)).astype(np.int64)
                alls = np.bincount(inverse, minlength=len(unique)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(unique), kind, np.int32)), pa.array(unique.view(np.int64)),
                     pa.array(stems[at].view(np.int64)), pa.array(ones), pa.array(alls - ones)],
                    names=["kind", "key", "stem", "toxic", "clean"],
                )


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [start, end) with their sums, left to right, in linear time.

    Each is of positive sum, and no segment that contains or overlaps it scores higher within its reach.
    """
    found: list[list] = []  # start, end, sum before it, sum up to its end
    total = 0.0
    for i, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        start = i
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append([start, i + 1, before, total, j])
                break
            start, before = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, high - low) for a, b, low, high, _ in found]


def _word_scores(model: Model, words: np.ndarray, stems: np.ndarray) -> np.ndarray:
    scores = lookup(words, model.words, model.word_scores, np.float32(np.nan))
    unknown = np.flatnonzero(np.isnan(scores))
    scores[unknown] = lookup(stems[unknown], model.stems, model.stem_scores, np.float32(model.unseen))
    return scores


def _scan(texts: pa.Array, model: Model):
    """Per document: number of words, and its segments as (first byte, end byte, sum)."""
    data, borders, starts, ends, words, stems = _tokens(texts)
    scores = _word_scores(model, words, stems).astype(np.float64)
    scores[1:][words[1:] == words[:-1]] = 0.0  # a word said again at once adds nothing
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    of_doc = np.searchsorted(starts, borders, side="left")
    positive = np.flatnonzero(scores > 0)
    in_doc = np.searchsorted(positive, of_doc, side="left")
    for d in range(len(borders) - 1):
        hits = positive[in_doc[d]:in_doc[d + 1]]
        n = int(of_doc[d + 1] - of_doc[d])
        if len(hits) == 0:
            yield n, []
            continue
        # Only words of positive score and the sums of the stretches between them matter.
        steps = np.empty(2 * len(hits) - 1)
        steps[0::2] = scores[hits]
        steps[1::2] = sums[hits[1:]] - sums[hits[:-1] + 1]
        yield n, [
            (int(starts[hits[a // 2]] - borders[d]), int(ends[hits[b // 2]] - borders[d]), s)
            for a, b, s in segments(steps.tolist())
        ]


def _logit_e(model: Model, n: int, best: float) -> float:
    """Minus the logarithm of the expected number of chance segments of sum ``best`` or more."""
    return model.lam * best - np.log(model.k * n + 1.0)


def evidence(model: Model, n: int, sums: list[float]) -> tuple[float, float]:
    """Minus the logarithm of the chance of the best segment, and what the others add to it.

    That is for the number r of best segments for which the chance is least. The sum T of the r largest normalised sums exceeds t with probability exp(-t) t^(r-1) / (r! (r-1)!); each further segment
    costs a factor of two, as one of several numbers r was chosen.
    """
    normal = sorted((_logit_e(model, n, s) for s in sums), reverse=True)
    if not normal:
        return _logit_e(model, n, 0.0), 0.0
    best, total = normal[0], 0.0
    for r, value in enumerate(normal, 1):
        if value <= 0:
            break
        total += value
        best = max(best, total - (r - 1) * math.log(2 * total) + math.lgamma(r + 1) + math.lgamma(r))
    return normal[0], best - normal[0]


def _sample_evidence(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for a, b in slices(texts):
                rows = [evidence(model, n, [s for *_, s in found]) for n, found in _scan(texts[a:b], model)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1)[a:b], *(pa.array([r[i] for r in rows], pa.float64()) for i in (0, 1))], names=["label", "one", "more"],
                )

    return run


def _sample_stats(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for a, b in slices(texts):
                rows = [(n, max((s for *_, s in found), default=0.0)) for n, found in _scan(texts[a:b], model)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1)[a:b], pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.float64())], names=["label", "n", "best"],
                )

    return run


def _scores_of(toxic: np.ndarray, clean: np.ndarray, mean: np.ndarray | float, prior: float, base: float):
    a, b = toxic + prior * mean, clean + prior * (1 - mean)
    return np.log(a / b) - np.log(base / (1 - base)) - DEVIATIONS * np.sqrt(1 / a + 1 / b) - DRIFT


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled documents that are not held out (crc32 mod 3 is not 1)."""
    none, empty = np.zeros(0, np.uint64), np.zeros(0, np.float32)
    chosen = labelled_sample(documents, labels, "toxic", 3, 1, sample)
    counts = (
        chosen.mapInArrow(_count, "kind int, key long, stem long, toxic long, clean long")
        .groupBy("kind", "key", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("kind") == 1) | (F.col("toxic") + F.col("clean") >= LEAST_COUNT))
        .toPandas()
    )
    kinds = [counts[counts["kind"] == kind] for kind in (0, 1)]
    (words, stems), (ones, zeros) = (
        [k["key"].to_numpy(np.int64).view(np.uint64) for k in kinds],
        [[k[c].to_numpy(np.float64) for k in kinds] for c in ("toxic", "clean")],
    )
    all_toxic, all_clean = ones[1].sum(), zeros[1].sum()
    if not all_toxic or not all_clean:
        share = float(all_toxic > 0)
        return Model(none, empty, none, empty, -DRIFT, 1.0, 1.0, 0.0, 0.0, 50.0 if share else -50.0)
    base = all_toxic / (all_toxic + all_clean)
    order = np.argsort(stems)
    stems, stem_toxic, stem_clean = stems[order], ones[1][order], zeros[1][order]
    share = (stem_toxic + STEM_PRIOR * base) / (stem_toxic + stem_clean + STEM_PRIOR)
    stem_scores = _scores_of(stem_toxic, stem_clean, base, STEM_PRIOR, base).astype(np.float32)
    of_words = kinds[0]["stem"].to_numpy(np.int64).view(np.uint64)
    return _calibrated(chosen, words, of_words, ones[0], zeros[0], stems, share, stem_scores, stem_clean, base)


def _calibrated(chosen, words, stem_of, toxic, clean, stems, share, stem_scores, stem_clean, base) -> Model:
    mean = lookup(stem_of, stems, share, base)
    scores = _scores_of(toxic, clean, mean, PRIOR, base).astype(np.float32)
    order = np.argsort(words)
    unseen = float(_scores_of(np.zeros(1), np.zeros(1), base, STEM_PRIOR, base)[0])
    model = Model(words[order], scores[order], stems, stem_scores, unseen, 1.0, 1.0, 1.0, 0.0, 0.0)

    # lambda: the mean of exp(lambda score) over words of clean documents is one.
    rest = max(0.0, stem_clean.sum() - clean.sum())
    low, high = 1e-3, 20.0
    for _ in range(60):
        lam = (low + high) / 2
        mean_exp = (clean @ np.exp(np.minimum(lam * scores, 600)) + rest * np.exp(lam * unseen)) / (clean.sum() + rest)
        low, high = (lam, high) if mean_exp < 1 else (low, lam)
    stats = chosen.mapInArrow(_sample_stats(model), "label int, n long, best double").toPandas()
    label, n, best = stats["label"].to_numpy(), stats["n"].to_numpy(float), stats["best"].to_numpy(float)
    chance = (label == 0) & (n > 0)
    k = float(np.clip(chance.sum() / max(1e-12, (n[chance] * np.exp(-lam * best[chance])).sum()), 1e-9, 1e3))
    known = replace(model, lam=lam, k=k)
    found = chosen.mapInArrow(_sample_evidence(known), "label int, one double, more double").toPandas()
    weights = logistic(found[["one", "more"]].to_numpy(float), (found["label"].to_numpy() > 0).astype(float))
    return Model(model.words, model.word_scores, stems, stem_scores, unseen, lam, k, max(0.0, weights[0]), max(0.0, weights[1]), weights[2])


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, and its significant segments.

    ``passages`` holds start and end (in code points) and sum of each segment that chance gives less than once in a
    hundred documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for a, b in slices(texts):
                part = texts[a:b]
                result, spans = [], []
                for row, (n, found) in enumerate(_scan(part, model)):
                    one, more = evidence(model, n, [s for *_, s in found])
                    result.append(float(sigmoid(model.weight * one + model.more_weight * more + model.bias)))
                    strong = [x for x in found if _logit_e(model, n, x[2]) > 4.6]
                    raw = part[row].as_py().lower().encode() if strong else b""
                    spans.append([
                        {"start": len(raw[:x].decode(errors="ignore")), "end": len(raw[:y].decode(errors="ignore")), "score": s}
                        for x, y, s in strong
                    ])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(result, pa.float64()), pa.array(spans, _SPANS)],
                    names=["doc_id", "held_out", "score", "passages"],
                )

    rows = documents.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "text")
    schema = (
        f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, "
        "passages array<struct<start:int,end:int,score:double>>"
    )
    return rows.mapInArrow(run, schema)
