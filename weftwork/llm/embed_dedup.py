"""Near-duplicate vectors by spherical-cap filters.

Filter directions are a product code: one random unit vector for each half of the (randomly rotated) space. A vector is
list-decoded to all directions whose inner product with it exceeds a threshold; the threshold is that of a cap which
holds on average ``FILTERS`` directions of the code, whatever its size. Vectors are joined on their filters, and a pair is
verified by its cosine in double precision in the first filter that the two share.

Equal vectors of a label are one class before filters are computed. A filter with very many classes is compared in pairs of chunks.
Vectors keep the type of their elements (float, or double for all others), and labels may have any type that can be grouped.
Before lengths are taken a vector is divided by a power of two, so that squares neither overflow nor vanish.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite elements, and one without a label, links with
nothing and is its own component; vectors of different length do not link; repeated rows are vectors of their own that link.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.components import components, local_roots
from weftwork.llm.groups import by_whole_groups, in_chunk_pairs
from weftwork.session import checkpointed

COSINE = 0.98
FILTERS = 20.0  # directions that a vector exceeds, on average
PER_FILTER = 8.0  # vectors that a filter holds, about, if they are spread evenly
CHUNK = 2048
TILE = 512
DECODED = 1 << 18  # inner products held at a time for each half of the code


def _cap(dimension: int, share: float) -> float:
    """The inner product that a uniform unit vector exceeds with probability ``share``."""
    angle = np.linspace(0, math.pi, 200_001)
    weight = np.sin(angle) ** max(0, dimension - 2)
    grown = np.cumsum(weight)
    return float(np.cos(angle[int(np.searchsorted(grown, share * grown[-1]))]))


@lru_cache(maxsize=8)
def code(dimension: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Rotation, the two halves of the code, and the threshold, for vectors of this length."""
    random = np.random.default_rng([dimension, size, 20])
    rotation = np.linalg.qr(random.standard_normal((dimension, dimension)))[0]
    half = max(1, dimension // 2)
    parts = []
    for length in (half, dimension - half):
        words = random.standard_normal((size, length))
        words /= np.maximum(1e-12, np.linalg.norm(words, axis=1, keepdims=True))
        parts.append(words * math.sqrt(length / dimension))
    return rotation, parts[0], parts[1], _cap(dimension, min(0.5, FILTERS / size**2))


def decode(vectors: np.ndarray, size: int) -> list[np.ndarray]:
    """The filters of each unit vector, ascending: all that exceed the threshold, and the best one always."""
    rotation, left, right, least = code(vectors.shape[1], size)
    turned = vectors @ rotation
    half = left.shape[1]
    a, b = turned[:, :half] @ left.T, turned[:, half:] @ right.T
    best_a, best_b = a.max(axis=1), b.max(axis=1)
    found = []
    for x, y, p, q in zip(a, b, best_a, best_b):
        i, j = np.flatnonzero(x >= least - q), np.flatnonzero(y >= least - p)
        r, s = np.nonzero(x[i][:, None] + y[j][None] >= least)
        filters = i[r] * size + j[s]
        found.append(np.unique(np.append(filters, int(x.argmax()) * size + int(y.argmax()))))
    return found


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows in double precision, each divided by the power of two next to its largest component."""
    vectors = vectors.astype(np.float64)
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _filters(size: int, element: np.dtype):
    rows_at_once = max(16, min(512, DECODED // size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(i, rows_at_once)
                vectors = [np.array(v, element) for v in part.column(3).to_pylist()]
                decoded: list = [None] * len(vectors)
                lengths = np.array([len(v) for v in vectors])
                for dimension in np.unique(lengths):
                    rows = np.flatnonzero(lengths == dimension)
                    matrix = _scaled(np.stack([vectors[r] for r in rows]))
                    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
                    for r, filters in zip(rows, decode(matrix, size)):
                        decoded[r] = filters
                counts = [len(f) for f in decoded]
                at = np.repeat(np.arange(len(vectors)), counts)
                raw = pa.array([v.tobytes() for v in vectors], pa.binary())
                lists = pa.array([f.astype("<i8").tobytes() for f in decoded], pa.binary())
                taken = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lengths[at].astype(np.int32)), part.column(1).take(taken), pa.array(np.concatenate(decoded)),
                     part.column(0).take(taken), part.column(2).take(taken), raw.take(taken), lists.take(taken)],
                    names=["dimension", "label", "filter", "class", "n", "vector", "filters"],
                )

    return run


def _first_shared(filters: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Row by row the least filter in both of two padded lists."""
    both = (filters[:, :, None] == other[:, None, :]).any(axis=2) & (filters >= 0)
    return np.where(both.any(axis=1), filters[np.arange(len(filters)), both.argmax(axis=1)], -1)


def _verify(table: pa.Table, element: np.dtype) -> Iterator[pa.RecordBatch]:
    parts, which, classes, n = (table.column(i).to_numpy() for i in range(4))
    vectors, lists = table.column(4).to_pylist(), table.column(5).to_pylist()
    heads = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
    ends = np.append(heads[1:], len(parts))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for head, end in zip(heads, ends):
        if end - head < 2:
            continue
        out.extend(_verify_part(
            int(which[head]), classes[head:end], n[head:end], table.column(6).slice(head, end - head).to_numpy(),
            _scaled(np.stack([np.frombuffer(v, element) for v in vectors[head:end]])), lists[head:end],
        ))
    if out:
        a, b, c = (np.concatenate(x) for x in zip(*out))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c)], names=["class", "root", "links"])


def _verify_part(which, classes, n, chunk, vectors, lists):
    """The links of one part: each class, the least class it reaches here, and the vectors it links with here.

    ``chunk`` is 0 or 1. Where both occur only pairs across them count, as pairs within a chunk are in a part of their own.
    """
    norms = np.linalg.norm(vectors, axis=1)
    longest = max(len(x) for x in lists) // 8
    padded = np.full((len(lists), longest), -1, np.int64)
    for row, raw in zip(padded, lists):
        row[:len(raw) // 8] = np.frombuffer(raw, "<i8")
    across = chunk.min() != chunk.max()
    links = np.zeros(len(classes), np.int64)
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for i in range(0, len(classes), TILE):
        for j in range(i, len(classes), TILE):
            cosine = vectors[i:i + TILE] @ vectors[j:j + TILE].T / (norms[i:i + TILE, None] * norms[None, j:j + TILE])
            x, y = np.nonzero(cosine >= COSINE)
            x, y = x + i, y + j
            keep = x < y if i == j else np.ones(len(x), bool)
            if across:
                keep &= chunk[x] != chunk[y]
            x, y = x[keep], y[keep]
            for s in range(0, len(x), 20_000):
                p, q = x[s:s + 20_000], y[s:s + 20_000]
                first = _first_shared(padded[p], padded[q]) == which
                p, q = p[first], q[first]
                np.add.at(links, p, n[q])
                np.add.at(links, q, n[p])
                a, b = np.concatenate([a, classes[p]]), np.concatenate([b, classes[q]])
            if len(a) > 100_000:
                a, b = local_roots(a, b)
    if len(a):
        vertex, root = local_roots(a, b)
        order = np.argsort(classes)
        yield vertex, root, links[order][np.searchsorted(classes[order], vertex)]


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    vectors = embeddings.select("vec_id", "embedding", "label")
    kind, element = vectors.schema["label"].dataType.simpleString(), np.dtype(np.float32)
    if vectors.schema["embedding"].dataType.elementType.typeName() != "float":
        vectors, element = vectors.withColumn("embedding", F.col("embedding").cast("array<double>")), np.dtype(np.float64)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    usable = F.coalesce(
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )
    rows = vectors.withColumn("class", F.when(usable, F.xxhash64("label", "embedding")))
    classes = checkpointed(
        rows.where(F.col("class").isNotNull()).groupBy("class", "label", "embedding")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"))
    )
    size = max(48, math.ceil(math.sqrt(classes.count() / PER_FILTER * FILTERS)))
    placed = classes.select("class", "label", "n", "embedding").mapInArrow(
        _filters(size, element), f"dimension int, label {kind}, filter long, class long, n long, vector binary, filters binary"
    )
    parts = in_chunk_pairs(placed, ["dimension", "label", "filter"], "class", CHUNK)
    found = checkpointed(
        parts.repartition("part").sortWithinPartitions("part", "filter")
        .select("part", "filter", "class", "n", "vector", "filters", "chunk")
        .mapInArrow(by_whole_groups(20_000, 1, partial(_verify, element=element)), "class long, root long, links long")
    )
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.select("class", "root")).select(F.col("vertex").alias("class"), F.col("root"))
    known = (
        classes.select("class", "n", "first_id").join(links, "class", "left").join(roots, "class", "left")
        .select("class", "first_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("root", "class").alias("root"))
    )
    smallest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = known.join(smallest, "root").select("class", "n_links", "component_id")
    # A vector of no class must not meet the others that have none in one task.
    key = F.coalesce("class", F.xxhash64("vec_id"))
    return (
        rows.select("vec_id", F.col("class").isNotNull().alias("usable"), key.alias("class")).join(of_class, "class", "left")
        .select(
            "vec_id", F.when(F.col("usable"), F.col("n_links")).otherwise(0).alias("n_links"),
            F.coalesce(F.when(F.col("usable"), F.col("component_id")), "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
