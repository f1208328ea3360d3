"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint bit is set if it is set in more than half of the hashes of a document's word shingles. Equal fingerprints are
one class. Classes that differ in at most three bits agree in two of five blocks of bits, so each class
is put into ten groups, one for each pair of blocks, and groups are compared within themselves. There the remaining
bits are stored as vertical planes, one machine word for a bit of 64 classes; the distances of all classes to the class
d places further on are counted at once with carry-save counters of two bits and an overflow bit, and words whose lanes
are all beyond the radius are left out of the later planes. With more blocks and a counter of three bits (``WIDE_BLOCKS``) the radius is seven.

Defined cases: a text with fewer words than a shingle is one shingle; null, empty and blank texts have fingerprint zero, which is
compared like any other; every row gives one row, repeated rows too.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.components import components, local_roots
from weftwork.llm.groups import by_whole_groups, in_chunk_pairs
from weftwork.session import checkpointed

SHINGLE = 3
RADIUS = 3
SEED = 42
BLOCKS = ((0, 13), (13, 26), (26, 39), (39, 52), (52, 64))  # bits [from, to)
WIDE_BLOCKS = tuple((7 * i, 7 * i + 7) for i in range(8)) + ((56, 64),)  # prints that differ in seven bits agree in two of these
CHUNK = 4096  # classes of a group that are compared by one task; larger groups are split into pairs of chunks
_SHINGLES_AT_ONCE = 1 << 17


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    count = max(1, len(words) - shingle + 1)
    starts, ends = starts[:count].tolist(), (ends[-count:] - 1).tolist()
    digest, totals = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, count, _SHINGLES_AT_ONCE):
        pairs = zip(starts[i:i + _SHINGLES_AT_ONCE], ends[i:i + _SHINGLES_AT_ONCE])
        raw = b"".join([digest(line[a:b], SEED) for a, b in pairs])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        totals += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * totals > count).tobytes(), "big")


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of these 64-bit hashes."""
    totals = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _SHINGLES_AT_ONCE):
        raw = hashes[i:i + _SHINGLES_AT_ONCE].astype(">u8").view(np.uint8).reshape(-1, 8)
        totals += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * totals > len(hashes)).tobytes(), "big")


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, print): the 64 bits of the fingerprint as a long."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, print long")


def _planes(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    """Vertical storage: row b holds bit ``bits[b]`` of all classes, 64 to a word."""
    words = -(-len(prints) // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[:len(prints)] = prints
    return np.stack([
        np.packbits(((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little").view(np.uint64) for b in bits
    ])


def near_at(planes: np.ndarray, shift: int, lanes: int, counters: int = 2) -> np.ndarray:
    """Lanes below ``lanes`` whose distance to the lane ``shift`` further on is at most the radius, all that ``counters`` bits count."""
    words = -(-lanes // 64)
    skip, rest = shift // 64, np.uint64(shift % 64)
    alive = np.arange(words)
    counts, over = np.zeros((counters, words), np.uint64), np.zeros(words, np.uint64)
    last = planes.shape[1] - 1
    for b, plane in enumerate(planes):
        low = plane[np.minimum(alive + skip, last)]
        if rest:
            high = plane[np.minimum(alive + skip + 1, last)]
            low = (low >> rest) | (high << (np.uint64(64) - rest))
        carry = plane[alive] ^ low
        for i in range(counters):
            counts[i], carry = counts[i] ^ carry, counts[i] & carry
        over = over | carry
        if b % 6 == 5:
            keep = over != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not keep.all():
                alive, counts, over = alive[keep], counts[:, keep], over[keep]
                if not len(alive):
                    return alive
    within = np.unpackbits((~over).view(np.uint8), bitorder="little").reshape(-1, 64)
    word, bit = np.nonzero(within)
    lane = alive[word] * 64 + bit
    return lane[lane < lanes]


def least_partners(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of these links, for each vertex that to the least of the smaller ones."""
    high, low = np.maximum(a, b), np.minimum(a, b)
    order = np.lexsort((low, high))
    high, at = np.unique(high[order], return_index=True)
    return high, low[order][at]


def linked(keys: np.ndarray, prints: np.ndarray, bits: list[int], counters: int = 2, shrink=local_roots) -> tuple[np.ndarray, np.ndarray]:
    """Stars (class, least class) of the links within groups of equal key, or what ``shrink`` leaves of them; all groups at once.

    Groups lie by falling size, so that those with a class ``shift`` further on are the first lanes.
    """
    order = np.argsort(keys, kind="stable")
    keys, prints = keys[order], prints[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(heads, len(keys)))
    by_size = np.argsort(-sizes, kind="stable")
    by_size = by_size[sizes[by_size] > 1]
    if not len(by_size):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes, heads = sizes[by_size], heads[by_size]
    group = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    prints = prints[np.arange(len(group)) - np.repeat(ends - sizes, sizes) + np.repeat(heads, sizes)]
    planes = _planes(prints, bits)
    falling = -sizes
    a, b = [], []
    gathered = 0
    for shift in range(1, int(sizes[0])):
        groups = int(np.searchsorted(falling, -shift, side="left"))
        lanes = int(ends[groups - 1])
        at = near_at(planes, shift, lanes, counters)
        at = at[at + shift < len(group)]
        at = at[group[at] == group[at + shift]]
        a.append(prints[at])
        b.append(prints[at + shift])
        gathered += len(at)
        if gathered > 1_000_000:  # keep a spanning forest of what was found
            x, y = shrink(np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64))
            a, b, gathered = [x.view(np.uint64)], [y.view(np.uint64)], len(x)
    return shrink(np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64))


def links(classes: DataFrame, chunk: int = CHUNK, blocks: tuple = BLOCKS, counters: int = 2, shrink=local_roots) -> DataFrame:
    """Edges (high, low) that connect all classes within the radius of each other; not every pair of them.

    ``classes`` holds distinct values of ``print``. The radius is what ``counters`` bits count, and two less than the number of ``blocks``.
    With ``least_partners`` for ``shrink`` the edges are links themselves, and may connect less.
    """
    tables = list(combinations(range(len(blocks)), 2))

    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        tab, part, prints = (c.to_numpy() for c in rows.columns)
        for table in np.unique(tab):
            mine = tab == table
            fixed = {b for i in tables[table] for b in range(*blocks[i])}
            vertex, root = linked(part[mine], prints[mine].view(np.uint64), [b for b in range(64) if b not in fixed], counters, shrink)
            keep = vertex != root
            yield pa.RecordBatch.from_arrays([pa.array(vertex[keep]), pa.array(root[keep])], names=["high", "low"])

    def block(i: int):
        low, high = blocks[i]
        return F.shiftrightunsigned("print", low).bitwiseAND(F.lit((1 << (high - low)) - 1))

    keys = F.array(*[
        F.struct(F.lit(t).alias("tab"), (F.shiftleft(block(i), 13).bitwiseOR(block(j))).alias("key"))
        for t, (i, j) in enumerate(tables)
    ])
    placed = classes.select("print", F.inline(keys))
    parts = in_chunk_pairs(placed, ["tab", "key"], "print", chunk).select("tab", "part", "print")
    return (
        parts.repartition("tab", "part").sortWithinPartitions("tab", "part")
        .mapInArrow(by_whole_groups(100_000, 2, compare), "high long, low long")
    )


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, print, component_id (the smallest doc_id that it reaches by links)."""
    prints = checkpointed(fingerprints(documents, shingle))
    classes = checkpointed(prints.groupBy("print").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(classes.select("print"))).select(F.col("vertex").alias("print"), "root")
    known = classes.join(roots, "print", "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    smallest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = known.join(smallest, "root").select("print", "component_id")
    return prints.join(of_class, "print").select("doc_id", "print", "component_id")
