"""Near-duplicate documents: shingles of five words, SimHash, then Jaccard similarity of 0.8 or more, every pair of them.

Candidates come first from fingerprints of 64 bits, by the bit-sliced comparison of ``simhash`` with its wide radius of seven bits, and are
verified on their shingles. At that similarity fingerprints differ in 10 bits on average and in up to 18, which no choice of blocks
selects, so an exact set join finds the pairs that fingerprints have not connected. Shingles are ordered by rarity, counted in buckets on the texts whose
hash falls in one of ``ORDER_PARTS`` (any fixed order is exact); documents that match share one of the rarest n - ceil(0.8 n) + 1 of each
and pass the length and positional filters of line dedup. A sketch of each document counts its shingles in ``CELLS`` cells: two
documents have at most the sum of the smaller counts in common, so most candidates fall before their shingles are made. What is left is
verified on all shingles.

Documents of equal shingles are one class. In the set join classes that share a shingle are first compared with the earliest of them only;
what is not connected by that is compared with all.

Defined cases: a text with fewer words than a shingle is one shingle; null, empty and blank texts are one shingle of no
words. A row is known by its doc_id and the hash of its text, null ids included; rows without an id come last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm import simhash
from weftwork.llm.components import components
from weftwork.llm.line_dedup import _SLACK, ORDER_PARTS, SIMILARITY, _candidates, _Tables
from weftwork.llm.textbytes import NOT_SPACE, flat, hashes, mix, runs, slices

SHINGLE = 5
BUCKETS = 1 << 16  # of shingle hashes; shingles of one bucket are counted together
CELLS = 256  # of a sketch
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _shingles(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as hashes, ascending."""
    data, borders = flat(texts)
    starts, ends = runs(data, borders, NOT_SPACE)
    words = hashes(_LOWER[data], starts, ends)
    of_doc = np.searchsorted(starts, borders, side="left")
    for a, b in zip(of_doc[:-1].tolist(), of_doc[1:].tolist()):
        width = min(SHINGLE, b - a)
        count = b - a - width + 1
        total = np.full(count, np.uint64(width), np.uint64)
        for k in range(width):
            total = mix(total * np.uint64(0x9E3779B97F4A7C15) + words[a + k:a + k + count])
        yield np.unique(total)


def _each(column: pa.Array) -> Iterator[np.ndarray]:
    for a, b in slices(column):
        yield from _shingles(column[a:b])


def _rarity(documents: DataFrame) -> np.ndarray:
    """For each bucket of shingle hashes the logarithm of its number of shingles: 0 to 127."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for found in _each(batch.column(0)):
                counts += np.bincount((found >> np.uint64(8)).astype(np.int64) & (BUCKETS - 1), minlength=BUCKETS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    ranks = np.zeros(BUCKETS, np.uint64)
    part = documents.select("text").where(F.pmod(F.xxhash64("text"), F.lit(ORDER_PARTS)) == 0)
    for row in part.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        ranks[row["bucket"]] = min(127, int(3 * np.log2(1 + row["n"])))
    return ranks


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _prefixes(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, tag, class, n, prefix, sketch, print); ``tag`` is the hash of the text, ``class`` that of its shingles."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    ranks = _rarity(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(2)):
                classes, sizes, kept, sketches, prints = [], [], [], [], []
                for found in _shingles(batch.column(2)[a:b]):
                    low = found >> np.uint64(8)
                    ranked = np.sort((ranks[(low & np.uint64(BUCKETS - 1)).astype(np.int64)] << np.uint64(56)) | low)
                    n = len(found)
                    classes.append(xxhash.xxh3_64_intdigest(found.tobytes()))
                    sizes.append(n)
                    kept.append(ranked[:n - int(np.ceil(n * SIMILARITY - _SLACK)) + 1])
                    sketches.append(np.bincount((found & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS).astype("<u4").tobytes())
                    prints.append(simhash.majority(found))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[a:b], batch.column(1)[a:b], pa.array(np.array(classes, np.uint64).view(np.int64)),
                    pa.array(np.array(sizes, np.int32)), _lists(kept), pa.array(sketches, pa.binary()),
                    pa.array(np.array(prints, np.uint64).view(np.int64)),
                ], names=["doc_id", "tag", "class", "n", "prefix", "sketch", "print"])

    return documents.select("doc_id", F.xxhash64("text").alias("tag"), "text").mapInArrow(
        run, f"doc_id {kind}, tag long, class long, n int, prefix array<long>, sketch binary, print long"
    )


def _class_shingles(rows: DataFrame) -> DataFrame:
    """Rows (class, tokens) of rows (class, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], _lists(list(_shingles(batch.column(1)[a:b])))], names=["class", "tokens"]
                )

    return rows.select("class", "text").mapInArrow(run, "class long, tokens array<long>")


def _fingerprint_links(classes: DataFrame, leads: DataFrame) -> DataFrame:
    """Pairs (later, earlier) of classes (class, print) with equal or near fingerprints; ``leads`` holds one class (lead) of each print.

    Of a class with many such partners not every pair comes out; the set join compares what these do not connect.
    """
    equal = classes.join(leads, "print").where(F.col("class") != F.col("lead")).select(F.col("class").alias("later"), F.col("lead").alias("earlier"))
    near = simhash.links(leads.select("print"), blocks=simhash.WIDE_BLOCKS, counters=3, shrink=simhash.least_partners)
    high = leads.select(F.col("print").alias("high"), F.col("lead").alias("later"))
    low = leads.select(F.col("print").alias("low"), F.col("lead").alias("earlier"))
    return equal.unionByName(near.distinct().join(high, "high").join(low, "low").select("later", "earlier"))


def _apart(pairs: DataFrame, root: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component (class, root)."""
    for end in ("later", "earlier"):
        pairs = pairs.join(root.select(F.col("class").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
    return pairs.where(F.coalesce("later_root", "later") != F.coalesce("earlier_root", "earlier")).select("later", "earlier")


def _verified(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    later = tokens.select(F.col("class").alias("later"), F.col("tokens").alias("x"))
    earlier = tokens.select(F.col("class").alias("earlier"), F.col("tokens").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(later, "later").join(earlier, "earlier")
        .where(common >= SIMILARITY * (F.size("x") + F.size("y") - common) - _SLACK).select("later", "earlier")
    )


def _plausible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (later, earlier) that may have enough shingles in common by their sketches (class, n, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, CELLS) for i in (2, 3))
            sizes = batch.column(4).to_numpy() + batch.column(5).to_numpy()
            common = np.minimum(x, y).sum(axis=1, dtype=np.int64)
            near = common >= SIMILARITY / (1 + SIMILARITY) * sizes - _SLACK
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(near)), batch.column(1).filter(pa.array(near))], names=["later", "earlier"])

    later = sketches.select(F.col("class").alias("later"), F.col("sketch").alias("x"), F.col("n").cast("long").alias("x_n"))
    earlier = sketches.select(F.col("class").alias("earlier"), F.col("sketch").alias("y"), F.col("n").cast("long").alias("y_n"))
    both = pairs.join(later, "later").join(earlier, "earlier").select("later", "earlier", "x", "y", "x_n", "y_n")
    return both.mapInArrow(run, "later long, earlier long")


def removed_documents(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, tag): documents connected by near duplicates to an earlier one, by doc_id and hash of the text."""
    tables = _Tables(documents.sparkSession)
    texts = documents.select("doc_id", F.xxhash64("text").alias("tag"), "text")

    def shingles_of(pairs: DataFrame, label: str, known: DataFrame | None = None) -> DataFrame:
        """Rows (class, tokens) of the classes of these pairs, without the known ones, from the text of each one's first document."""
        classes = pairs.select(F.explode(F.array("later", "earlier")).alias("class")).distinct()
        if known is not None:
            classes = classes.join(known, "class", "left_anti")
        # Written, so that its size is known: texts are not shuffled to meet a short list.
        wanted = tables.written(
            first.join(classes, "class").select("class", F.col("first.doc_id").alias("held_by"), F.col("first.tag").alias("tag")), f"{label}-wanted"
        )
        held = texts.join(wanted, (texts["tag"] == wanted["tag"]) & texts["doc_id"].eqNullSafe(wanted["held_by"]))
        return tables.written(_class_shingles(held), label).dropDuplicates(["class"])  # of rows with equal id and text

    rows = tables.written(_prefixes(documents), "doc-prefixes")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag")
    first = tables.written(rows.groupBy("class").agg(F.min(place).alias("first")), "doc-firsts")
    # Rows of one class have the same prefix, sketch and print.
    classes = tables.written(rows.select("class", "n", "prefix", "sketch", "print").dropDuplicates(["class"]), "doc-classes")
    rows = tables.written(rows.select("doc_id", "tag", "class"), "doc-places")
    tables.drop("doc-prefixes")
    entries = classes.select("class", "n", F.posexplode("prefix").alias("at", "token"))
    shared = tables.written(
        entries.groupBy("token").agg(F.count("*").alias("holders")).where(F.col("holders") > 1).select("token"), "doc-shared"
    )
    members = tables.written(entries.join(shared, "token").join(first, "class"), "doc-members")
    sketches = tables.written(classes.select("class", "n", "sketch"), "doc-sketches")
    prints = tables.written(classes.select("class", "print"), "doc-prints")
    tables.drop("doc-classes", "doc-shared")

    leads = tables.written(prints.groupBy("print").agg(F.min("class").alias("lead")), "doc-leads")
    found = _fingerprint_links(prints, leads)
    pairs = tables.written(_plausible(found, sketches), "doc-pairs-prints")
    tokens = shingles_of(pairs, "doc-tokens-prints")
    near = tables.written(_verified(pairs, tokens), "doc-near-prints")
    earliest = members.groupBy("token").agg(F.min(F.struct("first", "class", "n", "at")).alias("e")).select("token", "e.*")
    for label, others, all_shared in (("earliest", earliest, False), ("all", members, True)):
        root = tables.written(components(near), f"doc-roots-{label}").withColumnRenamed("vertex", "class")
        found = _apart(_candidates(members, others, all_shared), root)
        pairs = tables.written(_plausible(found, sketches), f"doc-pairs-{label}")
        tokens = tokens.unionByName(shingles_of(pairs, f"doc-tokens-{label}", tokens.select("class")))
        near = near.unionByName(tables.written(_verified(pairs, tokens), f"doc-near-{label}"))
    root = components(near).withColumnRenamed("vertex", "class")
    known = first.join(root, "class", "left").withColumn("root", F.coalesce("root", "class"))
    kept = known.groupBy("root").agg(F.min("first").alias("kept"))
    removed = tables.written(
        rows.join(known.select("class", "root"), "class").join(kept, "root")
        .where(place != F.col("kept")).select("doc_id", "tag").distinct(),
        "doc-removed",
    )
    tables.drop_all_but_last()
    return removed


def deduplicate(documents: DataFrame) -> DataFrame:
    """``documents`` without near duplicates of an earlier one, and each of those left once."""
    removed = removed_documents(documents).select(F.col("doc_id").alias("gone_id"), F.col("tag").alias("gone_tag"))
    rows = documents.withColumn("kept_tag", F.xxhash64("text"))
    left = rows.join(
        removed, (F.col("kept_tag") == F.col("gone_tag")) & rows["doc_id"].eqNullSafe(F.col("gone_id")), "left_anti"
    )
    return left.dropDuplicates(["doc_id", "kept_tag"]).select(*documents.columns)
