"""Benchmark passages in documents, also with other numbers, names and units.

Numbers, capitalised words and units of measure become typed placeholders. Windows of five such words are hashed on both sides and
joined; each shared window gives a place in the document where the item may stand. There all windows of the item are compared with the
document. A document holds an item if at one place the windows that agree cover at least 0.8 of the item's words and the values in
their placeholders are consistent: what stands for one value of the item is one value at that place. Of several places
the one with the largest coverage, then consistency, is reported. Windows may be shifted against each other by a fifth of the item.

Places come from windows in which three words are no placeholders; an item without such a window uses all its windows, and an item of
fewer than five words is one window. In an item with fewer than three words (or, if it is shorter, all its words) that are no placeholders,
the placeholders tell nothing: consistency is then the share of values that are the item's own. Windows of documents pass a Bloom filter
of fixed size before they are shuffled, and only texts with a possible place are read again.

Defined cases: null and empty texts and items hold nothing and are found nowhere; repeated documents or items give a row for each
pair of rows; a document is known by its text, so ids may be null or repeated; all columns but the ids and texts are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.textbytes import WORD_BYTES, flat, hashes, mix, runs, slices
from weftwork.session import scratch_path

WIDTH = 5
LITERALS = 3
SIMILARITY = 0.8
BLOOM_BITS = 1 << 23

# Units whose spelling stands for a measure.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds"
    " ton tons ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks"
    " month months year years dollar dollars euro euros cent cents percent degrees watt watts volt volts"
).split()

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (0x4E554D, 0x4E414D45, 0x554E4954))


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    starts, ends = runs(data, np.array([0, len(data)]), WORD_BYTES)
    return np.sort(hashes(data, starts, ends))


_UNITS = _unit_hashes()


def template_words(texts: pa.Array):
    """Keys of the words with placeholders, values of the placeholders (0 in other words), and borders of documents."""
    data, borders = flat(texts)
    low = _LOWER[data]
    accented = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)) + 1
    low[accented] += 32
    starts, ends = runs(data, borders, WORD_BYTES)
    values = hashes(low, starts, ends)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    number = (digits[ends] - digits[starts]) * 2 >= (ends - starts)
    changed = data != low
    second = np.minimum(starts + 1 + (data[starts] >= 0xC3), ends - 1) if len(starts) else starts
    name = (changed[starts] | (changed[np.minimum(starts + 1, ends - 1)] & (data[starts] == 0xC3)) if len(starts) else number)
    name = name & ~number & ~((ends - starts > 3) & changed[second]) if len(starts) else name
    unit = np.isin(values, _UNITS) & ~number & ~name
    keys = np.where(number, _NUMBER, np.where(name, _NAME, np.where(unit, _UNIT, values)))
    slots = np.where(number | name | unit, values, np.uint64(0))
    of_doc = np.searchsorted(starts, borders, side="left")
    # A number with points or commas, and a name of several words, is one placeholder.
    joined = np.zeros(len(keys), bool)
    if len(keys) > 1:
        near = starts[1:] - ends[:-1] == 1
        both_numbers = number[1:] & number[:-1] & near & np.isin(data[ends[:-1]], [44, 46])
        joined[1:] = both_numbers | (name[1:] & name[:-1])
        joined[of_doc[:-1][of_doc[:-1] < len(keys)]] = False
    head = np.cumsum(~joined) - 1
    folded = np.zeros(int(head[-1]) + 1 if len(head) else 0, np.uint64)
    np.add.at(folded, head, slots * np.where(joined, np.uint64(0x9E3779B97F4A7C15), np.uint64(1)))
    keep = np.flatnonzero(~joined)
    return keys[keep], folded, np.searchsorted(keep, of_doc, side="left")


def _windows(keys: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` keys from each position on."""
    n = max(0, len(keys) - width + 1)
    total = np.full(n, np.uint64(width), np.uint64)
    for k in range(width):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + keys[k:k + n])
    return total


def _window_rows(texts: pa.Array, widths: list[int]):
    keys, slots, of_doc = template_words(texts)
    literal = np.concatenate([[0], np.cumsum(slots == 0)])
    doc = np.repeat(np.arange(len(of_doc) - 1), np.diff(of_doc))
    for width in widths:
        hashed = _windows(keys, width)
        start = np.arange(len(hashed))
        inside = of_doc[doc[start] + 1] >= start + width
        start = start[inside]
        yield width, hashed[inside], doc[start], start - of_doc[doc[start]], literal[start + width] - literal[start], start, slots


def _rows(texts: pa.Array, rows: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([texts.take(pa.array(rows)), *[pa.array(c) for c in columns.values()]], names=["tag", *columns])


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows from which places come, of rows (tag, text)."""
    for batch in batches:
        for a, b in slices(batch.column(1)):
            texts = batch.column(1)[a:b]
            lengths = np.diff(template_words(texts)[2])
            for width, hashed, doc, pos, literal, _, _ in _window_rows(texts, list(range(1, WIDTH + 1))):
                mine = (lengths[doc] >= WIDTH) if width == WIDTH else (lengths[doc] == width)
                enough = literal >= min(LITERALS, width)
                any_enough = np.zeros(len(texts), bool)
                any_enough[doc[enough & mine]] = True
                at = np.flatnonzero(mine & (enough | ~any_enough[doc]))
                if len(at):
                    yield _rows(
                        batch.column(0)[a:b], doc[at], window=hashed[at].view(np.int64), pos=pos[at].astype(np.int32),
                        width=np.full(len(at), width, np.int32), words=lengths[doc[at]].astype(np.int32),
                    )


def _bloom(windows: DataFrame) -> np.ndarray:
    """Two bits for each window in a table of ``BLOOM_BITS`` bits, whatever the number of windows."""
    bit = F.explode(F.array(*[
        F.shiftrightunsigned("window", s).bitwiseAND(F.lit(BLOOM_BITS - 1)) for s in (0, 32)
    ]))
    words = (
        windows.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits")).collect()
    )
    table = np.zeros(BLOOM_BITS // 64, np.int64)
    for row in words:
        table[row["word"]] = row["bits"]
    return table.view(np.uint64)


def _document_windows(bloom: np.ndarray, widths: list[int]):
    mask = np.uint64(BLOOM_BITS - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                for _, hashed, doc, pos, _, _, _ in _window_rows(batch.column(1)[a:b], widths):
                    passed = np.ones(len(hashed), bool)
                    for shift in (0, 32):
                        bit = (hashed >> np.uint64(shift)) & mask
                        passed &= (bloom[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                    at = np.flatnonzero(passed)
                    if len(at):
                        yield _rows(batch.column(0)[a:b], doc[at], window=hashed[at].view(np.int64), pos=pos[at].astype(np.int32))

    return run


def _slack(words):
    """Words by which the windows of one place may be shifted against each other."""
    return words // 5


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Template words of a text around each place; rows (text, places: tag, item_tag, words, shift)."""
    for batch in batches:
        for text, places in zip(batch.column(0), batch.column(1)):
            keys, slots, _ = template_words(pa.array([text.as_py()], pa.string()))
            for some in _in_slices(places.as_py(), 256):
                parts = []
                for place in some:
                    slack = _slack(place["words"])
                    low = max(0, place["shift"] - slack)
                    parts.append((low, max(low, place["shift"] + place["words"] + slack)))
                yield pa.RecordBatch.from_arrays([
                    pa.array([p["tag"] for p in some], pa.int64()), pa.array([p["item_tag"] for p in some], pa.int64()),
                    pa.array([p["shift"] for p in some], pa.int32()), pa.array([low for low, _ in parts], pa.int32()),
                    pa.array([keys[a:b].view(np.int64) for a, b in parts], pa.list_(pa.int64())),
                    pa.array([slots[a:b].view(np.int64) for a, b in parts], pa.list_(pa.int64())),
                ], names=["tag", "item_tag", "shift", "low", "keys", "slots"])


def _templates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tag, text in zip(batch.column(0), batch.column(1)):
            keys, slots, _ = template_words(pa.array([text.as_py()], pa.string()))
            yield pa.RecordBatch.from_arrays([
                pa.array([tag.as_py()], pa.int64()), pa.array([keys.view(np.int64)], pa.list_(pa.int64())),
                pa.array([slots.view(np.int64)], pa.list_(pa.int64())),
            ], names=["item_tag", "item_keys", "item_slots"])


def at_place(
    keys: np.ndarray, slots: np.ndarray, shift: int, item_keys: np.ndarray, item_slots: np.ndarray
) -> tuple[float, float]:
    """Coverage and consistency of an item in words of a document, where the item begins at word ``shift``, give or take the slack."""
    n = len(item_keys)
    width, slack = min(WIDTH, n), _slack(n)
    mine, theirs = _windows(item_keys, width), _windows(keys, width)
    partner = np.full(n, -1)
    left = np.arange(len(mine))
    for by in sorted(range(-slack, slack + 1), key=abs):  # the nearest shift at which a window agrees
        at = left + shift + by
        fits = (at >= 0) & (at < len(theirs))
        fits[fits] = theirs[at[fits]] == mine[left[fits]]
        for k in range(width):
            words = left[fits] + k
            new = partner[words] < 0
            partner[words[new]] = words[new] + shift + by
        left = left[~fits]
    covered = np.flatnonzero(partner >= 0)
    filled = covered[item_slots[covered] != 0]
    was, now = item_slots[filled], slots[partner[filled]]
    if not len(was):
        consistency = 1.0
    elif np.count_nonzero(item_slots == 0) < min(LITERALS, n):
        consistency = float(np.mean(was == now))
    else:
        pairs, counts = np.unique(np.stack([was, now]), axis=1, return_counts=True)
        _, value = np.unique(pairs[0], return_inverse=True)
        most = np.zeros(int(value.max()) + 1, np.int64)
        np.maximum.at(most, value, counts)
        consistency = float(most.sum() / counts.sum())
    return len(covered) / n, consistency


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def column(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
        return [x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in batch.column(name)]

    for batch in batches:
        starts = (batch.column("shift").to_numpy() - batch.column("low").to_numpy()).tolist()
        items = zip(column(batch, "item_keys"), column(batch, "item_slots"))
        found = [
            at_place(keys, slots, start, *item)
            for keys, slots, start, item in zip(column(batch, "keys"), column(batch, "slots"), starts, items)
        ]
        yield pa.RecordBatch.from_arrays([
            batch.column("tag"), batch.column("item_tag"),
            pa.array([c for c, _ in found], pa.float64()), pa.array([c for _, c in found], pa.float64()),
        ], names=["tag", "item_tag", "coverage", "consistency"])


def _in_slices(rows: list, size: int) -> Iterator[list]:
    for i in range(0, len(rows), size):
        yield rows[i:i + size]


def _found(documents: DataFrame, benchmark: DataFrame, similarity: float) -> DataFrame:
    """Rows (tag, item_tag, coverage, consistency): texts of documents and of items in them, by their hashes."""
    texts = documents.select(F.xxhash64("text").alias("tag"), "text")
    items = benchmark.select(F.xxhash64("text").alias("tag"), "text").dropDuplicates(["tag"])
    item_windows = items.mapInArrow(_item_windows, "tag long, window long, pos int, width int, words int")
    widths = sorted(r["width"] for r in item_windows.select("width").distinct().collect())
    found = texts.mapInArrow(_document_windows(_bloom(item_windows), widths), "tag long, window long, pos int")
    of_item = item_windows.select("window", F.col("tag").alias("item_tag"), F.col("pos").alias("item_pos"), "words")
    # Written, so that its size is known: texts are not shuffled to meet a few places.
    path = scratch_path(documents.sparkSession, "places")
    (
        found.join(of_item, "window")
        .groupBy("tag", F.struct("tag", "item_tag", "words", (F.col("pos") - F.col("item_pos")).alias("shift")).alias("place")).count()
        .select("tag", "place", F.pmod(F.xxhash64("place"), F.lit(64)).alias("deal"))
        .groupBy("tag", "deal").agg(F.collect_list("place").alias("places")).select("tag", "places").write.parquet(path)
    )
    places = documents.sparkSession.read.parquet(path)
    again = texts.join(places.select("tag").distinct(), "tag", "left_semi").dropDuplicates(["tag"])
    segments = again.join(places, "tag").select("text", "places").mapInArrow(
        _segments, "tag long, item_tag long, shift int, low int, keys array<long>, slots array<long>"
    )
    templates = items.mapInArrow(_templates, "item_tag long, item_keys array<long>, item_slots array<long>")
    judged = segments.join(templates, "item_tag").mapInArrow(
        _judged, "tag long, item_tag long, coverage double, consistency double"
    )
    best = F.max(F.struct("coverage", "consistency")).alias("best")
    return (
        judged.where((F.col("coverage") >= similarity) & (F.col("consistency") >= similarity))
        .groupBy("tag", "item_tag").agg(best).select("tag", "item_tag", "best.*")
    )


def leaks(documents: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, coverage, consistency."""
    tag = F.xxhash64("text")
    return (
        documents.select("doc_id", tag.alias("tag")).join(_found(documents, benchmark, similarity), "tag")
        .join(benchmark.select("item_id", tag.alias("item_tag")), "item_tag")
        .select("doc_id", "item_id", "coverage", "consistency")
    )


def remove_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without those that hold an item of the benchmark."""
    found = _found(documents, benchmark, SIMILARITY).select("tag").distinct()
    return documents.withColumn("leak_tag", F.xxhash64("text")).join(
        found.withColumnRenamed("tag", "leak_tag"), "leak_tag", "left_anti"
    ).select(*documents.columns)
