"""Packing of tokenised documents into windows by the sum-of-squares rule.

Each partition packs its own documents as they come. A document is cut into full windows and a rest; the rest goes to the fill
level that makes the sum of the squared numbers of partly filled windows smallest, over an array with one count per
level. At the end the emptiest windows are taken apart and cut to fill the gaps of the fullest, so that at most one window per
partition is not full. Ids of open windows take at most ``HELD`` bytes of a task: when documents would go over it, as many of the emptiest
windows as need be are taken apart in the same way, one at a time, and all others stay open under the same rule.

The byte-level vocabulary is read from its rank file: the ids are those of the tokenizer file of the same vocabulary (a test
compares the two on whole tables), in a quarter of its time. The added tokens that the tokenizer file beside it lists, such as
<|endoftext|>, are cut out of the text and get their own ids, as there.

Defined cases: null and empty texts are the end token alone; every row is packed, repeated rows too. The result depends on how
rows are spread over partitions; a partition that is run again gives the same rows.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 2048
END_TOKEN = 1
HELD = 64 << 20  # bytes of ids in the open windows of a task

_encoders: dict[str, Encoder] = {}


def _added_tokens(path: str) -> dict[str, int]:
    """Added tokens of the tokenizer file beside the rank file; none if there is no such file."""
    beside = os.path.splitext(path)[0] + ".json"
    if not os.path.exists(beside):
        return {}
    with open(beside, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if any(token[k] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"Added token {token['content']!r} is not matched as it stands")
    return {token["content"]: token["id"] for token in added}


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes; added tokens in the text have their ids."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=_added_tokens(path)
        )

    def encode(self, text: str) -> bytes:
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Packer:
    """Windows of one partition. ``rows`` holds finished pieces until they are taken."""

    def __init__(self, first_id: int, window: int = WINDOW, held: int = HELD):
        self.window, self.next_id, self.held = window, first_id, held
        self.bytes = 0  # of ids in open windows
        self.counts = np.zeros(window + 1)  # partly filled windows at each level
        self.counts[window] = -0.5  # so that filling a window counts as leaving its level only
        self.open: list[list[list[tuple]]] = [[] for _ in range(window)]
        self.n_open = 0
        self.rows: list[tuple] = []

    def _finish(self, pieces: list[tuple]) -> None:
        """Rows of a window that is no longer open."""
        offset = 0
        for doc, start, ids, total in pieces:
            length = len(ids) // 4
            self.rows.append((doc, start, length, zlib.crc32(ids), total, self.next_id, offset))
            offset += length
        self.next_id += 1

    def add(self, doc, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while total - at >= self.window:
            self._finish([(doc, at, ids[4 * at:4 * (at + self.window)], total)])
            at += self.window
        if at < total:
            self._place((doc, at, ids[4 * at:], total), total - at)

    def _place(self, piece: tuple, size: int) -> None:
        counts, room = self.counts, self.window - size
        level, best = 0, 2 * counts[size] + 1
        if self.n_open:
            change = np.where(counts[1:room + 1] > 0, 2 * (counts[size + 1:] - counts[1:room + 1]) + 2, np.inf)
            if room and change[at := room - 1 - int(np.argmin(change[::-1]))] <= best:
                level = at + 1
        pieces = self._take(level) if level else []
        pieces.append(piece)
        self._put(level + size, pieces)
        while self.bytes > self.held and self.n_open > 1:
            self._empty_one()

    def _take(self, level: int) -> list[tuple]:
        self.counts[level] -= 1
        self.n_open -= 1
        self.bytes -= 4 * level
        return self.open[level].pop()

    def _put(self, level: int, pieces: list[tuple]) -> None:
        if level == self.window:
            self._finish(pieces)
        elif level:
            self.open[level].append(pieces)
            self.counts[level] += 1
            self.n_open += 1
            self.bytes += 4 * level

    def _empty_one(self) -> None:
        """Move ids from the emptiest open window into the fullest until the one is empty or the other is full."""
        levels = np.flatnonzero(self.counts[:self.window])
        fill, left = int(levels[-1]), int(levels[0])
        taker, giver = self._take(fill), self._take(left)
        while giver and fill < self.window:
            doc, start, ids, total = giver.pop()
            stay = max(0, len(ids) // 4 - (self.window - fill))
            taker.append((doc, start + stay, ids[4 * stay:], total))
            fill += len(ids) // 4 - stay
            left -= len(ids) // 4 - stay
            if stay:
                giver.append((doc, start, ids[:4 * stay], total))
        self._put(fill, taker)
        self._put(left, giver)

    def close(self) -> None:
        """Empty the emptiest windows into the gaps of the fullest, and finish all."""
        while self.n_open > 1:
            self._empty_one()
        if self.n_open:
            self._finish(self._take(int(np.flatnonzero(self.counts[:self.window])[0])))


_SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(documents: DataFrame, tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece of a document: its place in the document and in its window.

    A window that is not full is to be padded to the next power of two. ``tokenizer`` is the path of a rank file.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.tiktoken")
    kind = documents.schema["doc_id"].dataType.simpleString()

    def rows_out(packer: Packer, doc_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*packer.rows)) or [[]] * 7
        packer.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], doc_type), *[pa.array(c, pa.int64()) for c in columns[1:]]],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        packer, doc_type = Packer(TaskContext.get().partitionId() << 40, window), None
        end = np.array([END_TOKEN], "<u4").tobytes()
        for batch in batches:
            doc_type = batch.schema.field(0).type
            for doc, text in zip(batch.column(0), batch.column(1)):
                packer.add(doc.as_py(), encode(text.as_py() or "") + end)
            yield rows_out(packer, doc_type)
        packer.close()
        if packer.rows:
            yield rows_out(packer, doc_type)

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {_SCHEMA}")
