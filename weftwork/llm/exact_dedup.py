"""Exact duplicates by a content sort.

Texts are equal if they are identical without the characters space, tab, line feed, vertical tab, form feed and carriage return.
Rows are range-partitioned by sampled splitters over the normalised text and sorted (Spark's external sort), so that equal
texts are neighbours, and each text is compared in full with the one before it. The order is by the first characters, then by a 64-bit
hash of the whole, a piece, and the text itself: a splitter is then short however long texts are, so the driver never holds texts.
``piece`` is a hash of the id. It lets splitters fall inside a group of copies: a group with a third of all rows is spread over a third
of the tasks, in up to ``PIECES`` runs. Runs of one text, found by comparison, are then merged by the text's SHA-256, a few short rows each.

Of equal texts the row with the most code points in the original text stays, then the one with the smallest id.

Defined cases: null texts count as empty, and empty and blank texts are one group; rows without an id come after those with one, so
``keep_id`` is null only if no row of the group has an id; of repeated rows one stays. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork.session import checkpointed

SPACES = " \t\n\x0b\x0c\r"
HEAD = 16  # characters of a splitter
PIECES = 4096  # runs that a group may be split into


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def _runs(documents: DataFrame, pieces: int) -> DataFrame:
    """Rows (doc_id, n, sha, piece, leads, best, size): each row's run, whether it leads it, the leader's id and the run's length."""
    texts = documents.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n"), normalised(F.col("text")).alias("body"))
    keyed = texts.select(
        "doc_id", "n", "body", F.substring("body", 1, HEAD).alias("head"), F.xxhash64("body").alias("mark"),
        F.pmod(F.xxhash64("doc_id"), F.lit(pieces)).cast("int").alias("piece"),
    )
    place = ["head", "mark", "piece"]
    order = ["body", F.desc("n"), F.asc_nulls_last("doc_id")]
    ordered = keyed.repartitionByRange(*place).sortWithinPartitions(*place, *order)
    # The range partitioning already has rows of one (head, mark, piece) together, so no window shuffles again.
    neighbours = Window.partitionBy(*place).orderBy(*order)
    compared = ordered.select(
        "doc_id", "n", *place, F.sha2("body", 256).alias("sha"),
        (~F.col("body").eqNullSafe(F.lag("body").over(neighbours))).alias("leads"),
    )
    # A second text with the same head and hash begins a run of its own.
    by_text = Window.partitionBy(*place, "sha")
    return compared.select(
        "doc_id", "n", "sha", "piece", "leads", F.count("*").over(by_text).alias("size"),
    )


def groups(documents: DataFrame, pieces: int = PIECES) -> DataFrame:
    """One row per row of ``documents``: doc_id, keep_id, group_size, kept, text_sha256 of the normalised text, n_chars."""
    rows = checkpointed(_runs(documents, pieces))
    leaders = rows.where("leads")
    of_text = Window.partitionBy("sha")
    first = of_text.orderBy(F.desc("n"), F.asc_nulls_last("doc_id")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = leaders.select(
        "sha", "piece", F.first("doc_id").over(first).alias("keep_id"), F.sum("size").over(of_text).alias("group_size")
    )
    return rows.join(merged, ["sha", "piece"]).select(
        "doc_id", "keep_id", "group_size", (F.col("leads") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"), F.col("n").alias("n_chars"),
    )


def deduplicate(documents: DataFrame, pieces: int = PIECES) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns."""
    left = groups(documents, pieces).where("kept").select(
        F.col("doc_id").alias("stay_id"), F.col("text_sha256").alias("stay_sha"), F.col("n_chars").alias("stay_n")
    )
    rows = documents.withColumns({
        "own_sha": F.sha2(normalised(F.col("text")), 256), "own_n": F.length(F.coalesce("text", F.lit(""))),
    })
    same = (F.col("own_sha") == F.col("stay_sha")) & (F.col("own_n") == F.col("stay_n")) & rows["doc_id"].eqNullSafe(F.col("stay_id"))
    return rows.join(left, same, "left_semi").dropDuplicates(["doc_id", "own_sha", "own_n"]).select(*documents.columns)


SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS whole FROM documents),
bodies AS (SELECT doc_id, length(whole) AS n, regexp_replace(whole, '[\x20\x09-\x0D]', '', 'g') AS body FROM texts)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
    row_number() OVER best = 1 AS kept, sha256(body) AS text_sha256
FROM bodies WINDOW best AS (PARTITION BY body ORDER BY n DESC, doc_id NULLS LAST)
"""
