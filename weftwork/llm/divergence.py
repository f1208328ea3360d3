"""How the word use of each source differs from that of the other sources and of its language, by in-mapper stripes.

A task folds whole documents into stripes: for each term of a language the number of documents and the occurrences in each source.
It writes its stripes to the shuffle when it is done, or when they hold ``CELLS`` counts. They are merged by (lang, term) in
sorted order, one stripe at a time. With the totals of each group, stripes are turned into divergences directly:
per batch, sums over its terms for each pair of sources, and its ten best terms of each source. Spark adds the sums and ranks.

Work is dealt by term, so a source or language with a third of all documents is spread like any other. For each language, the list of its sources
is one row, which joins the stripes as Spark decides by its size; the result itself has a row for each pair of these sources.

Probabilities are p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and divergences f = floor((p - q)^2 / (p + q)), in 64-bit integers
without overflow up to 2^48 occurrences.

Defined cases: null text, lang and source are ''; a text without terms still makes its group known; a language with no term in
``least`` documents gives pairs of value 0 and no terms; repeated rows count as often as they are there. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftwork.session import checkpointed

LEAST = 10  # documents of a language that hold a term
BEST = 10  # terms reported for a group
CELLS = 400_000  # counts that a task holds
SCALE = 1_000_000_000
_STEP = 31_250  # divides SCALE; keeps products below 2^63
_SLICE = 1 << 22
_ROWS = 1 << 16
_TABLE_CELLS = 1 << 20
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)  # A-Z in lower case, other letters and non-ASCII bytes as they are, else a space

_STRIPE = "lang string, term string, df long, sources array<string>, counts array<long>"


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term in a UTF-8 text, cut between terms so that a long text is not listed whole."""
    counts: Counter = Counter()
    spaced = text.translate(_TERM_BYTES)
    start = 0
    while start < len(spaced):
        stop = spaced.find(b" ", start + _SLICE)
        stop = len(spaced) if stop < 0 else stop
        counts.update(spaced[start:stop].split())
        start = stop
    return counts


def _record(rows: list[tuple]) -> pa.RecordBatch:
    lang, term, df, sources, counts = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(lang, pa.string()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(df, pa.int64()),
            pa.array(sources, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64())),
        ],
        names=["lang", "term", "df", "sources", "counts"],
    )


def _in_batches(rows: Iterator[tuple], size: int = 8192) -> Iterator[pa.RecordBatch]:
    waiting = []
    for row in rows:
        waiting.append(row)
        if len(waiting) == size:
            yield _record(waiting)
            waiting = []
    if waiting:
        yield _record(waiting)


def _folded(cells: int):
    """Folds rows (lang, source, text) into stripes; a stripe without a term names the sources of a language."""

    def emptied(stripes: dict, seen: dict) -> Iterator[tuple]:
        for lang, terms in stripes.items():
            for term, (df, by) in terms.items():
                yield lang, term, df, list(by), list(by.values())
        for lang, sources in seen.items():
            yield lang, None, 0, list(sources), [0] * len(sources)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes: dict[str, dict[bytes, list]] = {}
        seen: dict[str, set] = {}
        held = 0
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                seen.setdefault(lang, set()).add(source)
                terms = stripes.setdefault(lang, {})
                for term, n in term_counts(text.as_py()).items():
                    stripe = terms.get(term)
                    if stripe is None:
                        terms[term] = [1, {source: n}]
                        held += 1
                        continue
                    stripe[0] += 1
                    by = stripe[1]
                    if source in by:
                        by[source] += n
                    else:
                        by[source] = n
                        held += 1
                if held >= cells:
                    yield from _in_batches(emptied(stripes, seen))
                    stripes, seen, held = {}, {}, 0
        yield from _in_batches(emptied(stripes, seen))

    return run


def _add_up(table: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """Stripes sorted by (lang, term), whole groups of them, added up; only those of terms in ``least`` documents are unpacked."""
    langs, terms = table.column("lang").combine_chunks(), pc.fill_null(table.column("term"), "").combine_chunks()
    new = np.ones(len(terms), bool)
    for column in (langs, terms):
        same = pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        new[1:] = ~same if column is langs else new[1:] | ~same
    starts = np.flatnonzero(new)
    df = np.add.reduceat(table.column("df").to_numpy(), starts)
    kept = (df >= least) | pc.equal(terms.take(pa.array(starts)), "").to_numpy(zero_copy_only=False)
    group = np.cumsum(new) - 1
    rows = table.filter(pa.array(kept[group])).combine_chunks()
    if rows.num_rows == 0:
        return
    lists = rows.column("sources").combine_chunks()
    sources = pc.dictionary_encode(lists.flatten())
    owner = group[kept[group]][pc.list_parent_indices(lists).to_numpy()]
    cell, at = np.unique(owner * len(sources.dictionary) + sources.indices.to_numpy(), return_inverse=True)
    counts = np.zeros(len(cell), np.int64)
    np.add.at(counts, at, rows.column("counts").combine_chunks().flatten().to_numpy())
    owner, source = np.divmod(cell, len(sources.dictionary))
    ends = np.searchsorted(owner, np.flatnonzero(kept), side="right")
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    first = pa.array(starts[kept])
    yield pa.RecordBatch.from_arrays(
        [
            langs.take(first), table.column("term").combine_chunks().take(first), pa.array(df[kept]),
            pa.ListArray.from_arrays(offsets, sources.dictionary.take(pa.array(source))), pa.ListArray.from_arrays(offsets, pa.array(counts)),
        ],
        names=["lang", "term", "df", "sources", "counts"],
    )


def _merged(least: int):
    """Merges stripes that come sorted by (lang, term), some batches at a time; the last group waits for what follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows < _ROWS:
                continue
            table = pa.Table.from_batches(waiting)
            last = table.slice(rows - 1).to_pylist()[0]
            same = pc.and_(pc.equal(table.column("lang"), last["lang"]), pc.equal(pc.fill_null(table.column("term"), ""), last["term"] or ""))
            ended = pc.index(same, True).as_py()
            if ended:
                yield from _add_up(table.slice(0, ended), least)
                waiting = table.slice(ended).combine_chunks().to_batches()
            else:  # one term alone, from very many tasks
                waiting = list(_add_up(table, 0))
            rows = sum(b.num_rows for b in waiting)
        if rows:
            yield from _add_up(pa.Table.from_batches(waiting), least)

    return run


def stripes(documents: DataFrame, least: int = LEAST, cells: int = CELLS) -> DataFrame:
    """Rows (lang, term, df, sources, counts) of the terms kept, and for each language one with a null term and all its sources."""
    rows = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    folded = rows.mapInArrow(_folded(cells), _STRIPE)
    by_term = folded.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return by_term.mapInArrow(_merged(least), _STRIPE)


def probabilities(counts: np.ndarray, totals) -> np.ndarray:
    """1 + floor(SCALE (counts + 2) / totals), exact: the product is divided in two steps."""
    whole, rest = np.divmod((counts + 2) * _STEP, totals)
    return 1 + whole * (SCALE // _STEP) + rest * (SCALE // _STEP) // totals


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _of_language(terms: list[str], counts: np.ndarray, names: list[str], totals: np.ndarray, kept: int, best: int) -> Iterator[tuple]:
    """Rows (source, part, item, value) of some terms: sums for each pair of sources, and the best terms of each source."""
    p = probabilities(counts, totals + 2 * kept)
    q = probabilities(counts.sum(axis=1), totals.sum() + 2 * kept)
    for i in range(len(names)):
        sums = divergence(p[:, i:i + 1], p[:, i + 1:]).sum(axis=0).tolist()
        for other, value in zip(names[i + 1:], sums):
            yield names[i], "pair", other, value
            yield other, "pair", names[i], value
        more = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > q))
        value = divergence(p[more, i], q[more])
        for k in np.argsort(-value, kind="stable")[:best].tolist():
            yield names[i], "term", terms[more[k]], int(value[k])


def _emitted(best: int):
    """Divergences of rows (lang, term, sources, counts, names, totals, kept)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = pc.dictionary_encode(batch.column(0))
            for code in range(len(langs.dictionary)):
                at = np.flatnonzero(langs.indices.to_numpy() == code)
                names = batch.column(4)[int(at[0])].values
                totals = batch.column(5)[int(at[0])].values.to_numpy()
                kept = batch.column(6)[int(at[0])].as_py()
                words = batch.column(1).take(pa.array(at)).to_pylist()
                order = sorted(range(len(words)), key=words.__getitem__)  # by code point, which is the order of UTF-8
                rows = max(1, _TABLE_CELLS // len(names))
                for a in range(0, len(order), rows):
                    some = order[a:a + rows]
                    mine = pa.array(at[some])
                    sources, values = batch.column(2).take(mine), batch.column(3).take(mine)
                    counts = np.zeros((len(some), len(names)), np.int64)
                    counts[pc.list_parent_indices(sources).to_numpy(), pc.index_in(sources.flatten(), names).to_numpy()] = values.flatten().to_numpy()
                    found = _of_language([words[i] for i in some], counts, names.to_pylist(), totals, kept, best)
                    if out := list(found):
                        source, part, item, value = zip(*out)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([langs.dictionary[code].as_py()] * len(out)), pa.array(source), pa.array(part), pa.array(item), pa.array(value, pa.int64())],
                            names=["lang", "source", "part", "item", "value"],
                        )

    return run


def audit(documents: DataFrame, least: int = LEAST, best: int = BEST, cells: int = CELLS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank); see the head of the module."""
    merged = checkpointed(stripes(documents, least, cells))
    terms = merged.where(F.col("term").isNotNull())
    groups = (
        merged.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("cell"))
        .groupBy("lang", F.col("cell.sources").alias("source")).agg(F.sum("cell.counts").alias("n"))
    )
    languages = (
        groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups"))
        .join(terms.groupBy("lang").agg(F.count("*").alias("kept")), "lang", "left")
        .select("lang", F.col("groups.source").alias("names"), F.col("groups.n").alias("totals"), F.coalesce("kept", F.lit(0)).alias("kept"))
    )
    # A language's terms are dealt over as many tasks as there are, each of which gets the language's row.
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = terms.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(parts)))
    copies = languages.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    with_totals = dealt.join(copies, ["lang", "part"]).select("lang", "term", "sources", "counts", "names", "totals", "kept")
    found = with_totals.mapInArrow(_emitted(best), "lang string, source string, part string, item string, value long")
    without = (
        languages.where("kept = 0").select("lang", F.explode("names").alias("source"), F.lit("pair").alias("part"), "names")
        .select("lang", "source", "part", F.explode("names").alias("item"), F.lit(0).cast("long").alias("value"))
        .where(F.col("source") != F.col("item"))
    )
    summed = found.unionByName(without).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = summed.withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= best))


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
),
words AS (
    SELECT row, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 10),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
cells AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY ALL),
sources AS (SELECT DISTINCT lang, source FROM docs),
totals AS (
    SELECT lang, source, coalesce(sum(c), 0)::HUGEINT AS n FROM sources LEFT JOIN cells USING (lang, source) GROUP BY ALL
),
full_cells AS (
    SELECT lang, t.source, term, coalesce(c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c, 0) + 2)) // (n + 2 * v) AS p
    FROM totals t JOIN kept USING (lang) JOIN vocabulary USING (lang) LEFT JOIN cells USING (lang, source, term)
),
whole AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(c) + 2)) // (any_value(total) + 2 * any_value(v)) AS q
    FROM full_cells JOIN (SELECT lang, sum(n)::HUGEINT AS total FROM totals GROUP BY lang) USING (lang) JOIN vocabulary USING (lang)
    GROUP BY lang, term
),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM full_cells a JOIN full_cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    UNION ALL
    SELECT a.lang, a.source, 'pair', b.source, 0 FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    WHERE a.lang NOT IN (SELECT lang FROM vocabulary)
),
terms AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
    FROM full_cells JOIN whole USING (lang, term) WHERE c > 0 AND p > q
),
ranked AS (
    SELECT lang, source, part, item, value::BIGINT AS value,
        (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
