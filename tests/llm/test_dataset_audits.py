import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from weftwork.llm import divergence, exact_dedup, merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, pos long, tree string, sha string, piece int, leaf string, row int"


def odd_rows(seed, count=900):
    """Rows of a hot source, groups of copies, nulls, blanks, ties, a repeated row, and non-ASCII words."""
    draw = random.Random(seed)
    words = [draw.choice("abcdefg") * draw.randrange(1, 4) + draw.choice(["", "é", "X", "ß"]) for _ in range(40)]
    rows = []
    for i in range(count):
        text = draw.choice([" ", "\n", " \t"]).join(draw.choices(words, k=draw.randrange(1, 25))) if i % 3 else "Same old\ttext" + " " * (i % 4)
        source = "hot" if i % 3 == 0 else draw.choice(["a", "B", "ä", "z z", None])
        rows.append((i, text, draw.choice(["en", "en", "de", None]), source, len(text)))
    rows += [(count, None, "en", "a", None), (count + 1, "", None, None, 0), (count + 2, " \n\x0b", "fr", "lone", 3), (5, rows[5][1], *rows[5][2:])]
    rows += [(None, "Sameoldtext and more of it", "en", "a", 1), (count + 3, "12 %%", "xx", "p", 5), (count + 4, "12 %%", "xx", "q", 5)]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, "t", "s", 0, "l", 0) for r in rows], SCHEMA).repartition(5)


def test_exact_groups_against_plain_grouping(spark):
    rows = odd_rows(1)
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc))
    want = Counter()
    for body, held in groups.items():
        keep = min(held, key=lambda h: (h[0], h[1], h[2] or 0))
        for i, h in enumerate(sorted(held, key=lambda h: (h[0], h[1], h[2] or 0))):
            want[h[2], keep[2], len(held), i == 0, hashlib.sha256(body.encode()).hexdigest()] += 1
    for pieces in (1, 7, exact_dedup.PIECES):
        assert Counter(tuple(r)[:5] for r in exact_dedup.groups(table(spark, rows), pieces).collect()) == want


def test_exact_defined_cases(spark, documents, nothing):
    assert exact_dedup.groups(nothing).count() == exact_dedup.deduplicate(nothing).count() == 0
    kept = exact_dedup.deduplicate(documents)
    assert kept.columns == documents.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda d: (d is None, d or 0)) == [1, 5, 6, 7, 8, 9, 10, None]
    assert sum(r.kept for r in exact_dedup.groups(documents).collect()) == kept.count()


def test_exact_splits_a_large_group(spark):
    """Copies of one text lie in several tasks of the sort, and texts are shuffled once."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'one and the same', concat('text ', id)) AS text")
    runs = exact_dedup._runs(docs, exact_dedup.PIECES)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = runs.where("sha = sha2('oneandthesame', 256)").selectExpr("spark_partition_id() AS p").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1
    assert runs._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("Exchange") == 1


def plain_audit(rows):
    texts = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
             for _, text, lang, source, _ in rows]
    found = set()
    for lang in {t[0] for t in texts}:
        mine = [t for t in texts if t[0] == lang]
        held = Counter(w for *_, words in mine for w in set(words))
        kept = sorted(w for w, n in held.items() if n >= 10)
        sources = sorted({t[1] for t in mine})
        counts = {s: Counter(w for _, x, words in mine if x == s for w in words) for s in sources}
        total = sum(counts.values(), Counter())

        def share(c):
            whole = sum(c[w] for w in kept) + 2 * len(kept)
            return {w: 1 + 10**9 * (c[w] + 2) // whole for w in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(total)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s][w], p[o][w]) for w in kept), o.encode()) for o in sources if o != s]
            terms = [(-f(p[s][w], q[w]), w.encode()) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                found |= {(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(items)}
    return found


def test_stripes_merged_in_small_steps(monkeypatch):
    """Groups cut by batches, a group longer than what is held at once, and the rows without a term."""
    rows = [("de", None, 0, ["a", "b"], [0, 0])] + [("de", b"w", 3, [f"s{i % 2}"], [i]) for i in range(9)] + [("de", b"x", 1, ["a"], [1])]
    rows += [("en", None, 0, ["a"], [0])] * 2 + [("en", b"w", 5, ["b", "a"], [2, 3])] * 2
    for held in (1, 3, 100):
        monkeypatch.setattr(divergence, "_ROWS", held)
        batches = [divergence._record(rows[i:i + 2]) for i in range(0, len(rows), 2)]
        got = [r for b in divergence._merged(10)(iter(batches)) for r in b.to_pylist()]
        assert [(r["lang"], r["term"], r["df"], dict(zip(r["sources"], r["counts"]))) for r in got] == [
            ("de", None, 0, {"a": 0, "b": 0}), ("de", "w", 27, {"s0": 20, "s1": 16}), ("en", None, 0, {"a": 0}), ("en", "w", 10, {"a": 6, "b": 4}),
        ]


@pytest.mark.parametrize("cells", [divergence.CELLS, 30])
def test_divergence_against_plain_counts(spark, cells):
    rows = odd_rows(2)
    got = [tuple(r) for r in divergence.audit(table(spark, rows), cells=cells).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(rows)


def test_divergence_of_no_rows(spark):
    assert divergence.audit(table(spark, []).limit(0)).count() == 0


def test_term_counts_of_long_texts(monkeypatch):
    monkeypatch.setattr(divergence, "_SLICE", 7)
    text = "Some WORDS, and äÖ some-more; averyveryverylongword 1x  end"
    want = Counter(w.encode() for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text)))
    assert divergence.term_counts(text.encode()) == want and divergence.term_counts(b"") == Counter()


def test_probabilities_are_exact():
    import numpy as np

    draw = random.Random(3)
    for _ in range(2000):
        total = draw.randrange(2, 1 << draw.randrange(2, 47))
        count = draw.randrange(total - 1)
        assert divergence.probabilities(np.array([count]), total)[0] == 1 + 10**9 * (count + 2) // total


def plain_manifest(rows):
    h = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    leaf = lambda *fields: h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields])

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
        return levels

    def steps(levels, i):
        for level in levels[:-1]:
            run, at = level[i // 16 * 16:i // 16 * 16 + 16], i % 16
            yield run[:at], run[at + 1:]
            i //= 16

    sources = defaultdict(list)
    for doc, text, lang, source, n in rows:
        hit = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0
        fake = re.sub("[A-Z]", lambda m: m[0].lower(), text) if hit and text is not None else text
        sources[source].append((doc is not None, doc or 0, leaf(doc, source, lang, n, text), leaf(doc, source, lang, n, fake), doc))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(sources[s])]) for s in names}
    top = climb([trees[s][-1][0] for s in names])
    found = Counter()
    for at, s in enumerate(names):
        for i, (*_, own, fake, doc) in enumerate(sorted(sources[s])):
            path = [*steps(trees[s], i), *steps(top, at)]
            folded = fake
            for left, right in path:
                folded = h(*left, folded, *right)
            proof = h(*[x for left, right in path for x in (*left, *right)])
            found[doc, own, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]] += 1
    return found


@pytest.mark.parametrize("rows", [
    odd_rows(4), [(1, "One", "en", "s", 3)], [(1, "One", "en", None, 3), (2, None, None, "", None)],
    [(i, "Text", "en", "big" if i < 4100 else f"s{i}", 4) for i in range(4400)],
], ids=["odd", "one row", "two sources", "deep"])
def test_manifest_against_plain_hashes(spark, rows):
    assert Counter(tuple(r) for r in merkle.audited(table(spark, rows)).collect()) == plain_manifest(rows)


def test_manifest_of_no_rows(spark):
    assert merkle.audited(table(spark, []).limit(0)).count() == 0


def test_manifest_paths_lead_to_the_root(spark):
    rows = [(i, f"text {i}", "en", "a" if i % 3 else None, 4) for i in range(700)]
    for r in merkle.manifest(table(spark, rows)).paths().collect():
        digest = r.leaf
        for step in r.path:
            digest = hashlib.sha256((step.left + digest + step.right).encode()).hexdigest()
        assert digest == r.root


@pytest.mark.parametrize("name", list(queries.SQL))
def test_queries_against_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    theirs = con.execute(queries.SQL[name])
    names = [c[0] for c in theirs.description]
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(names)
    assert Counter(tuple(r) for r in got.select(names).collect()) == Counter(theirs.fetchall())
