import math
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from weftwork.llm import components, embed_dedup, line_dedup, queries, simhash


def roots(vertices, edges):
    up = {v: v for v in vertices}

    def find(v):
        while up[v] != v:
            up[v] = up[up[v]]
            v = up[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {v: find(v) for v in vertices}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_union_find(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    got = {r.vertex: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    want = roots({v for e in edges for v in e}, edges)
    assert {v: r for v, r in want.items() if v in got} == got
    assert all(v in got for e in edges if e[0] != e[1] for v in e)


def test_components_of_no_edges(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a B", "Ä É x y Z z z z z z", "a b c d e f g h"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def near_prints(seed, count):
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(8)]
    found = {0}
    while len(found) < count:
        x = draw.choice(centres)
        for b in draw.sample(range(64), draw.randrange(6)):
            x ^= 1 << b
        found.add(x if draw.random() < 0.8 else draw.getrandbits(64))
    return sorted(found)


@pytest.mark.parametrize("chunk", [4096, 16])
def test_links_against_all_pairs(spark, chunk):
    prints = near_prints(3, 500)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    rows = spark.createDataFrame([(p,) for p in signed], "print long")
    edges = [(r.high, r.low) for r in simhash.links(rows, chunk).collect()]
    want = [(signed[i], signed[j]) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    assert roots(signed, edges) == roots(signed, want)


@pytest.mark.parametrize("chunk", [4096, 16])
def test_wide_links_against_all_pairs(spark, chunk):
    prints = near_prints(6, 400)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    rows = spark.createDataFrame([(p,) for p in signed], "print long")
    wide = {"blocks": simhash.WIDE_BLOCKS, "counters": 3}
    want = {(signed[i], signed[j]) for i in range(len(prints)) for j in range(len(prints)) if i != j and (prints[i] ^ prints[j]).bit_count() <= 7}
    assert roots(signed, [(r.high, r.low) for r in simhash.links(rows, chunk, **wide).collect()]) == roots(signed, want)
    least = {(r.high, r.low) for r in simhash.links(rows, chunk, **wide, shrink=simhash.least_partners).collect()}
    assert least <= want and {(a, min(b for x, b in want if x == a)) for a in signed if any(x == a and b < a for x, b in want)} <= least


def test_near_duplicates_defined_cases(documents, nothing):
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(documents).collect()}
    assert {(1, 1), (2, 1), (3, 3), (4, 3), (5, 3), (6, 6)} <= got
    assert simhash.near_duplicates(documents).count() == documents.count()
    assert simhash.near_duplicates(nothing).count() == 0


def plain_removed(rows, short=True, width=5):
    lines = []
    for doc, text in rows:
        for i, line in enumerate((text or "").split("\n")):
            words = [w for w in line.lower().split(" ") if w]
            if len(words) >= width or short and line.strip():
                lines.append((doc, i, {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))}))
    gone = defaultdict(set)
    for a, (doc, i, x) in enumerate(lines):
        if any(len(x & y) >= 0.8 * len(x | y) - 1e-9 for _, _, y in lines[:a]):
            gone[doc].add(i)
    return gone


@pytest.mark.parametrize("short, width", [(True, 5), (False, 5), (True, 1), (True, 2)])
def test_line_dedup_against_all_pairs(spark, short, width):
    draw = random.Random(5)
    base = [" ".join(draw.choice("abcdefghijklmnop") * draw.randrange(1, 3) for _ in range(draw.randrange(3, 30))) for _ in range(25)]
    rows = []
    for doc in range(60):
        text = []
        for _ in range(draw.randrange(6)):
            words = draw.choice(base).split()
            for _ in range(draw.choice([0, 0, 1, 2])):
                words[draw.randrange(len(words))] = draw.choice("xyz")
            text.append(" ".join(words))
        rows.append((doc, "\n".join(text)))
    found = line_dedup.summary(spark.createDataFrame(rows, "doc_id long, text string"), short, width).collect()
    want = plain_removed(rows, short, width)
    assert {r.doc_id: set(r.removed) for r in found} == {doc: want.get(doc, set()) for doc, _ in rows} and sum(map(len, want.values())) > 20


def test_line_dedup_defined_cases(documents, nothing):
    kept = line_dedup.deduplicate(documents)
    assert kept.columns == documents.columns and kept.count() == documents.count()
    texts = {r.doc_id: r.text for r in kept.where("doc_id is not null").collect()}
    assert texts[3] is None and texts[1] == "" and texts[8] == "short line\n\n" and texts[6] == "one"
    first = kept.where("doc_id is null").first().text
    assert first.count("\n") == 0 and first.startswith("the quick")
    assert line_dedup.summary(nothing).count() == 0


def test_line_dedup_short_lines(spark, tmp_path):
    rows = [
        (1, "Read more\nShare this page\n\nread  more"), (2, "share this page\nRead more now\n\n \t\n \t\none two three four five six"),
        (3, "one two three four five six\none\ntwo one\none two\none\none two three four"), (4, None),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.removed for r in queries.op8_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: [3], 2: [0], 3: [0, 4], 4: []}


def test_line_dedup_makes_tokens_of_candidates_only(spark, monkeypatch):
    """Lines that share a run but pass no filter are not fetched again."""
    sizes, written = {}, line_dedup._Tables.written

    def counted(self, rows, label):
        table = written(self, rows, label)
        sizes[label] = table.count()
        return table

    monkeypatch.setattr(line_dedup._Tables, "written", counted)
    rows = []
    for doc in range(60):
        words = [f"w{doc}x{i}" for i in range(30)]
        rows.append((doc, " ".join(words[:5]) + "\n" + " ".join(words)))
    assert sum(r.n_removed for r in line_dedup.summary(spark.createDataFrame(rows, "doc_id long, text string"), True).collect()) == 0
    assert sizes["members"] > 0 and sizes["tokens"] == 0


@pytest.mark.parametrize("copies, first", [(5, False), (40, True)])
def test_line_dedup_compares_only_large_groups_with_their_earliest_first(spark, monkeypatch, copies, first):
    labels, written = [], line_dedup._Tables.written
    monkeypatch.setattr(line_dedup._Tables, "written", lambda self, rows, label: labels.append(label) or written(self, rows, label))
    words = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(words))] + [(doc, " ".join(words[:-2] + [f"x{doc}", f"y{doc}"])) for doc in range(1, copies)]
    rows += [(100, " ".join(words[:-8] + ["z"] * 4)), (101, "\n".join(["none of these words is in them"] * 2))]
    got = line_dedup.summary(spark.createDataFrame(rows, "doc_id long, text string"), True).collect()
    want = plain_removed(rows)
    assert {r.doc_id: set(r.removed) for r in got} == {doc: want.get(doc, set()) for doc, _ in rows} and len(want) >= copies
    assert ("near-earliest" in labels) is first


def test_line_dedup_orders_only_prefixes_with_common_tokens(spark, monkeypatch):
    """Copies of a line are counted once; a prefix is that of the order by rank and hash, and common tokens come last in it."""
    monkeypatch.setattr(line_dedup, "ORDER_PARTS", 1)
    shared = " ".join(f"s{i}" for i in range(12))
    rows = [(doc, f"{shared} " + " ".join(f"w{doc}x{i}" for i in range(30))) for doc in range(20)]
    rows += [(100 + doc, " ".join(f"c{i}" for i in range(20)) + (" end" if doc == 9 else "")) for doc in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ranks = docs.select(line_dedup._rarity(docs, True, 5).alias("ranks")).first().ranks
    assert sum(r > 0 for r in ranks) == 8 and max(ranks) == int(3 * math.log2(20))
    lines = docs.select(F.col("text").alias("content"), "doc_id")
    found = line_dedup._with_tokens(lines, True, 5, line_dedup._rarity(docs, True, 5)).collect()
    for r in found:
        kept = len(r.tokens) - math.ceil(0.8 * len(r.tokens) - 1e-9) + 1
        best = sorted(r.tokens, key=lambda x: (ranks[x & (line_dedup.BUCKETS - 1)], x))
        assert r.tokens[:kept] == best[:kept] and len(set(r.tokens)) == len(r.tokens)
    assert any(r.tokens != sorted(r.tokens) for r in found) and any(r.tokens == sorted(r.tokens) for r in found)
    got = {r.doc_id: set(r.removed) for r in line_dedup.summary(docs, True).collect()}
    want = plain_removed(rows)
    assert got == {doc: want.get(doc, set()) for doc, _ in rows} and len(want) == 9


def vectors(seed):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((30, 24))
    rows = []
    for i in range(400):
        v = centres[i % 30] + draw.standard_normal(24) * draw.choice([0.0, 0.05, 0.12, 1.0])
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 30 // 10))
    return rows


def test_embeddings_against_all_pairs(spark):
    rows = vectors(4)
    odd = [(900, None, 0), (901, [0.0] * 24, 0), (902, [float("nan")] * 24, 0), (903, rows[0][1], None), (904, [], 0), (905, [1.0, None], 0)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in embed_dedup.near_duplicates(table).collect()}
    unit = np.array([v for _, v, _ in rows], np.float32).astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.98
    want = [(a, b) for a in range(400) for b in range(a) if close[a, b] and rows[a][2] == rows[b][2]]
    links = defaultdict(int)
    for a, b in want:
        links[a] += 1
        links[b] += 1
    assert sum(got[i].n_links for i in range(400)) >= 0.95 * sum(links.values())
    assert all(got[i].n_links <= links[i] for i in range(400))
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _, _ in odd)
    component = roots(range(400), want)
    assert sum(component[i] == got[i].component_id for i in range(400)) >= 380


def test_embeddings_empty_and_repeated(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert embed_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = embed_dedup.near_duplicates(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 0)] * 2 + [(2, [2.0, 4.0, 6.0], 0)], schema)).collect()
    assert [r.n_links for r in got] == [2, 2, 2] and {r.component_id for r in got} == {1}


@pytest.mark.parametrize("scale", [1.0, 1e200, 1e-200])
@pytest.mark.parametrize("kind, labels", [("string", "ab"), ("long", (1 << 40, 7)), ("int", (0, 1))])
def test_embeddings_of_doubles_and_any_label(spark, scale, kind, labels):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(60):
        v = rng.standard_normal(24)
        rows += [(3 * i, [float(x) * scale for x in v], labels[i % 2]), (3 * i + 1, [float(x) * scale * 3 for x in v], labels[i % 2])]
        rows.append((3 * i + 2, [float(x) for x in v + 0.4 * rng.standard_normal(24)], labels[1 - i % 2]))
    schema = f"vec_id long, embedding array<double>, label {kind}, filter string, class int, n int, root int"
    table = spark.createDataFrame([(*r, None, 1, 2, 3) for r in rows], schema)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(table).collect()}
    unit = {i: np.array(v) / scale_of for i, v, _ in rows for scale_of in [max(map(abs, v))]}
    label = {i: x for i, _, x in rows}
    cosine = lambda a, b: a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
    links = {i: sum(j != i and label[i] == label[j] and cosine(unit[i], unit[j]) >= 0.98 for j in unit) for i in unit}
    assert {i: n for i, (n, _) in got.items()} == links
    assert got[0] == (1, 0) and got[1] == (1, 0)


def test_embeddings_of_integers(spark):
    schema = "vec_id long, embedding array<int>, label string"
    got = embed_dedup.near_duplicates(spark.createDataFrame([(1, [1, 2], "a"), (2, [2, 4], "a"), (3, [0, 0], "a"), (4, [2, -1], "a")], schema))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == [(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4)]


def test_embeddings_with_a_third_in_one_cap(spark, monkeypatch):
    """A filter with more classes than a chunk, against all pairs."""
    monkeypatch.setattr(embed_dedup, "CHUNK", 40)
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(16)
    vectors = [centre + 0.14 * rng.standard_normal(16) for _ in range(200)] + list(rng.standard_normal((400, 16)))
    table = spark.createDataFrame([(i, [float(x) for x in v], "a") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label string")
    unit = np.stack(vectors) / np.linalg.norm(np.stack(vectors), axis=1)[:, None]
    links = ((unit @ unit.T) >= 0.98).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in embed_dedup.near_duplicates(table).collect()}
    assert sum(links) > 2000 and sum(got.values()) >= 0.9 * sum(links)
    assert all(n <= links[i] for i, n in got.items())
