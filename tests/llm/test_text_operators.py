import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftwork.llm import decontaminate, html_text, langid, license, packing, quality, toxicity


def held(doc, modulus, remainder):
    return zlib.crc32(str(doc).encode()) % modulus == remainder


@pytest.fixture(scope="module")
def real(spark):
    folder = "/root/testdata/sf0.01"
    return {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels", "benchmark", "pages")}


def accuracy(scored, labels, label):
    rows = scored.join(labels, "doc_id").collect()
    assert all(r.held_out == held(r.doc_id, *((3, 1) if label == "toxic" else (4, 2))) for r in rows)
    rows = [r for r in rows if r.held_out]
    return sum((r.score >= 0.7) == (r[label] == 1) for r in rows) / len(rows)


def test_toxicity_held_out(real):
    model = toxicity.fit(real["documents"], real["labels"])
    assert accuracy(toxicity.score(real["documents"], model), real["labels"], "toxic") > 0.92


def test_quality_held_out(real):
    model = quality.fit(real["documents"], real["labels"])
    scored = quality.score(real["documents"], model)
    assert accuracy(scored, real["labels"], "quality") > 0.92
    assert quality.keep_accepted(real["documents"], model).count() == scored.where("score >= 0.7").count()


def test_language_held_out(real):
    found = langid.predict(real["documents"], langid.fit(real["documents"])).join(real["documents"], "doc_id").where("held_out")
    assert found.where("lang_pred = lang").count() >= 0.97 * found.count()


def test_segments_against_all(spark):
    draw = np.random.default_rng(3)
    for _ in range(200):
        scores = draw.integers(-4, 5, draw.integers(1, 12)).tolist()

        def best(a, b):
            """The maximal segments of scores[a:b], by taking the best and going on beside it."""
            options = [(sum(scores[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)]
            if not options or max(options)[0] <= 0:
                return []
            total, length, start = max(options)
            i, j = -start, -start - length
            return [*best(a, i), (i, j, total), *best(j, b)]

        assert sum(s for *_, s in toxicity.segments(scores)) == sum(s for *_, s in best(0, len(scores)))


def test_marginals_against_all_labels():
    draw = np.random.default_rng(1)
    good, change = draw.standard_normal(5), draw.standard_normal((2, 2))
    total, mine = 0.0, np.zeros(5)
    for code in range(32):
        labels = [code >> i & 1 for i in range(5)]
        weight = np.exp(sum(g for g, l in zip(good, labels) if l) + sum(change[a, b] for a, b in zip(labels, labels[1:])))
        total += weight
        mine += weight * np.array(labels)
    belief, _ = quality.marginals(np.append(good, 0.3), change, np.array([0, 5, 6]))
    assert np.allclose(belief[:5], mine / total)


def test_packing_round_trip(real):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pieces = packing.pack(real["documents"].repartition(3)).collect()
    texts = {r.doc_id: r.text or "" for r in real["documents"].collect()}
    ids = {d: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for d, t in texts.items()}
    covered, windows = {}, {}
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id])
        assert zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes()) == p.ids_crc32
        covered.setdefault(p.doc_id, []).append((p.start, p.length))
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans, sizes in ((covered, {d: len(x) for d, x in ids.items()}), (windows, None)):
        for key, parts in spans.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at and length > 0
                at += length
            assert at == sizes[key] if sizes else at <= 2048
    assert sum(sum(n for _, n in w) < 2048 for w in windows.values()) <= 3


def test_packing_added_tokens(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "one \n<|endoftext|>\n two", "<|endoftext", "a <|endoftext|>"]
    pieces = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)).collect()
    ids = {d: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for d, t in enumerate(texts)}
    assert {p.doc_id: (p.doc_tokens, p.ids_crc32) for p in pieces if p.length == p.doc_tokens} == {
        d: (len(x), zlib.crc32(x.tobytes())) for d, x in ids.items()
    }


def test_packing_empties_windows():
    packer = packing.Packer(0, window=16)
    sizes = [5, 7, 9, 3, 40, 1, 16, 11, 13]
    for i, size in enumerate(sizes):
        packer.add(i, np.arange(size, dtype="<u4").tobytes())
    packer.close()
    assert sum(r[2] for r in packer.rows) == sum(sizes) and packer.next_id == -(-sum(sizes) // 16)


def levels_of(packer):
    return sorted(level for level, windows in enumerate(packer.open) for _ in windows)


def test_packing_follows_the_sum_of_squares():
    """Every document goes where the squared counts of partly filled windows, listed for all places, have the least sum."""
    rng = np.random.default_rng(3)
    packer, levels, window = packing.Packer(0, window=24), [], 24
    for i, size in enumerate(rng.integers(1, 24, 800)):
        size = int(size)
        packer.add(i, np.arange(size, dtype="<u4").tobytes())

        def cost(place):
            after = Counter(levels)
            after[place] -= 1
            after[place + size] += 1
            return sum(n * n for level, n in after.items() if 0 < level < window)

        places = [0, *sorted({x for x in levels if x + size <= window})]
        least = min(map(cost, places))
        place = max(p for p in places if cost(p) == least)
        levels = sorted([*(levels[:levels.index(place)] + levels[levels.index(place) + 1:] if place else levels), place + size])
        levels = [x for x in levels if x < window]
        assert levels_of(packer) == levels
    assert len(levels) > 1


@pytest.mark.parametrize("sizes", [[13] * 5000, [13, 9, 23, 40] * 1500])
def test_packing_with_little_memory(sizes):
    """Documents of which no two share a window keep windows open until the bound on bytes."""
    packer = packing.Packer(0, window=24, held=4 * 13 * 3000)
    most = 0
    for i, size in enumerate(sizes):
        packer.add(i, np.arange(size, dtype="<u4").tobytes())
        most = max(most, packer.n_open)
        assert packer.bytes == 4 * sum(levels_of(packer)) <= 4 * 13 * 3000
    assert most > 2048 or sizes[1] != 13
    packer.close()
    pieces = {}
    for doc, start, length, *_ in packer.rows:
        pieces.setdefault(doc, []).append((start, length))
    for doc, size in enumerate(sizes):
        at = 0
        for start, length in sorted(pieces[doc]):
            assert start == at and length > 0
            at += length
        assert at == size
    assert packer.next_id == -(-sum(sizes) // 24) and packer.bytes == 0


def test_leaks_are_those_of_plain_search(real):
    items = {r.item_id: r.text for r in real["benchmark"].collect()}
    want = {(r.doc_id, i) for r in real["documents"].collect() for i, t in items.items() if t in (r.text or "")}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(real["documents"], real["benchmark"]).collect()}
    assert want and got == want


def test_leaks_with_other_values(spark, documents, nothing):
    items = spark.createDataFrame([
        (1, "Yesterday Tom bought 9 apples for 2.50 euros and then Tom sold 1 apples to Ben."), (2, None), (3, ""), (4, "two words"),
    ], "item_id long, text string")
    other = "Yesterday {} bought 12 apples for 3 dollars and then {} sold 4 apples to Peter Miller."
    docs = spark.createDataFrame(
        [(1, other.format("Anna", "Anna")), (2, "Nothing of the kind was ever said here."), (3, None)], "doc_id long, text string"
    )
    assert [(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()] == [(1, 1)]
    assert decontaminate.leaks(docs, items.limit(0)).count() == decontaminate.leaks(nothing, items).count() == 0
    assert decontaminate.remove_leaks(documents, items).count() == documents.count()


def test_leaks_by_place(spark):
    template = "Yesterday {0} bought {1} apples for {2} euros and then {0} sold {1} apples to {3}."
    items = spark.createDataFrame([
        (1, template.format("Tom", 9, 2, "Ben")), (2, "Oslo 45 km"),
        (3, "Tom 5 Ann 7 Bob 9 Jim 11 what is the total of Eve 3 Kim 8 Leo 2 Max 6 Sue 1"),
        (4, "the box of 5 pens costs 5 coins and 5 nails"),
    ], "item_id long, text string")
    copies = [template.format(*x) for x in (("Tom", 9, 2, "Ben"), ("Anna", 4, 8, "Eve"), ("Carl", 6, 3, "Max"))]
    places = " we ran on to Paris 7 miles, then Rome 8 km, " * 40
    docs = spark.createDataFrame([
        (1, " so it was and ".join(copies)), (2, " so it was and ".join(copies[1:])), (3, "the box of 1 pens costs 2 coins and 3 nails"), (4, places + "near Oslo 45 km" + places),
        (5, places), (6, "He asked what is the total of it all and left."),
        (7, "Ann 1 Eve 2 Kim 3 Leo 4 what is the total of Tom 5 Ben 6 Max 7 Sue 8 Jim 9"),
        (8, copies[0].replace("euros and then", "euros and so then")),
    ], "doc_id long, text string")
    found = {(r.doc_id, r.item_id): (r.coverage, r.consistency) for r in decontaminate.leaks(docs, items).collect()}
    assert set(found) == {(1, 1), (2, 1), (4, 2), (7, 3), (8, 1)}
    assert found[1, 1] == found[2, 1] == found[4, 2] == (1.0, 1.0)


PAGE = """<html><head><title>T</title><script>if (a < b) { x = "<p>no</p>"; }</script></head><body><header>Site</header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div id="main">@</div><div class="sidebar"><p>Other news of the day and of the week</p></div>
<section class="comments"><p>What a long and thoughtful comment this reader wrote below the text</p></section>
<form><p>Subscribe</p></form><footer>&copy; 2020</footer></body></html>"""
ARTICLE = "<h1>A &amp; B</h1><p>First  paragraph\n with <b>bold</b> words,<br>and more of them in it.<p>Second&nbsp;paragraph, also of some length.</p>"


def test_several_passages_count():
    """The chance of the r best segments, for the r for which it is least; segments that chance explains add nothing."""
    model = toxicity.Model(*[np.zeros(0)] * 4, 0.0, 1.0, 1.0, 1.0, 1.0, 0.0)
    noise = np.log(101.0)
    plain = {r: 6.0 * r - (r - 1) * np.log(2 * 6.0 * r) + np.log(float(math.factorial(r) * math.factorial(r - 1))) for r in range(1, 6)}
    for r in range(1, 6):
        one, more = toxicity.evidence(model, 100, [6.0 + noise] * r + [1.0])
        assert one == pytest.approx(6.0) and one + more == pytest.approx(max(plain[i] for i in range(1, r + 1)))
    assert toxicity.evidence(model, 100, []) == (pytest.approx(-noise), 0.0)


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "{}", "<div><div>{}</div></div>"])
def test_html(wrap):
    text = html_text.main_text(PAGE.replace("@", wrap.format(ARTICLE)))
    assert text == "A & B\nFirst paragraph with bold words, and more of them in it.\nSecond paragraph, also of some length."


@pytest.mark.parametrize("page, text", [("", ""), ("only text", "only text"), ("<p", "<p"), ("<p>a<div>b", "a\nb"), ("</p></p>x", "x")])
def test_html_odd(page, text):
    assert html_text.main_text(page) == text


LONG = "<p>" + "The long article has words here and there. " * 8 + "</p>"
REST = '<div class="sidebar"><p>side text words</p></div><div class="cookie-bar"><p>We use cookies on this site</p></div>'


@pytest.mark.parametrize("inner", ["{}", "<article>{}</article>"])
@pytest.mark.parametrize("box", ["no-sidebar", "site has-menu", "content-with-widget", "alert-news"])
def test_html_theme_classes(box, inner):
    page = f'<body><nav><a href="x">menu</a></nav><div class="{box}">{inner.format(LONG * 3)}</div>{REST}</body>'
    assert html_text.main_text(page) == "\n".join([" ".join(["The long article has words here and there."] * 8)] * 3)


@pytest.mark.parametrize("box", ["sidebar", "post-comments", "comments-area", "ad-slot", "related", "popup-open", "newsletter"])
def test_html_named_boxes_go(box):
    page = f'<body><div class="story">{LONG}</div><div id="{box}"><p>{"Not the article at all. " * 14}</p></div></body>'
    assert html_text.main_text(page) == " ".join(["The long article has words here and there."] * 8)


def test_html_comments_longer_than_the_article():
    page = f'<body><article><h1>T</h1>{LONG}</article><div class="post-comments"><article>{LONG * 9}</article></div></body>'
    assert html_text.main_text(page).count("The long article") == 8


def test_html_articles_by_density():
    """A linked teaser marked as an article is left out, a second article and text beside the element are taken."""
    teaser = '<article class="card"><a href="x">A teaser of another story is here</a></article>'
    second = f"<article><h2>Second</h2>{LONG}</article>"
    beside = f"<div>{LONG.replace('long', 'other')}</div>"
    text = html_text.main_text(f"<body><article>{LONG * 2}</article>{teaser}{second}{beside}</body>")
    assert "teaser" not in text
    assert "Second" in text and text.count("The long article") == 24 and text.count("The other article") == 8


def test_html_clashing_columns(spark):
    rows = [(1, "u", "<p>a b</p>", "x", 5, 6), (1, "u", "<p>a b</p>", None, None, None)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long, filter int")
    assert [tuple(r) for r in html_text.extract(table).collect()] == [(1, "u", "a b", 3)] * 2


def test_html_deep_and_null(spark):
    table = spark.createDataFrame([(1, None, None), (2, "u", "<div>" * 3000 + "deep")], "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(table).collect()}
    assert got == {1: ("", 0), 2: ("deep", 4)}
    assert html_text.extract(table.limit(0)).count() == 0


WRAPPED_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of\nthis software and associated documentation files"
    " (the Software), to deal in the\nSoftware without restriction, including without limitation the rights to use,\n"
    "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the\nSoftware, and to permit others to do so."
)


def test_licences(spark, documents, nothing):
    docs = spark.createDataFrame([
        (1, "some words of a story\nLicensed under the Apache License, Version 2.0.\nmore words"), (2, "Released under the MIT License."),
        (3, "He got his driver license in May"), (4, None), (5, ""), (2, "Released under the MIT License."),
        (6, "This work is licensed under the GNU General Public License, version 3."), (7, "the end of the story of the river"),
        (8, "A title\n \t\n" + WRAPPED_MIT + "\nIt ends here."), (9, "SPDX-License-Identifier: Apache-2.0"), (10, "License: MIT"),
        (11, "word " * 3000 + "Licensed under CC BY 4.0. " + "word " * 3000), (12, "The boat was granted a license to fish by the port."),
        (13, "Licensed under the Eclipse Public License, version 2.0."), (None, "Released under the MIT License."),
        (14, "You must renew your driving license before version 2 of the form is released under the new law."),
    ], "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("family", F.lit(1))
    model = license.fit(docs)
    got = sorted(((r.doc_id or 0, r.paragraph, r.family) for r in license.scan(docs, model).collect()))
    assert got == [
        (0, 0, "mit"), (1, 1, "apache-2.0"), (2, 0, "mit"), (2, 0, "mit"), (6, 0, "gpl"), (8, 2, "mit"), (9, 0, "apache-2.0"),
        (10, 0, "mit"), (11, 0, "cc-by"), (13, 0, license.UNKNOWN),
    ]
    assert license.scan(documents, model).count() == 0
    assert license.scan(nothing, model).count() == 0
    assert license.scan(nothing, license.fit(nothing)).count() == 0


def test_licence_paragraphs(spark):
    """Unwrapping against a loop over the lines."""
    rng = np.random.default_rng(5)
    parts = ["", " ", "short", "x" * 49 + ".", "y" * 50, "y" * 51, "a long line that goes on " * 3 + "\t", "a long line that ends here " * 3 + "end.", "Ä" * 60 + " \r"]
    texts = ["\n".join(rng.choice(parts, rng.integers(1, 9))) for _ in range(200)]

    def plain(text):
        lines = [line.rstrip(" \t\r\f") for line in text.split("\n")[:-1]] + text.split("\n")[-1:]
        found = []
        for i, line in enumerate(lines):
            before = lines[i - 1] if i else ""
            if len(before) > license.WRAPPED and before[-1] not in ".!?:;" and line.strip():
                found[-1] += " " + line
            else:
                found.append(line)
        return found

    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.parts for r in rows.select("id", license._paragraphs(F.col("text")).alias("parts")).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_trained_operators_defined_cases(documents, nothing, labels):
    for rows in (documents, nothing):
        for known in (labels, labels.limit(0)):
            for module in (toxicity, quality):
                scored = module.score(rows, module.fit(rows, known))
                assert scored.where(F.col("score").between(0, 1)).count() == rows.count()
        found = langid.predict(rows, langid.fit(rows))
        assert found.count() == rows.count()
        assert packing.pack(rows).agg(F.count_distinct("doc_id").alias("n")).first().n == rows.select("doc_id").distinct().where("doc_id is not null").count()
    und = {r.doc_id: r.lang_pred for r in langid.predict(documents, langid.fit(documents)).collect()}
    assert und[3] == und[4] == und[5] == und[10] == "und" and und[9] in ("de", "en")


def test_licence_windows_grow_with_the_length_of_a_paragraph(spark, monkeypatch):
    model = license.Model(["mit"], [0.0], [("permission", 1.5), ("sell copies", 0.5)], ["permission"], [[0.0] * 5] * 3)
    text = "permission " + "word other " * 4_000 + "sell copies"
    seen, evidence = [], license._evidence
    monkeypatch.setattr(license, "_evidence", lambda rows, *more: (seen.append(rows), evidence(rows, *more))[1])
    license.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    rows = seen[0]
    held = [F.length(c) for c, kind in rows.dtypes if kind == "string"]
    assert rows.agg(F.sum(sum(held, F.lit(0)))).first()[0] <= 4 * len(text)
    known = rows.select(license._weighed("grams", model).alias("x")).where(F.size("x") > 0)
    assert sorted(r.x for r in known.collect()) == [["permission"], ["sell copies"]]
    logits = license._logits(rows, model, ["key"]).collect()
    assert sorted({r.logits[0] for r in logits}) == [0.0, 0.5, 1.5]


def test_licence_learners_pass_over_few_partitions(spark, monkeypatch):
    seen = []

    class Short(license.LogisticRegression):
        def fit(self, dataset, params=None):
            seen.append(dataset.rdd.getNumPartitions())
            return self.setMaxIter(1)._fit(dataset)

    monkeypatch.setattr(license, "LogisticRegression", Short)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        license.fit(spark.createDataFrame([(1, "You may sell copies of the book without a license.")], "doc_id long, text string"))
    finally:
        spark.conf.set(key, before)
    assert len(seen) == 2 + license.FOLDS and max(seen) <= 4
