"""Operators that SQL cannot express, against brute force, bounds and held-out rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from conftest import awkward_rows, result

import corpus_pipeline
from signalstats.llm import graph, html, license, mixing, ngram_join, queries, toxicity
from signalstats.llm.common import stored

# -- components ---------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    nodes = [rng.randrange(-(2**62), 2**62) for _ in range(60)]
    edges = [tuple(rng.sample(nodes, 2)) for _ in range(45)] + list(zip(nodes, nodes[1:], strict=False))[:25]
    edges += [(nodes[0], nodes[0]), edges[0], (None, nodes[1])]
    parent = {n: n for e in edges if None not in e for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert result(got, "node", "root") == sorted(((n, find(n)) for n in parent), key=repr)


def test_components_of_nothing(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_trie_walk_agrees_with_plain_overlaps():
    rng = np.random.default_rng(5)
    for _ in range(30):
        probe = np.unique(rng.integers(0, 150, 90).astype(np.uint64))
        sets = [np.unique(rng.choice(probe, rng.integers(1, len(probe) + 1))) for _ in range(10)]
        sets += [np.unique(np.concatenate([probe, rng.integers(0, 200, k).astype(np.uint64)])) for k in range(0, 60, 6)]
        sets += [probe, np.zeros(0, np.uint64)]
        plain = [100 * len(np.intersect1d(probe, s)) >= 80 * len(np.union1d(probe, s)) for s in sets]
        assert ngram_join._overlaps(probe, sets, 80) == plain
        assert any(plain) and not all(plain)


def _shared_at_least(x, y):
    return max(-(-80 * (x + y) // 180) - -(-80 * max(x, y) // 100) + 1, 1)


def test_needed_shingles_hold_for_every_size_between(spark):
    rows = [(n, low, high) for n in range(1, 140, 3) for low in (-(-80 * n // 100), n) for high in range(n, 125 * n // 100 + 1)]
    got = spark.createDataFrame(rows, "n long, low long, high long").withColumn("need", ngram_join._needed(80)).collect()
    for n, low, high, need in got:
        assert need == min(_shared_at_least(n, size) for size in range(low, high + 1)), (n, low, high)


def test_sets_of_sizes_between_others_stay_able(spark):
    # 91 of 113 shingles are common to a and b, which share eight first ones; c holds one of them.
    rows = [(t, s, n, s) for s, n, tokens in ((1, 100, 8), (2, 104, 8), (3, 105, 1)) for t in range(tokens)]
    shared = spark.createDataFrame(rows, "token long, set_a long, n long, root long")
    able = {r.set_a: (r.c, r.need) for r in ngram_join._able(shared, 80).collect()}
    assert able == {1: (8, 8), 2: (8, 8)}


# -- mixing -------------------------------------------------------------------


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 5, "b": 3, "c": 0.2, "d": 1.7}, dict(zip("abcdefg", range(1, 8), strict=True))])
def test_every_prefix_of_a_period_deviates_by_less_than_a_block(weights):
    shares = mixing.quantised(weights, 100)
    assert sum(shares.values()) == 100
    given = Counter()
    for slot, source in enumerate(mixing.pfair_period(shares), 1):
        given[source] += 1
        assert all(abs(given[s] - n * slot / 100) < 1 for s, n in shares.items())


def _scheduled(blocks, weights, quanta):
    """Slot by slot: the released block with the earliest deadline."""
    slots, start = [], 0
    left = {s: n for s, n in blocks.items() if n}
    while left:
        shares = mixing.quantised({s: weights[s] for s in left}, max(quanta, len(left)))
        total, given = sum(shares.values()), Counter()
        slot = 0
        while all(left.values()):
            ready = [
                (-(-(given[s] + 1) * total // n), s) for s, n in shares.items() if given[s] * total // n <= slot
            ]
            source = min(ready)[1]
            slots.append(source)
            given[source] += 1
            left[source] -= 1
            slot += 1
        left = {s: n for s, n in left.items() if n}
        start += slot
    return slots


def test_mix_follows_the_schedule_and_keeps_every_row(spark, docs, rows):
    weights = {"hot": 2.0, "s": 1.0}
    got = mixing.mix_sources(docs, weights, block_rows=4)
    assert set(docs.columns) <= set(got.columns)
    found = got.select("doc_id", "text", "source", "block", "slot", "position").collect()
    kept = sorted(((r.doc_id, r.text, r.source) for r in found), key=repr)
    assert kept == sorted(rows, key=repr)
    assert len({r.position for r in found}) == len(found)
    sizes = Counter(r[2] or "" for r in rows)
    blocks = {s: -(-n // 4) for s, n in sizes.items()}
    target = {s: weights.get(s, n**0.7) for s, n in sizes.items()}
    slots = _scheduled(blocks, target, mixing.QUANTA)
    by_slot = {r.slot: r.source or "" for r in found}
    assert [by_slot[i] for i in range(len(slots))] == slots
    per_block = Counter((r.source or "", r.block) for r in found)
    assert all(n == 4 for (s, b), n in per_block.items() if b < blocks[s] - 1)


def test_weights_hold_however_long_a_phase_is():
    # One large and many small sources: with weights in 4,096ths the large one fell behind by thousands of blocks.
    sizes = {"hot": 10**9, **{f"s{i}": 100 for i in range(999)}}
    weights = {s: n**0.7 for s, n in sizes.items()}
    total, blocks = sum(weights.values()), {s: -(-n // 32) for s, n in sizes.items()}
    given = Counter()
    for slot, (source, block) in enumerate(mixing.schedule(blocks, weights), 1):
        assert block == given[source]
        given[source] += 1
        assert abs(given["hot"] - weights["hot"] / total * slot) < 1
        if slot == 150_000 or blocks[source] == given[source]:
            break
    assert slot > 10_000 and sum(given.values()) == slot


def test_mix_of_nothing(no_docs):
    assert mixing.mix_sources(no_docs).collect() == []


def test_too_many_sources_are_refused(spark):
    many = spark.range(mixing.MAX_SOURCES + 1).selectExpr("id AS doc_id", "'x' AS text", "string(id) AS source")
    with pytest.raises(ValueError):
        mixing.mix_sources(many)


def test_any_number_of_sources_is_mixed_on_request(spark, sf_dir):
    many = spark.range(mixing.MAX_SOURCES + 200).selectExpr("id AS doc_id", "'x' AS text", "string(id) AS source")
    many = many.unionByName(many.where("doc_id < 40").withColumn("source", F.lit("7")))
    got = corpus_pipeline.mix(spark, many, sf_dir).collect()
    assert len(got) == mixing.MAX_SOURCES + 240
    assert {r.slot for r in got} == set(range(mixing.MAX_SOURCES + 201))


# -- html ---------------------------------------------------------------------

ARTICLE = "<article><h1>Title &amp; more</h1><p>One\n  <b>bold</b><br>line&nbsp;two<p>Unclosed <i>p</i></article>"
CASES = [
    (None, ""),
    ("", ""),
    ("plain text &lt;b&gt;", "plain text <b>"),
    (ARTICLE, "Title & more\nOne bold line two\nUnclosed p"),
    (f"<body><header>H</header><nav>N</nav>{ARTICLE}<footer>F</footer>", "Title & more\nOne bold line two\nUnclosed p"),
    ("<p>a<!-- x > y --><p>b<script>var t='</p><p>no';</script>c", "a\nbc"),
    ("<div class='cookie-notice'>no</div><div id=comments><p>no</p></div><p>yes</p>", "yes"),
    ("<main><aside>no</aside><p>yes</p><form>no<p>no</p></form></main><p>out</p>", "yes"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"),
    ('<p title="a > b">x</p><p title=\'<p>\'>y</p>', "x\ny"),
    ("<p>&#233;&eacute;&amp;amp; &am &amp", "éé&amp; &am &"),
    ("<article class=comment><p>no</p></article><p>yes</p>", "yes"),
    ("< p > 1 < 2 & 3", "< p > 1 < 2 & 3"),
    ("<p>" + "long " * 200_000 + "</p>", ("long " * 200_000).strip()),
]


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_extracted_text(spark, broadcast_rows):
    rows = [(i, f"http://h{i}.example/x", page) for i, (page, _) in enumerate(CASES)]
    rows += [(None, None, "<p>x"), (None, None, "<p>x"), (3, "http://h3.example/x", ARTICLE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS text")
    got = html.extract_text(pages, max_broadcast_rows=broadcast_rows)
    want = [(i, url, text) for (i, url, _), (_, text) in zip(rows, CASES, strict=False)]
    want += [(None, None, "x")] * 2 + [(3, "http://h3.example/x", CASES[3][1])]
    assert result(got, "page_id", "url", "text", "n_chars") == sorted(((*w, len(w[2])) for w in want), key=repr)


@pytest.mark.parametrize(
    "page, want",
    [
        ("<div id=page class='site has-sidebar'><p>yes</p></div>", "yes"),
        ("<main class='site-main no-sidebar'><p>yes</p></main>", "yes"),
        ("<article class='post comments-open'><p>yes</p></article>", "yes"),
        ("<section id=search-engines><p>yes</p></section>", "yes"),
        ("<div class=banner><div><article><p>yes</p></article></div></div>", "yes"),
        ("<div class=sidebar><main><p>yes</p><div class=share-buttons>no</div></main></div>", "yes"),
        ("<article><p>yes</p></article><div class=sidebar><article><p>no</p></article></div>", "yes"),
        ("<article><p>yes</p><div id=comments><article class=comment-body>no</article></div></article>", "yes"),
        ("<div class='main-menu'>no</div><ul id=footer-links><li>no</ul><p>yes</p>", "yes"),
        ("<article><h2 id=binary-search>a</h2><h2 id=cookies>b</h2><p id=simple-notice>c</p></article>", "a\nb\nc"),
        ("<article><p>yes</p><ol class=commentlist><li>no</ol><div id=respond>no</div></article>", "yes"),
        ("<article><p>a <math><mi>x</mi></math></p><noscript>b</noscript><object>c</object></article>", "a x\nbc"),
    ],
)
def test_names_that_only_mention_a_part_do_not_drop_text(page, want):
    found, blocks = html.parse(page)
    assert html._text(blocks, found.text(), set()) == want


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_what_a_host_repeats_is_template(spark, broadcast_rows):
    def page(i):
        extra = "<div class=box>extra</div>" if i % 3 == 0 else ""
        return f"<body><div class=top>Site name</div>{extra}<div class=body><p>Text {i} of its own</p><p>and {i}</p></div><div class=end>All rights</div>"

    rows = [(i, f"https://WWW.same.example:80/{i}", page(i)) for i in range(9)] + [(99, "https://other.example/", page(99))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract_text(pages, max_broadcast_rows=broadcast_rows).collect()}
    for i in range(9):
        extra = "extra\n" if i % 3 == 0 else ""
        assert got[i] == f"{extra}Text {i} of its own\nand {i}"
    assert got[99] == "Site name\nextra\nText 99 of its own\nand 99\nAll rights"


def test_copied_articles_are_not_template(spark):
    rows = [(i, f"https://same.example/{i}", f"<nav>{i}</nav>{ARTICLE}") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in html.extract_text(pages).collect()} == {CASES[3][1]}


def test_simple_tree_matching():
    a = html.parse("<body><div class=a><p>1</p></div><div class=b>2</div><ul><li>3</ul>")[0]
    b = html.parse("<body><div class=b>2</div><div class=a><p>1</p></div><ul><li>3</ul>")[0]
    pairs = {a.labels[x] for x in html.tree_match(a, b)}
    # The order of the children is kept, so one of the two swapped divs is lost: the larger stays.
    assert pairs == {"", "body", "div.a", "p", "ul", "li"}


def test_matching_is_the_largest_there_is():
    rng = random.Random(4)

    def grown(depth):
        names = rng.sample("abcd", rng.randrange(5)) if depth else []
        return "".join(f"<div class={n}>{grown(depth - 1)}</div>" for n in names)

    def largest(a, x, b, y):
        xs, ys = list(a.children[x].values()), list(b.children[y].values())
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, u in enumerate(xs):
            for j, v in enumerate(ys):
                pair = largest(a, u, b, v) if a.labels[u] == b.labels[v] else 0
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + pair)
        return best[-1][-1] + 1

    for _ in range(300):
        a, b = (html.parse(grown(4))[0] for _ in range(2))
        found = html.tree_match(a, b)
        assert len(found) == len(set(found.values())) == largest(a, 0, b, 0)
        for x, y in found.items():
            assert a.labels[x] == b.labels[y]
            assert x == 0 or found[a.parents[x]] == b.parents[y]


def test_deep_and_wide_pages(spark):
    deep = "<div>" * 3000 + "<p>text {}"
    names = ("".join(chr(97 + i // k % 26) for k in (1, 26, 676)) for i in range(1500))
    wide = "".join(f"<div class=c{name}>x{{0}}</div>" for name in names)
    rows = [(i, "http://deep.example/", deep.format(i)) for i in range(5)]
    rows += [(10 + i, "http://wide.example/", wide.format(i)) for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract_text(pages).collect()}
    for i in range(5):
        assert got[i] == f"text {i}"
        assert got[10 + i] == "\n".join([f"x{i}"] * 1500)


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_siblings_without_names_are_aligned_by_what_they_repeat(spark, broadcast_rows):
    def page(i):
        own = "".join(f"<div>part {j} of {i}</div>" for j in range(i % 3 + 1))
        return f"<body><div>Home | News</div>{own}<div>All rights reserved</div>"

    rows = [(i, "http://plain.example/", page(i)) for i in range(8)]
    rows += [(20 + i, "http://same.example/", "<div>a</div><div>copied article</div>") for i in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html.extract_text(pages, max_broadcast_rows=broadcast_rows).collect()}
    for i in range(8):
        assert got[i] == "\n".join(f"part {j} of {i}" for j in range(i % 3 + 1))
        assert got[20 + i] == "a\ncopied article"


def test_no_pages(spark):
    assert html.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# -- licenses -----------------------------------------------------------------


def _best(template, words):
    """Words of the best local alignment, without index and band."""
    best, above = (0, 0, 0, 0), [(0, 0, j) for j in range(len(words) + 1)]
    for word in template:
        row = [(0, 0, 0)]
        for j, other in enumerate(words, 1):
            score, matched, start = above[j - 1] if above[j - 1][0] else (0, 0, j - 1)
            same = word == other
            options = [(score + (2 if same else -1), matched + same, start)]
            options += [(x[0] - 1, *x[1:]) for x in (above[j], row[j - 1])]
            cell = max(options, key=lambda c: c[0])
            row.append(cell if cell[0] > 0 else (0, 0, j))
            if same and cell[0] > best[0]:
                best = (*cell, j)
        above = row
    return best[1]


def test_license_scan(spark):
    rng = random.Random(11)
    rows = []
    for i, (name, text) in enumerate(license.TEMPLATES.items()):
        words = text.split()
        filler = [f"w{rng.randrange(500)}" for _ in range(60)]
        near = [w if rng.random() > 0.05 else f"x{rng.randrange(9)}" for w in words]
        rows += [
            (3 * i, " ".join(filler[:30] + words + filler[30:]), name, True),
            (3 * i + 1, " ".join(filler + near), name, None),
            (3 * i + 2, " ".join(filler + words[: len(words) // 3]), name, False),
        ]
    rows += [(900, None, "MIT", False), (901, "", "MIT", False), (None, "RELEASED under\nthe MIT -- license", "MIT", True)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").selectExpr("*", "1 AS template")
    found = defaultdict(dict)
    for r in license.scan_licenses(docs).collect():
        found[r.doc_id][r.template] = r
    from signalstats.llm.common import NON_ALPHANUMERIC, Words

    import pyarrow as pa

    for doc_id, text, name, holds in rows:
        words, template = (
            Words(pa.array([x], pa.string()), NON_ALPHANUMERIC, lower=True).hashes().tolist()
            for x in (text, license.TEMPLATES[name])
        )
        matched = _best(template, words)
        if holds is None:
            holds = 100 * matched >= 80 * len(template)
        assert (name in found[doc_id]) == holds, (doc_id, name)
        if holds:
            r = found[doc_id][name]
            assert r.n_matched == matched and r.coverage == matched / len(template)
            assert 0 <= r.start_word < r.end_word <= len(words)


def test_notices_in_a_row_are_reported_one_by_one(spark):
    text = "Released under the MIT License. " * 3
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = license.scan_licenses(docs).orderBy("start_word").select("template", "start_word", "end_word").collect()
    assert [tuple(r) for r in found] == [("MIT", i, i + 5) for i in (0, 5, 10)]


def test_words_put_into_a_notice_do_not_hide_it(spark):
    words = license.TEMPLATES["Apache-2.0 header"].split()
    rows = [(n, " ".join(words[:40] + [f"w{i}" for i in range(n)] + words[40:])) for n in (0, 5, 12, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in license.scan_licenses(docs).where("template = 'Apache-2.0 header'").collect()}
    assert set(found) == {0, 5, 12, 40}
    assert len({r.n_matched for r in found.values()}) == 1
    assert all(r.coverage == 1.0 and r.end_word - r.start_word - r.n_matched == n for n, r in found.items())


def test_licenses_of_awkward_tables(spark):
    """No rows, repeated rows, very long texts, rows without id, other columns."""
    empty = spark.createDataFrame([], "doc_id long, text string, coverage string")
    assert license.scan_licenses(empty).collect() == []
    notice = license.TEMPLATES["MIT"]
    long = " ".join(f"w{i % 5000}" for i in range(200_000))
    rows = [(1, f"{long} {notice} {long}", "a"), (2, notice, "b"), (2, notice, "b"), (None, notice, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, template string")
    found = license.scan_licenses(docs).select("doc_id", "template", "start_word", "end_word")
    want = [(1, "MIT", 200_000, 200_005), (2, "MIT", 0, 5), (2, "MIT", 0, 5), (None, "MIT", 0, 5)]
    assert result(found, *found.columns) == sorted(want, key=repr)


# -- toxicity -----------------------------------------------------------------


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(2)
    y = rng.random(40_000) < 0.2
    rates = [(0.02, 0.6), (0.05, 0.5), (0.01, 0.4), (0.7, 0.1)]
    fires = np.stack([rng.random(len(y)) < np.where(y, t, c) for c, t in rates], axis=1)
    fires[:, 2] |= fires[:, 1] & (rng.random(len(y)) < 0.3)  # a voter that partly copies another
    patterns = (fires << np.arange(4)).sum(axis=1)
    counts = np.zeros((16, 3))
    counts[:, 0] = np.bincount(patterns, minlength=16)
    model = toxicity.LabelModel.fit(counts, 4, against=(3,))
    posterior = model.posterior(patterns)
    assert ((posterior > 0.5) == y).mean() > 0.93
    assert model.accuracy[3] < 0 < model.accuracy[:3].min()
    # The copying voter is found out by its correlation.
    assert model.correlation[1, 2] > 0.2


def _toxic_rows(rng, n):
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 120))]
        toxic = rng.random() < 0.2
        for _ in range(rng.randrange(2, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["Moron,", "vexugné", "loweischaft", "scum"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = _toxic_rows(random.Random(4), 1200)
    extra = [(5000, None), (5001, ""), (None, "you moron, scum moron scum"), (5002, "w1 " * 30_000 + "scum moron vexugné scum"), rows[0], rows[0]]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string").selectExpr("*", "9 AS score", "'x' AS votes")
    held = {r.id for r in spark.range(1200).where(toxicity.held_out(F.col("id"))).collect()}
    wrong = [(i, t if i not in held else 1 - t) for i, t in labels]  # held-out labels must not matter
    table = spark.createDataFrame(wrong + [(7, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, table)
    scored = model.score(docs)
    assert set(scored.columns) == set(docs.columns)
    got = {(r.doc_id, r.text): r.score for r in scored.collect()}
    assert all(0 <= s <= 1 for s in got.values())
    truth = dict(labels)
    right = [(got[i, text] >= 0.7) == truth[i] for i, text in rows if i in held]
    assert len(right) > 300 and np.mean(right) > 0.97
    assert got[5000, None] == got[5001, ""] < 0.3
    assert got[None, "you moron, scum moron scum"] > 0.7


def test_toxicity_without_labels_or_documents(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit_toxicity(no_docs, none).score(no_docs).collect() == []
    scores = [r.score for r in toxicity.fit_toxicity(docs, none).score(docs).collect()]
    assert max(scores) < 0.7


# -- pipeline -----------------------------------------------------------------


def test_every_stage_on_the_awkward_table(spark, docs, sf_dir):
    table = docs.withColumnRenamed("score", "other")
    before = table.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stored(stage(spark, table, sf_dir), "test-stage")
        assert table.columns == docs.withColumnRenamed("score", "other").columns, name
        assert 0 < table.count() <= before
        before = table.count()
    ids = [r.doc_id for r in table.collect()]
    # Of the copies and of the repeated rows one is left, clean rows and rows without id stay.
    assert sum(100 <= (i or 0) < 112 for i in ids) <= 1 and ids.count(4) == 1
    assert {1, 2, 3, 6, 10, None} <= set(ids)
    assert corpus_pipeline.mix(spark, table, sf_dir).count() == before


def test_one_document_of_each_group_stays(spark, sf_dir):
    """Shared and missing ids, repeated rows, texts without words, other columns."""
    rng = random.Random(9)
    long = [f"w{rng.randrange(10**6)}" for _ in range(200)]

    def near(*changed):
        return " ".join(f"x{i}" if i in changed else w for i, w in enumerate(long))

    other, third = ("a text of its own " + " ".join(f"{k}{i}" for i in range(30)) for k in "yz")
    rows = [(1, near(), "s"), (1, near(3), "s"), (1, near(190), "t"), (1, near(), "s"), (None, near(50), "s")]
    rows += [(None, other, "s"), (None, other, "s"), (None, "other " + other, "t"), (7, third, "s"), (None, third, "s")]
    rows += [(None, "", "s")] * 3 + [(None, None, "s")] * 2 + [(5, " \n", "s")] * 2
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'c' AS component")
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, table.repartition(3), sf_dir).collect()]
    empty = [r for r in got if not (r[1] or "").strip()]
    assert sorted(empty, key=repr) == sorted(((*r, "c") for r in rows if not (r[1] or "").strip()), key=repr)
    kept = [r for r in got if (r[1] or "").strip()]
    assert len(kept) == 3
    assert {r[0] for r in kept} == {1, None, 7}
    assert all((r[0], r[1], r[2]) in rows for r in kept)


def test_pipeline_of_an_empty_table(spark, sf_dir):
    table = spark.createDataFrame([], "doc_id long, text string, source string, extra int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stored(stage(spark, table, sf_dir), "test-stage")
        assert (table.columns, table.count()) == (["doc_id", "text", "source", "extra"], 0), name
    assert corpus_pipeline.mix(spark, table, sf_dir).count() == 0


def test_rows_that_reach_the_driver_are_bounded(spark, monkeypatch):
    """Rows without id and of one hot id, all with the lexicon's words."""
    fetched = []
    plain = type(spark.range(0)).toPandas

    def counted(self):
        found = plain(self)
        fetched.append(len(found))
        return found

    monkeypatch.setattr(type(spark.range(0)), "toPandas", counted)
    texts = "concat('you stupid idiot a', id % 7, ' gribble ', repeat('x ', int(id % 900)), id % 11) AS text"
    hot = spark.range(0, 3000).selectExpr("if(id % 2 = 0, NULL, 5L) AS doc_id", texts)
    same = spark.range(0, 3000).selectExpr("cast(null AS bigint) AS doc_id", "'you stupid idiot gribble' AS text")
    own = "concat(if(id % 2 = 0, 'b', 'c'), id, if(id % 2 = 0, ' gribble', ' fine'), ' day') AS text"
    taught = spark.range(100, 400).selectExpr("id AS doc_id", own)
    labels = spark.range(100, 400).selectExpr("id AS doc_id", "int(id % 2 = 0) AS toxic")
    model = toxicity.fit_toxicity(hot.union(same).union(taught), labels, max_rows=100)
    assert fetched and max(fetched) <= 200
    scores = {r.text: r.score for r in model.score(taught).collect()}
    assert min(s for t, s in scores.items() if "gribble" in t) > max(s for t, s in scores.items() if "fine" in t)


def test_lexicon_words_count_over_all_labelled_rows(spark):
    """A toxic word in one labelled text of a thousand is learnt however few rows are fitted."""
    words = "if(id % 500 = 0, ' gribble end', ' calm end')"
    table = spark.range(0, 6000).selectExpr("id AS doc_id", f"concat('t', id, {words}) AS text")
    labels = table.selectExpr("doc_id", "int(text LIKE '%gribble%') AS toxic")
    model = toxicity.fit_toxicity(table, labels, max_rows=50)
    assert len(model.lexicon) == 1


def test_pipeline_query(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "text", "lang", "source", "n_chars", "slot", "position"} <= set(got.columns)
    rows = got.collect()
    assert len({r.position for r in rows}) == len(rows) > 100
    assert all(r.n_chars == len(r.text) for r in rows)


def test_queries_are_one_per_operator():
    numbers = [int(name[2:].split("_")[0]) for name in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert awkward_rows() == awkward_rows()
