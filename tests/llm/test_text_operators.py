"""Operators on documents against plain Python on the awkward table."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import result  # tests/llm/conftest.py

from signalstats.llm import decontaminate, lines, ngram_join, quality, substring


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def key_of(line):
    return lower(line.strip(" \t\n\x0b\x0c\r"))


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("length", [6, 35])
def test_substring_dedup(docs, rows, length):
    starts = Counter()
    for _, text, _ in rows:
        w = words(text)
        starts.update(tuple(w[i : i + length]) for i in range(len(w) - length + 1))
    want = []
    for doc_id, text, _ in rows:
        w = words(text)
        lost = set()
        for i in range(len(w) - length + 1):
            if starts[tuple(w[i : i + length])] > 1:
                lost.update(range(i, i + length))
        want.append((doc_id, " ".join(x for i, x in enumerate(w) if i not in lost), len(w), len(lost)))
    assert result(substring.substring_dedup(docs, length), "doc_id", "text", "n_words", "n_removed") == order(want)


def test_substring_dedup_of_many_copies_and_missing_ids(spark):
    """Thousands of rows of one text, and texts that share an id or have none."""
    rng = random.Random(3)
    copied = " ".join(f"w{rng.randrange(10**6)}" for _ in range(400))
    passage = " ".join(copied.split()[100:140])
    table = [(None if i % 2 else 7, copied) for i in range(3000)]
    table += [(None, f"own {i} {passage if i % 40 == 0 else ''} " + " ".join(f"{i}v{j}" for j in range(40))) for i in range(400)]
    got = substring.substring_dedup(spark.createDataFrame(table, "doc_id long, text string").repartition(6))
    want = []
    for doc_id, text in table:
        w = words(text)
        lost = set(range(len(w))) if text == copied else set(range(2, 42)) if passage in text else set()
        want.append((doc_id, " ".join(x for i, x in enumerate(w) if i not in lost), len(w), len(lost)))
    assert result(got, "doc_id", "text", "n_words", "n_removed") == order(want)


def test_line_dedup(docs, rows):
    holders = defaultdict(set)
    for doc_id, text, _ in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 40 and doc_id is not None:
                holders[key_of(line)].add(doc_id)
    lost = {k: max(ids) for k, ids in holders.items() if len(ids) >= 5}
    assert lost
    want = []
    for doc_id, text, _ in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if doc_id is None or lost.get(key_of(x), doc_id) == doc_id]
        want.append((doc_id, "\n".join(kept), len(own), len(own) - len(kept)))
    got = lines.line_dedup(docs)
    assert result(got, "doc_id", "text", "n_lines", "n_dropped") == order(want)
    assert set(docs.columns) < set(got.columns)


def test_line_dedup_may_drop_every_line(spark):
    line = "x" * 40
    table = spark.createDataFrame([(i, line) for i in range(5)], "doc_id long, text string")
    got = result(lines.line_dedup(table), "doc_id", "text", "n_lines", "n_dropped")
    assert got == [(i, "", 1, 1) for i in range(4)] + [(4, line, 1, 0)]


def test_quality_rules(docs, rows):
    hosts, holders = defaultdict(set), defaultdict(set)
    for _, text, source in rows:
        hosts[source or ""].add(text)
        for line in (text or "").split("\n"):
            if words(line):
                holders[source or "", key_of(line)].add(text)
    frequent = {k for k, texts in holders.items() if len(texts) > 4 and len(texts) * 1000 > len(hosts[k[0]])}
    assert frequent
    want = []
    for doc_id, text, source in rows:
        text = text or ""
        w = words(text)
        grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        many = Counter(grams)
        again = {i + j for i, g in enumerate(grams) if many[g] > 1 for j in range(8)}
        own = [x for x in text.split("\n") if words(x)]
        removed = sum(len(words(x)) for x in own if (source or "", key_of(x)) in frequent)
        failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
        want.append(
            (
                doc_id,
                len(w),
                sum(map(len, w)),
                len(re.findall(r"[#*$%&|<>]", text)),
                len(own) - len(set(own)),
                len(again),
                failed,
                removed,
                not failed and 100 * (len(w) - removed) >= 50 * len(w),
            )
        )
    assert any(removed for *_, removed, _ in want)
    assert result(quality.quality_rules(docs, max_docs=4), "*") == order(want)


def _benchmark(rows):
    passage = " ".join(words(rows[12][1]))
    return [
        (1, "one"),
        (2, None),
        (3, ""),
        (4, "...!"),
        (5, passage[:300].upper()),
        (5, "of AND in"),
        (None, "four"),
        (6, rows[30][1]),
        (7, "words that nobody ever uses in any text at all, twice or more"),
        (7, "words that nobody ever uses in any text at all, twice or more"),
    ]


@pytest.mark.parametrize(("length", "index_bytes"), [(13, 10**6), (4, 100)])
def test_decontamination(spark, docs, rows, length, index_bytes):
    def parts(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))

    patterns = defaultdict(set)
    items = _benchmark(rows)
    for item, text in items:
        w = parts(text)
        size = min(length, len(w))
        for i in range(len(w) - size + 1):
            if size:
                patterns[tuple(w[i : i + size])].add("" if item is None else str(item))
    want = []
    for doc_id, text, _ in rows:
        w = parts(text)
        hit, found = set(), set()
        for size in {len(p) for p in patterns}:
            for i in range(len(w) - size + 1):
                if own := patterns.get(tuple(w[i : i + size])):
                    found |= own
                    hit.update(range(i, i + size))
        want.append((doc_id, len(w), len(hit), sorted(found), 20 * len(hit) >= len(w) and bool(hit)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_benchmark(docs, benchmark, length, index_bytes)
    assert result(got, "doc_id", "n_words", "n_hit", "items", "contaminated") == order(want)
    spans = {(r.doc_id, r.n_hit, sum(s.length for s in r.hits)) for r in got.collect()}
    assert all(n == covered for _, n, covered in spans)


def test_ngram_components(docs, rows):
    sets = []
    for _, text, _ in rows:
        w = words(lower(text))
        size = min(5, len(w))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= 80 * len(x | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    want = [(r[0], len(s), least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]
    assert result(ngram_join.ngram_components(docs), "doc_id", "n_shingles", "component_id") == order(want)


def test_chain_of_near_duplicates_with_one_that_fits_no_head(spark):
    """Links that only the comparison across components finds."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        text = list(base)
        for j in range(i):
            text[(j * 5 + 2) % 200] = f"v{j}"
        rows.append((i, " ".join(text)))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    test_ngram_components(table, [(*r, "") for r in rows])


def test_empty_tables(spark, no_docs):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    for df in (
        substring.substring_dedup(no_docs),
        lines.line_dedup(no_docs),
        quality.quality_rules(no_docs),
        decontaminate.find_benchmark(no_docs, benchmark),
        ngram_join.ngram_components(no_docs),
    ):
        assert df.collect() == []


def test_empty_benchmark_hits_nothing(spark, docs):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in decontaminate.find_benchmark(docs, benchmark).collect()} == {0}


def test_digests_are_of_utf8(spark):
    assert hashlib.sha256("É".encode()).hexdigest() == spark.sql("SELECT sha2('É', 256)").first()[0]
