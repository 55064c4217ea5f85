"""Resampling against plain Python: buckets, gains, weights, scores and ranks."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import result  # tests/llm/conftest.py

from signalstats.llm import resample


def features(text, ngram):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return w, [" ".join(w[i : i + n]) for n in range(1, ngram + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, percent, ngram, buckets, min_words):
    def hashed(text):
        w, f = features(text, ngram)
        return len(w), [zlib.crc32(x.encode()) % buckets for x in f]

    own = [hashed(text) for _, text in rows]
    s = Counter(b for _, f in own for b in f)
    t = Counter(b for text in target for b in hashed(text)[1])
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
        for b in range(buckets)
    ]
    found = []
    for (doc_id, _), (n, f) in zip(rows, own):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append((doc_id, n, len(f), weight, score))
    able = sorted((r for r in found if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = [(*r, i if i <= len(able) * percent // 100 else None) for i, r in enumerate(able, 1)]
    return ranks + [(*r, None) for r in found if r[1] < min_words]


COLUMNS = "doc_id n_words n_features weight score rank".split()


@pytest.mark.parametrize(("percent", "ngram", "buckets"), [(10, 1, 10_000), (50, 3, 37), (100, 2, 64), (0, 1, 100)])
def test_resample(spark, docs, rows, percent, ngram, buckets):
    target = [None, "", "the of and in Über 12 foo bar", "w1 w2 w3 the the the", rows[20][1]]
    table = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(docs, table, percent, ngram, buckets)
    assert got.columns == COLUMNS
    want = brute([r[:2] for r in rows], target, percent, ngram, buckets, 20)
    found = result(got, *COLUMNS)
    # Rows of one id and score may swap ranks, so those are compared as sets.
    assert sorted((r[:5] for r in found), key=repr) == sorted((r[:5] for r in want), key=repr)
    for ranked in (found, want):
        assert sorted(r[5] for r in ranked if r[5] is not None) == list(range(1, sum(r[5] is not None for r in want) + 1))
    by_rank = {r[5]: (r[0], r[4]) for r in want if r[5]}
    assert {r[5]: (r[0], r[4]) for r in found if r[5]} == by_rank


def test_hot_score(spark):
    """A third of all rows are one document without id: equal score, different ranks."""
    text = " ".join(f"w{i}" for i in range(25))
    hot = spark.range(0, 2000, 1, 8).selectExpr("cast(null as bigint) AS doc_id", f"'{text}' AS text")
    rest = spark.range(0, 4000, 1, 8).selectExpr("id AS doc_id", f"concat('{text} x', id % 7) AS text")
    table, target = hot.union(rest), spark.createDataFrame([(text,)], "text string")
    got = resample.resample(table, target, percent=100).collect()
    assert sorted(r.rank for r in got) == list(range(1, 6001))
    order = sorted(got, key=lambda r: r.rank)
    assert [r.score for r in order] == sorted((r.score for r in got), reverse=True)
    same = [r for r in order if r.score == next(x.score for x in got if x.doc_id is None)]
    assert [r.doc_id for r in same][-2000:] == [None] * 2000


def test_empty_tables(spark, no_docs, docs, rows):
    nothing = spark.createDataFrame([], "text string")
    assert result(resample.resample(no_docs, nothing), *COLUMNS) == []
    want = brute([r[:2] for r in rows], [], 10, 1, 10_000, 20)
    found = result(resample.resample(docs, nothing), *COLUMNS)
    assert sorted((r[:5] for r in found), key=repr) == sorted((r[:5] for r in want), key=repr)


def test_bit_slices_are_exact():
    rng = np.random.default_rng(1)
    for buckets, worth in ((10_000, 9000), (65, 1), (64, 10**12), (1, 5)):
        n = 1500
        text = np.sort(rng.integers(0, n, 20_000))
        bucket = rng.integers(0, buckets, 20_000) ** 2 // buckets
        gain = rng.integers(-worth, worth, buckets)
        want = np.zeros(n, np.int64)
        np.add.at(want, text, gain[bucket])
        assert (resample.sliced_sums(text, bucket, n, gain) == want).all()


def test_crc32_of_ranges():
    rng = random.Random(2)
    parts = ["".join(rng.choice("abc é漢") for _ in range(rng.randrange(9))) for _ in range(300)] + ["z" * 300, "é" * 5000]
    raw = np.frombuffer("".join(parts).encode(), np.uint8)
    ends = np.cumsum([len(p.encode()) for p in parts])
    starts = np.append(0, ends[:-1])
    crc = resample.crc32_ranges(raw, starts, ends)
    assert crc.tolist() == [zlib.crc32(p.encode()) for p in parts]
    after = resample.crc32_ranges(raw, starts[::-1], ends[::-1], crc)
    assert after.tolist() == [zlib.crc32((a + b).encode()) for a, b in zip(parts, parts[::-1])]
