"""Periodic runs against a scan of all lags."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest
from conftest import result  # tests/llm/conftest.py

from signalstats.llm import queries, runs
from signalstats.llm.common import Words


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(w, times=4, shortest=6):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, times * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(w, found):
    lost = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in lost)


def periodic_text(rng):
    w = []
    while rng.random() < 0.9:
        if rng.random() < 0.5:
            w += [rng.choice("abc") for _ in range(rng.randrange(1, 6))] * rng.randrange(1, 8)
        else:
            w += [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 5))]
    return w


@pytest.mark.parametrize(("times", "shortest"), [(4, 6), (3, 1), (5, 12)])
def test_find_runs(times, shortest):
    rng = random.Random(times)
    for _ in range(300):
        texts = [periodic_text(rng) for _ in range(rng.randrange(1, 5))]
        all_words = Words(pa.array([" ".join(w) for w in texts]))
        got = runs.find_runs(all_words.hashes(), all_words.first, times, shortest)
        want = [(s + f, s + f + n, q) for f, w in zip(all_words.first, texts) for s, n, q in brute(w, times, shortest)]
        assert [tuple(r) for r in got.tolist()] == want


def test_segments_split_until_stable():
    text = "a b a b a b a b x a b a b c c c c c c y y y"
    all_words = Words(pa.array([text, "p q r s t u v w", "", "z z z z z z"]))
    begin, end = runs.segments(all_words.hashes(), all_words.first, 4, 6)
    assert list(zip(begin.tolist(), end.tolist())) == [(0, 8), (13, 19), (30, 36)]


def test_long_texts_take_little_time():
    """One word, one period over everything, and many nested runs, each in a long text."""
    n = 100_000
    cases = {
        "a " * n: [(0, n, 1)],
        " ".join(f"w{i % (n // 5)}" for i in range(n)): [(0, n, n // 5)],
        " ".join(("a " * 8 + "b " * 8) * 5 + f"x{i}" for i in range(500)): None,
    }
    for text, want in cases.items():
        all_words = Words(pa.array([text]))
        got = [tuple(r) for r in runs.find_runs(all_words.hashes(), all_words.first).tolist()]
        if want is not None:
            assert got == want
        else:
            assert [(s, e, q) for s, e, q in got if q == 16] == [(81 * i, 81 * i + 80, 16) for i in range(500)]
            assert len(got) == 500 * 11


def test_periodic_runs(spark, docs, rows):
    rng = random.Random(5)
    more = [(1000 + i, " \n".join(periodic_text(rng)), "s") for i in range(60)]
    more += [more[0], more[0], (None, "a " * 50 + "é", None), (1000, "z\t" * 9, "s")]
    table = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, source string"), True)
    want = []
    for doc_id, text, *_ in [*rows, *more]:
        w = words(text)
        found = brute(w)
        want.append((doc_id, collapsed(w, found), len(w), found))
    got = [(a, b, c, [tuple(r) for r in d]) for a, b, c, d in result(runs.periodic_runs(table), "doc_id", "text", "n_words", "runs")]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert any(x[3] for x in want)


def test_empty_table(no_docs):
    assert result(runs.periodic_runs(no_docs), "doc_id", "text", "n_words", "runs") == []
    with pytest.raises(ValueError, match="three periods"):
        runs.periodic_runs(no_docs, times=2)


def test_query_on_awkward_rows(spark, docs, rows, tmp_path):
    """The query of the table, with its planted periods, against plain Python."""
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want, planted = [], 0
    for doc_id, text, _ in rows:
        w = words(text)
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
            planted += 1
        found = brute(w)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, collapsed(w, found))]
        want.append((doc_id, len(found), *figures, *digests))
    assert planted
    got = queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    columns = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert got.columns == columns
    assert result(got, *columns) == sorted(want, key=repr)
