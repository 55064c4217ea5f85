"""Tokens against the tokenizer itself, bins against their pieces and plain best fit."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import result  # tests/llm/conftest.py

from signalstats.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain(path):
    tokenizer = tokenizers.Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_token_ids_of_any_text(path, plain):
    rng = random.Random(3)
    parts = ["a", "the", "é", "漢", "\xa0", " ", " ", " ", "  ", "\n", "\t", " ", "　", "\x85", "'s", "12"]
    parts += ["<|endoftext|>", "!?", "\r\n", "\x1c", "\x7f", "😀", "​", "ごは", "\x00", "word", "в"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)] + [None, "", "x" * 5000]
    ids, edges = packing.token_ids(pa.array(texts), path)
    assert [ids[s:e].tolist() for s, e in zip(edges[:-1], edges[1:])] == [plain(t) for t in texts]


def test_worker_memory_is_bounded(path, plain, monkeypatch):
    monkeypatch.setattr(packing, "_REMEMBERED", 10)
    for begin in range(0, 60, 7):
        texts = [" ".join(f"w{i} w{i + j}" for j in range(3)) for i in range(begin, begin + 7)]
        ids, edges = packing.token_ids(pa.array(texts), path)
        assert [ids[s:e].tolist() for s, e in zip(edges[:-1], edges[1:])] == [plain(t) for t in texts]


class Counted:
    """A tokenizer that notes the texts it gets."""

    def __init__(self, inner):
        self.inner, self.texts = inner, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.inner.encode_batch_fast(texts, **options)


def test_chunks_reach_the_tokenizer_joined_and_once(path, plain, monkeypatch):
    """Words of any script are joined, and what has been seen in an earlier batch costs no call."""
    memory = packing._ChunkTokens(path)
    memory._tokenizer = counted = Counted(memory._tokenizer)
    monkeypatch.setattr(packing, "_chunk_tokens", lambda _: memory)
    words = [f"{end}{i}{end}" for i in range(200) for end in ("é", "ción", "漢", "в", "\U0001f600", "a")]
    for texts in ([" ".join(words)], [" ".join(words[::-1])], [" ".join(words), " ".join(words)]):
        ids, edges = packing.token_ids(pa.array(texts), path)
        assert [ids[s:e].tolist() for s, e in zip(edges[:-1], edges[1:])] == [plain(t) for t in texts]
    assert len(counted.texts) <= 6
    # The first word of the first two texts comes with a blank and without.
    assert sum(t.count(" ") for t in counted.texts) == len(words)


def test_memory_tells_chunks_of_one_hash_apart(path, plain, monkeypatch):
    """The bytes decide: every chunk of these batches has the same hash as one before."""
    real = packing.range_hashes
    monkeypatch.setattr(packing, "range_hashes", lambda raw, starts, ends: real(raw, starts, ends) % np.uint64(2))
    memory = packing._ChunkTokens(path)
    monkeypatch.setattr(packing, "_chunk_tokens", lambda _: memory)
    for text in ("one", "two", "three", "one", "other", "three", "six"):
        assert packing.token_ids(pa.array([text]), path)[0].tolist() == plain(text)


def test_what_was_asked_for_last_is_kept(path, plain, monkeypatch):
    monkeypatch.setattr(packing, "_REMEMBERED", 4)
    memory = packing._ChunkTokens(path)
    memory._tokenizer = counted = Counted(memory._tokenizer)
    monkeypatch.setattr(packing, "_chunk_tokens", lambda _: memory)
    for i in range(40):
        text = f"often new{i}"
        assert packing.token_ids(pa.array([text]), path)[0].tolist() == plain(text)
        assert len(memory._keys) <= 8
    assert counted.texts.count("often") == 1


def lengths(kind, n, rng):
    return {
        "even": lambda: rng.randrange(1, 1025),
        "large": lambda: rng.randrange(300, 400),
        "round": lambda: 50 * rng.randrange(1, 20),
        "one": lambda: 1,
        "half": lambda: 513,
    }[kind]()


@pytest.mark.parametrize("kind", ["even", "large", "round", "one", "half"])
@pytest.mark.parametrize("n", [1, 2, 50, 600])
def test_bins_hold_every_piece_and_the_search_only_improves(kind, n):
    rng = random.Random(n)
    counts = Counter(lengths(kind, n, rng) for _ in range(n))
    first = packing.best_fit(counts, 1024)
    # Best fit, piece by piece.
    rooms = []
    for x in sorted(counts.elements(), reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= x]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= x
        else:
            rooms.append(1024 - x)
    assert first.total() == len(rooms)
    final = packing.local_search(first, 1024)
    for bins in (first, final):
        assert all(0 < sum(c) <= 1024 and k > 0 for c, k in bins.items())
        assert sum((Counter({x: k * m for x, m in Counter(c).items()}) for c, k in bins.items()), Counter()) == counts
    assert -(-sum(x * k for x, k in counts.items()) // 1024) <= final.total() <= first.total()
    squares = [sum(k * sum(c) ** 2 for c, k in bins.items()) for bins in (first, final)]
    assert squares[0] <= squares[1]


def test_search_saves_bins_where_best_fit_does_not():
    rng = random.Random(600)
    bins = packing.best_fit(Counter(rng.randrange(300, 400) for _ in range(600)), 1024)
    assert packing.local_search(bins, 1024).total() < bins.total()


def test_classes_do_not_grow_with_the_pieces():
    many = packing.best_fit({600: 10**12, 300: 10**12 + 7, 124: 10**12, 1: 5}, 1024)
    assert len(many) < 10
    assert packing.local_search(many, 1024).total() <= 10**12 + 3


def check(spark, table, path, plain, rows, capacity):
    """Pieces, places and sequences of a table."""
    pieces = packing.token_pieces(table, path, capacity, with_ids=True)
    packed = packing.pack(pieces, capacity)
    found = [r.asDict() for r in packed.collect()]
    by_sequence = defaultdict(list)
    for r in found:
        by_sequence[r["sequence_id"]].append(r)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    want = []
    for doc_id, text in rows:
        ids = [*plain(text), 2]
        cuts = list(range(len(ids), 0, -capacity))[::-1]
        for number, end in enumerate(cuts):
            start = max(end - capacity, 0)
            want.append((doc_id, number, start, end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())))
    got = [tuple(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    joined = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in found:
        assert joined[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
    assert sorted(joined) == sorted(by_sequence)
    return len(by_sequence), sum(r["length"] for r in found)


@pytest.mark.parametrize("capacity", [64, 1024])
def test_documents_in_sequences(spark, docs, rows, path, plain, capacity):
    bins, tokens = check(spark, docs, path, plain, [r[:2] for r in rows], capacity)
    assert tokens <= bins * capacity <= tokens * 1.01 + capacity


def test_hot_length_and_clashing_columns(spark, path):
    """A third of all pieces have one length, in many tasks; columns of the result's names are replaced."""
    table = spark.range(0, 30_000, 1, 16).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, 700, 1 + id % 300) AS length", "'x' AS offset", "0 AS sequence_id", "id AS first"
    )
    packed = packing.pack(table, 1024).collect()
    assert len(packed) == 30_000
    places = {(r.sequence_id, r.offset) for r in packed}
    assert len(places) == 30_000
    used = Counter()
    for r in packed:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 1024
    assert len(used) <= 10_001


def test_empty_table_and_bad_lengths(spark, no_docs, path):
    cut = packing.token_pieces(no_docs, path)
    assert result(packing.pack(cut), "doc_id", "sequence_id") == []
    for bad in (0, 1025, None):
        table = spark.createDataFrame([(1, bad)], "doc_id long, length int")
        with pytest.raises(Exception, match="a piece has 1 to 1024 tokens"):
            packing.pack(table).collect()


def test_a_task_has_one_python_worker(spark, docs, path, monkeypatch):
    """Two steps in one task are two workers, and each comes to hold a tokenizer and what it remembers."""
    plans, real = [], packing.stored

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(packing, "stored", noted)
    packed = packing.pack(packing.token_pieces(docs, path))
    plans.append(packed._jdf.queryExecution().optimizedPlan().toString())
    assert [p.count("MapInArrow") for p in plans] == [1, 0, 1]
