"""N-gram Jaccard join: groups of documents whose shingle sets overlap enough."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalstats.llm import graph
from signalstats.llm.common import Words, dropped, mix, ngrams, per_text, pieces, signed, spans, stored, windows

_CHUNK = 500_000
_OPEN, _MET, _SETTLED = 0, 1, 2
_NO_ID = -(2**63)
#: Of all shingles those whose hash is below this share tell which sets cannot link.
_SAMPLED = np.uint64(int(0.3 * 2**64))
#: Shingles are counted by the first 20 bits of their hash; the global order follows these counts.
_BUCKET_BITS = 20
_LOW_BITS = np.uint64(64 - _BUCKET_BITS)
#: Rows of three numbers that are broadcast at most.
_BROADCAST_ROWS = 1_000_000
#: Candidates of one probe that share a trie.
_TRIE = 256


def shingle_sets(texts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' distinct shingles, sorted within each text, and where each text's begin."""
    words = Words(texts, lower=True)
    hashed = words.hashes()
    text, at = windows(words.first, length)
    owners, shingles = [text], [ngrams(hashed, length)[at]]
    for short in range(1, length):
        few = np.flatnonzero(words.counts == short)
        if len(few):
            owners.append(few)
            shingles.append(ngrams(hashed, short)[words.first[few]])
    owner, shingle = _sorted(np.concatenate(owners), np.concatenate(shingles))
    new = np.append(True, (owner[1:] != owner[:-1]) | (shingle[1:] != shingle[:-1]))[: len(owner)]
    return shingle[new], np.append(0, np.cumsum(np.bincount(owner[new], minlength=len(texts))))


def _sorted(owner: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(shingle)
    # Numbers of 16 bits are sorted without comparisons.
    small = np.uint16 if not len(owner) or owner.max() < 2**16 else np.int64
    order = order[np.argsort(owner[order].astype(small), kind="stable")]
    return owner[order], shingle[order]


def globally_ordered(shingles: np.ndarray, first: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The sets with their members renumbered, one to one, so that shingles of rare
    buckets come first, and sorted by that: the global order."""
    low = (np.uint64(1) << _LOW_BITS) - np.uint64(1)
    number = rank[(shingles >> _LOW_BITS).astype(np.int64)] << _LOW_BITS | shingles & low
    return _sorted(np.repeat(np.arange(len(first) - 1), np.diff(first)), number)[1]


def _identities(shingles: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each set, whatever the order of its members."""
    return [
        signed(per_text(mix(shingles + np.uint64(seed)), first))
        for seed in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
    ]


def _set_rows(length: int):
    """A row per text: size and identity of its set, and how many sampled shingles it has."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            shingles, first = shingle_sets(piece.column("text"), length)
            columns = [
                piece.column("id"),
                piece.column("mark"),
                np.diff(first),
                per_text(mix(shingles) < _SAMPLED, first),
                *_identities(shingles, first),
            ]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns)], ["id", "mark", "n", "sampled", "set_a", "set_b"]
            )

    return rows


def _sampled_rows(length: int):
    """Rows ``(key, set_a, n)`` of the sampled shingles: those that the task has met in
    one set only (``n`` 0), a mark for each of the others (-1), and per set the number
    of the others."""

    def compared(held: list[tuple]) -> pa.RecordBatch:
        token, own, new_token, many = _once(*(np.concatenate(x) for x in zip(*held, strict=True)))
        sets, counts = np.unique(own[many], return_counts=True)
        marks = token[new_token & many]
        return pa.RecordBatch.from_arrays(
            [
                signed(np.concatenate([token[~many], marks, mix(sets.view(np.uint64))])),
                np.concatenate([own[~many], np.zeros(len(marks), np.int64), sets]),
                np.concatenate([np.zeros(len(token) - many.sum()), np.full(len(marks), -1), counts]).astype(np.int32),
            ],
            ["key", "set_a", "n"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in pieces(batches, "text"):
            shingles, first = shingle_sets(piece.column("text"), length)
            own = np.repeat(_identities(shingles, first)[0], np.diff(first))
            chosen = mix(shingles) < _SAMPLED
            held.append((shingles[chosen], own[chosen]))
            size += int(chosen.sum())
            if size >= _CHUNK:
                yield compared(held)
                held, size = [], 0
        if held:
            yield compared(held)

    return rows


def _once(token: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of token and set; whether each is the first of its token, and
    whether the token has several sets."""
    order = np.lexsort((own, token))
    token, own = token[order], own[order]
    new_token = np.append(True, token[1:] != token[:-1])[: len(token)]
    new = new_token | np.append(True, own[1:] != own[:-1])[: len(token)]
    token, own, new_token = token[new], own[new], new_token[new]
    group = np.cumsum(new_token) - 1
    many = np.bincount(group)[group] > 1 if len(token) else np.zeros(0, bool)
    return token, own, new_token, many


def _bucket_counts(length: int):
    """How many shingles of the task's texts fall into each bucket."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _BUCKET_BITS, np.int64)
        for piece in pieces(batches, "text"):
            shingles, _ = shingle_sets(piece.column("text"), length)
            counts += np.bincount((shingles >> _LOW_BITS).astype(np.int64), minlength=len(counts))
        used = np.flatnonzero(counts)
        for part in range(0, len(used), 10_000):
            buckets = used[part : part + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(counts[buckets])], ["bucket", "n"])

    return rows


def _postings(length: int, percent: int, ranks):
    """Rows ``(key, token, set_a, n, kind)``: the first shingles, in the global order, of
    each set. Two sets that are similar enough share at least one of them."""

    def compared(held: list[tuple]) -> pa.RecordBatch:
        token, own, size = (np.concatenate(x) for x in zip(*held, strict=True))
        sizes = dict(zip(own.tolist(), size.tolist(), strict=True))
        token, own, new_token, many = _once(token, own)
        size = np.array([sizes[x] for x in own.tolist()], np.int64)
        met = new_token & many
        spread = mix(token ^ mix(own.view(np.uint64)))
        return pa.RecordBatch.from_arrays(
            [
                signed(np.concatenate([np.where(many, spread, token), token[met]])),
                signed(np.concatenate([token, token[met]])),
                np.concatenate([own, own[met]]),
                np.concatenate([size, size[met]]),
                np.concatenate([np.where(many, _SETTLED, _OPEN), np.full(int(met.sum()), _MET)]).astype(np.int32),
            ],
            ["key", "token", "set_a", "n", "kind"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in pieces(batches, "text"):
            shingles, first = shingle_sets(piece.column("text"), length)
            n = np.diff(first)
            prefix = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
            owner, chosen = spans(prefix, first[:-1])
            ordered = globally_ordered(shingles, first, ranks.value)
            held.append((ordered[chosen], piece.column("set_a").to_numpy()[owner], n[owner]))
            size += len(chosen)
            if size >= _CHUNK:
                yield compared(held)
                held, size = [], 0
        if held:
            yield compared(held)

    return rows


def _overlaps(probe: np.ndarray, sets: list[np.ndarray], percent: int) -> list[bool]:
    """Whether each set is similar enough to the probe.

    The sets in lexicographic order are the depth-first walk of their trie: what a
    set shares with the one before is the path to the node where they part, and the
    overlap counted up to there is taken over. A branch ends where even a full match
    of what remains, of the set or of the probe, cannot reach the required overlap.
    """
    order = sorted(range(len(sets)), key=lambda i: sets[i].byteswap().tobytes())
    linked = [False] * len(sets)
    path, counted, known = np.zeros(0, np.uint64), np.zeros(1, np.int64), 0
    for i in order:
        own = sets[i]
        need = -(-percent * (len(own) + len(probe)) // (100 + percent))
        shared = min(len(path), len(own), known)
        parting = np.flatnonzero(path[:shared] != own[:shared])
        depth = int(parting[0]) if len(parting) else shared
        counts = [counted[: depth + 1]]
        overlap = int(counted[depth])
        while depth < len(own):
            passed = int(np.searchsorted(probe, own[depth]))
            if overlap + min(len(own) - depth, len(probe) - passed) < need:
                break
            block = own[depth : depth + 64]
            place = np.minimum(np.searchsorted(probe, block), len(probe) - 1)
            found = np.cumsum(probe[place] == block) + overlap
            counts.append(found)
            overlap = int(found[-1])
            depth += len(block)
        path, counted, known = own, np.concatenate(counts), depth
        linked[i] = depth == len(own) and overlap >= need
    return linked


def _linked(length: int, percent: int, ranks):
    """Links ``(a, b)`` from rows ``(a, salt, kind, b, text)`` sorted by these: a probe
    (kind 0), then its candidates."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe_id, probe, names, sets = None, np.zeros(0, np.uint64), [], []
        left, right = [], []

        def settle() -> None:
            for name, linked in zip(names, _overlaps(probe, sets, percent), strict=True):
                if linked:
                    left.append(probe_id)
                    right.append(name)
            names.clear()
            sets.clear()

        for piece in pieces(batches, "text"):
            shingles, first = shingle_sets(piece.column("text"), length)
            shingles = globally_ordered(shingles, first, ranks.value)
            columns = (piece.column(c).to_pylist() for c in ("a", "kind", "b"))
            for i, (a, kind, b) in enumerate(zip(*columns, strict=True)):
                own = shingles[first[i] : first[i + 1]]
                if kind == 0:
                    settle()
                    probe_id, probe = a, own
                else:
                    names.append(b)
                    sets.append(own.copy())
                    if len(sets) >= _TRIE:
                        settle()
        settle()
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return rows


def _verified(pairs: DataFrame, texts: DataFrame, length: int, percent: int, ranks) -> DataFrame:
    """The pairs ``(a, b)`` of set ids that are linked.

    A probe with many candidates is dealt to as many tasks as there are partitions.
    """
    partitions = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(partitions)))
    probes = salted.select("a", "salt").distinct().select("a", "salt", F.lit(0).alias("kind"), F.col("a").alias("b"))
    candidates = salted.select("a", "salt", F.lit(1).alias("kind"), "b")
    return (
        probes.unionByName(candidates)
        .join(texts, F.col("b") == F.col("set_a"))
        .select("a", "salt", "kind", "b", "text")
        .repartition("a", "salt")
        .sortWithinPartitions("a", "salt", "kind", "b")
        .mapInArrow(_linked(length, percent, ranks), "a bigint, b bigint")
    )


def _common(x: Column, y: Column, percent: int) -> Column:
    """How many of their first shingles two linked sets of the given sizes have in common at least."""
    overlap = F.ceil(percent * (x + y) / (100 + percent))
    return F.greatest(overlap - F.ceil(percent * F.greatest(x, y) / 100) + 1, F.lit(1))


def _needed(percent: int) -> Column:
    """The least of :func:`_common` for a set of ``n`` and sets of any size from ``low`` to ``high``.

    Up to ``n`` it does not fall as the other size grows. From there on it falls by
    ``percent^2 / (100 (100 + percent))`` per shingle, but the two roundings move it by
    less than two, so the least is among the last few sizes and not always at ``high``.
    """
    last = -(-200 * (100 + percent) // percent**2)
    sizes = F.sequence(F.greatest("low", F.col("high") - last), F.greatest("low", "high"))
    ends = F.array_union(F.array("low"), sizes)
    return F.array_min(F.transform(ends, lambda size: _common(F.col("n"), size, percent)))


def _able(shared: DataFrame, percent: int) -> DataFrame:
    """From rows ``(token, set_a, n, root)`` the sets that share enough with sets of
    another root to be linked with one: ``set_a, n, root, tokens, c, need``.

    ``tokens`` are the ``c`` shared ones, those of few sets first; ``need`` of them a
    linked set has too, given the sizes of the sets that hold them.
    """
    tokens = stored(
        shared.groupBy("token")
        .agg(
            F.min("n").alias("low"),
            F.max("n").alias("high"),
            F.count("*").alias("d"),
            F.min("root").alias("first"),
            F.max("root").alias("last"),
        )
        .where("first != last")
        .select("token", "low", "high", "d"),
        "tokens",
    )
    low = F.greatest(F.min("low"), F.ceil(percent * F.col("n") / 100)).alias("low")
    high = F.least(F.max("high"), F.floor(100 * F.col("n") / percent)).alias("high")
    sets = (
        shared.join(tokens, "token")
        .groupBy("set_a", "n", "root")
        .agg(low, high, F.sort_array(F.collect_list(F.struct("d", "token"))).alias("tokens"))
        .withColumn("c", F.size("tokens"))
        .withColumn("need", _needed(percent))
        .where("c >= need")
    )
    found = stored(sets.drop("low", "high"), "able-sets")
    dropped(tokens)
    return found


def ngram_components(docs: DataFrame, length: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): ``doc_id, text_hash, n_shingles,
    component_id, component``.

    A document's set holds its distinct ``length``-word shingles, A-Z in lower case;
    fewer words are one shingle. Two documents link when the intersection is at least
    ``percent`` % of the union. ``component_id`` is the smallest ``doc_id`` reachable
    by links, the document's own included.

    Null or empty text: the empty set, linked with nothing, ``component_id`` is the
    own id. Rows that share a ``doc_id`` are told apart by their text. A null
    ``doc_id`` takes part but is never the smallest; a component of null ids alone has
    null. ``component`` names the group whatever the ids are, null for the empty set.
    Other columns are not used. ``text_hash`` (xxhash64) goes with ``doc_id`` to
    name the row.

    Equal sets are one class from the start. A set of ``n`` shingles is linked only
    with sets that hold one of its first ``n - ceil(percent n / 100) + 1`` shingles,
    whatever the global order. First, the order in which shingles of one class come
    first: a class with that many of them among three tenths of all shingles, picked
    by hash and counted over all documents, cannot link. For the rest the order
    follows how often a shingle's bucket occurs, rare ones first. Tasks compare their
    own rows first, so a receiver gets one row per task for a frequent shingle.

    What shares a shingle is compared with one class, the one among those it shares
    most with that itself shares most; links form components. Then only pairs between
    different components are left. Both must have enough shared shingles in common,
    so each looks up its rarest ones alone, and every pair that shares enough is
    compared. Comparison walks a trie of the ordered sets of a probe's candidates.
    """
    spark = docs.sparkSession
    used: list[DataFrame] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        used.append(stored(df, name))
        return used[-1]

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.xxhash64("text").alias("mark"),
        "text",
    )
    members = kept(
        rows.mapInArrow(
            _set_rows(length), "id bigint, mark bigint, n bigint, sampled bigint, set_a bigint, set_b bigint"
        ),
        "shingle-sets",
    )
    classes = kept(
        members.where("n > 0")
        .groupBy("set_a", "set_b", "n")
        .agg(
            F.first("sampled").alias("sampled"),
            F.min(F.when(F.col("id") != _NO_ID, F.col("id"))).alias("least"),
            F.min(F.struct("id", "mark")).alias("row"),
        ),
        "shingle-classes",
    )
    key = Window.partitionBy("key")
    repeated = (
        rows.select("text")
        .mapInArrow(_sampled_rows(length), "key bigint, set_a bigint, n int")
        .repartition("key")
        .select(
            "set_a",
            F.when(F.col("n") != 0, F.greatest("n", F.lit(0)))
            .when(F.min("set_a").over(key) != F.max("set_a").over(key), 1)
            .otherwise(0)
            .alias("n"),
        )
        .where("n > 0")
        .groupBy("set_a")
        .agg(F.sum("n").alias("repeated"))
    )
    prefix = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    able = (
        classes.join(repeated, "set_a", "left")
        .where(F.col("sampled") - F.coalesce("repeated", F.lit(0)) < prefix)
        .select("set_a", "row.id", "row.mark")
    )
    able = kept(able, "able-classes")
    # Up to a size that fits every executor the few rows go to the texts, not the texts to them.
    few = able.limit(_BROADCAST_ROWS + 1).count() <= _BROADCAST_ROWS
    named = rows.join(F.broadcast(able) if few else able, ["id", "mark"])
    texts = kept(named.select("set_a", "text"), "able-texts")
    if texts.count() > able.count():  # repeated rows: one text per class is enough
        texts = kept(texts.groupBy("set_a").agg(F.first("text").alias("text")), "class-texts")

    counted = texts.mapInArrow(_bucket_counts(length), "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n"))
    table = counted.toArrow()
    counts = np.zeros(1 << _BUCKET_BITS, np.int64)
    counts[table.column(0).to_numpy()] = table.column(1).to_numpy()
    rank = np.empty(len(counts), np.uint64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.uint64)
    ranks = spark.sparkContext.broadcast(rank)

    shared = kept(
        texts.mapInArrow(
            _postings(length, percent, ranks), "key bigint, token bigint, set_a bigint, n bigint, kind int"
        )
        .repartition("key")
        .withColumn("low", F.min("set_a").over(key))
        .withColumn("high", F.max("set_a").over(key))
        .withColumn("met", F.max("kind").over(key))
        .where((F.col("kind") != _MET) & ((F.col("met") > _OPEN) | (F.col("low") != F.col("high"))))
        .select("token", "set_a", "n")
        .distinct(),
        "shared-shingles",
    )
    sharing = _able(shared.withColumn("root", F.col("set_a")), percent)

    # One representative per class, the one with which it shares most shingles.
    spread = kept(
        sharing.select("set_a", "c", F.explode("tokens.token").alias("token")), "sharing-shingles"
    )
    heads = kept(spread.groupBy("token").agg(F.max_by("set_a", F.struct("c", "set_a")).alias("head")), "heads")
    stars = (
        spread.join(heads, "token")
        .where(F.col("set_a") != F.col("head"))
        .groupBy("head", "set_a")
        .agg(F.count("*").alias("c"))
        .groupBy("set_a")
        .agg(F.max_by("head", F.struct("c", "head")).alias("head"))
        .select(F.col("head").alias("a"), F.col("set_a").alias("b"))
    )
    links = kept(_verified(kept(stars, "stars"), texts, length, percent, ranks), "star-links")
    labels = graph.components(links)

    # Whatever shares enough across components.
    roots = labels.select(F.col("node").alias("set_a"), "root")
    named = sharing.drop("root").join(roots, "set_a", "left").select(
        "set_a", "n", F.coalesce("root", "set_a").alias("root"), F.explode("tokens.token").alias("token")
    )
    apart = _able(kept(named, "named-shingles"), percent)
    # Of the shared shingles of a set the rarest come first; ``left`` are those from here on.
    looked_up = kept(
        apart.select(
            "set_a", "n", "root", "c", F.posexplode(F.expr("slice(tokens, 1, cast(c - need + 1 as int)).token"))
        ).select(
            "set_a", "n", "root", F.col("col").alias("token"), (F.col("c") - F.col("pos")).alias("left")
        ),
        "looked-up-shingles",
    )
    mixed = kept(
        looked_up.groupBy("token", "root")
        .agg(F.count("*").alias("c"))
        .groupBy("token")
        .agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.count("*").alias("roots"))
        .where("roots > 1")
        .select("token", "main"),
        "mixed-shingles",
    )
    across = kept(looked_up.join(mixed, "token"), "mixed-postings")
    others = across.where("root != main").select(
        "token", *(F.col(c).alias(f"x_{c}") for c in ("set_a", "n", "root", "left"))
    )
    # Two sets with enough in common meet at a shingle from which on both have as many left.
    enough = _common(F.col("x_n"), F.col("n"), percent)
    pairs = kept(
        others.join(across, "token")
        .where("x_root != root AND (root = main OR x_set_a < set_a)")
        .where(100 * F.least("x_n", "n") >= percent * F.greatest("x_n", "n"))
        .where((F.col("x_left") >= enough) & (F.col("left") >= enough))
        .select(F.col("x_set_a").alias("x"), F.col("set_a").alias("y"))
        .distinct(),
        "pairs",
    )
    sets = apart.select("set_a", "n", F.col("tokens.token").alias("tokens"))
    x, y = (sets.select(*(F.col(c).alias(f"{side}_{c}") for c in sets.columns)) for side in "xy")
    alike = (
        pairs.join(x, F.col("x") == F.col("x_set_a"))
        .join(y, F.col("y") == F.col("y_set_a"))
        .where(F.size(F.array_intersect("x_tokens", "y_tokens")) >= _common(F.col("x_n"), F.col("y_n"), percent))
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    more = kept(_verified(kept(alike, "alike-pairs"), texts, length, percent, ranks), "more-links")
    labels = graph.components(links.unionByName(more)) if more.take(1) else labels

    roots = labels.select(F.col("node").alias("set_a"), "root")
    ids = classes.join(roots, "set_a", "left").withColumn("root", F.coalesce("root", "set_a"))
    least = kept(ids.groupBy("root").agg(F.min("least").alias("component_id")), "least-ids")
    found = kept(
        ids.join(least, "root").select(
            F.col("set_a").alias("a"),
            F.col("set_b").alias("b"),
            F.col("n").alias("size"),
            "component_id",
            F.col("root").alias("component"),
        ),
        "components",
    )
    dropped(*(t for t in used if t is not members and t is not found))
    same = (F.col("set_a") == F.col("a")) & (F.col("set_b") == F.col("b")) & (F.col("n") == F.col("size"))
    own = F.when(F.col("id") != _NO_ID, F.col("id"))
    return (
        members.join(found, same, "left")
        .select(
            own.alias("doc_id"),
            F.col("mark").alias("text_hash"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(own).alias("component_id"),
            F.when(F.col("n") > 0, F.col("component")).alias("component"),
        )
    )

