"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstats.llm.common import NON_ALPHANUMERIC, Words, joined, per_text, pieces, signed, stored

#: Insults that vote without any labelled example.
SEED_WORDS = (
    "arsehole", "asshole", "bastard", "bitch", "bloody", "clown", "crap", "cretin", "damn", "disgusting",
    "dumb", "fool", "freak", "garbage", "hate", "idiot", "imbecile", "jerk", "kill", "loser",
    "lunatic", "moron", "nasty", "pathetic", "pig", "scum", "shit", "stupid", "trash", "ugly",
    "useless", "vermin", "vile", "worthless",
)
#: Voters: the learnt lexicon in quarters, strongest first, seed words, two or more lexicon words, a
#: dense lexicon, doubled exclamation marks; the last votes that a text is clean.
VOTERS = ("lexicon_a", "lexicon_b", "lexicon_c", "lexicon_d", "seed", "several", "dense", "shouting", "nothing")
#: Labels that go to every task; more are joined by shuffling.
_BROADCAST_LABELS = 500_000
#: Words that go to every task; contexts of more are joined by shuffling.
_BROADCAST_WORDS = 2_000_000
_DENSE = ("any", "several", "log_hits", "share", "seed")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; a row without id has no label to learn."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word with the word before it, once per piece and label."""
    for piece in pieces(batches, "text"):
        words = Words(piece.column("text"), NON_ALPHANUMERIC, lower=True)
        word = words.hashes()
        before = np.append(np.zeros(1, np.uint64), word[:-1])[: len(word)]
        before[words.first[:-1][words.counts > 0]] = 0
        toxic = np.repeat(piece.column("toxic").to_numpy(zero_copy_only=False) > 0, words.counts)
        context = joined(before, word)
        once = np.unique(joined(context, toxic.astype(np.uint64)), return_index=True)[1]
        yield pa.RecordBatch.from_arrays(
            [signed(word[once]), signed(context[once]), toxic[once].astype(np.int32), 1 - toxic[once].astype(np.int32)],
            ["word", "context", "toxic", "clean"],
        )


def _contexts_of(words):
    """The contexts of some words alone."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.value
        for found in _contexts(batches):
            word = found.column("word").to_numpy()
            place = np.minimum(np.searchsorted(known, word), max(len(known) - 1, 0))
            own = known[place] == word if len(known) else np.zeros(len(word), bool)
            context = found.column("context").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(word[own]), pa.array(context[own])], ["word", "context"])

    return find


def _rates(clean: Column, totals: tuple[int, int]) -> tuple[Column, Column]:
    """A word's share of the contexts of toxic and of clean texts."""
    return F.col("toxic") / max(totals[0], 1), (clean + 0.5) / max(totals[1], 1)


def _rated_words(
    taught: DataFrame, seeds: np.ndarray, min_contexts: int
) -> tuple[DataFrame, tuple[int, int]]:
    """``word, toxic, clean``: different contexts of each word that has enough of them in
    toxic texts, and of the seed words; and about how many contexts there are in all.

    Words that toxic texts hardly hold are left out before clean texts are looked at; the
    contexts of the rest are made distinct by one shuffle of two numbers each.
    """
    spark = taught.sparkSession
    schema = "word bigint, context bigint, toxic int, clean int"
    counts = (F.approx_count_distinct(F.when(F.col(c) == 1, F.col("context")), 0.01) for c in ("toxic", "clean"))
    totals = tuple(taught.mapInArrow(_contexts, schema).agg(*counts).first())
    in_toxic = taught.where("toxic > 0").mapInArrow(_contexts, schema).select("word", "context").distinct()
    seeded = spark.createDataFrame([(w, 0) for w in signed(seeds).tolist()], "word bigint, toxic bigint")
    candidates = stored(
        in_toxic.groupBy("word")
        .agg(F.count("*").alias("toxic"))
        .where((F.col("toxic") >= min_contexts) | F.col("word").isin(signed(seeds).tolist()))
        .unionByName(seeded)
        .groupBy("word")
        .agg(F.max("toxic").alias("toxic")),
        "toxic-words",
    )
    clean = taught.where("toxic <= 0")

    if candidates.count() <= _BROADCAST_WORDS:
        words = np.sort(candidates.select("word").toArrow().column(0).to_numpy())
        find = _contexts_of(spark.sparkContext.broadcast(words))
        contexts = clean.mapInArrow(find, "word bigint, context bigint")
    else:
        contexts = clean.mapInArrow(_contexts, schema).join(candidates, "word", "left_semi").select("word", "context")
    in_clean = contexts.distinct().groupBy("word").agg(F.count("*").alias("n"))
    rated = candidates.join(in_clean, "word", "left").select("word", "toxic", F.coalesce("n", F.lit(0)).alias("clean"))
    return stored(rated, "rated-words"), totals


def _observed(
    texts: pa.Array, known: np.ndarray, tier: np.ndarray, seeds: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every text the votes (as bits) and dense features; and which lexicon words it
    holds, as pairs of text and word number; ``known`` are the lexicon's sorted hashes."""
    words = Words(texts, NON_ALPHANUMERIC, lower=True)
    hashes, n = words.hashes(), len(texts)
    text = np.repeat(np.arange(n), words.counts)
    place = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
    hit = known[place] == hashes if len(known) else np.zeros(len(hashes), bool)
    hits = np.bincount(text[hit], minlength=n)
    owner, word = np.divmod(np.unique(text[hit] * len(known) + place[hit]), max(len(known), 1))
    kinds = np.bincount(owner, minlength=n)
    parts = [np.bincount(owner[tier[word] == part], minlength=n) > 0 for part in range(4)]
    seeded = np.bincount(text[np.isin(hashes, seeds)], minlength=n) > 0
    share = hits / np.maximum(words.counts, 1)
    mark = words.raw == ord("!")
    loud = per_text(mark & np.append(mark[1:], False)[: len(mark)], words.offsets) > 0
    votes = [*parts, seeded, kinds >= 2, share >= 0.01, loud, (hits == 0) & ~seeded]
    bits = sum(v.astype(np.int32) << i for i, v in enumerate(votes))
    dense = np.stack([hits > 0, kinds >= 2, np.log1p(hits), np.minimum(share * 20, 1), seeded], axis=1)
    return bits.astype(np.int32), dense.astype(float), owner, word


def _features(lexicon):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(_DENSE)
        for piece in pieces(batches, "text"):
            n = piece.num_rows
            bits, dense, owner, word = _observed(piece.column("text"), *lexicon.value)
            places = np.arange(0, n * size + 1, size, dtype=np.int32)
            kinds = np.append(0, np.cumsum(np.bincount(owner, minlength=n))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(bits),
                    pa.ListArray.from_arrays(places, pa.array(dense.ravel())),
                    pa.ListArray.from_arrays(kinds, pa.array(word.astype(np.int32))),
                ],
                ["doc_id", "votes", "dense", "words"],
            )

    return rows


@dataclass
class LabelModel:
    """Joint model of the true label and which voters fire.

    ``p(fires, y)`` is proportional to ``exp(prior y + sum fires_j (rate_j + accuracy_j y)
    + sum_jk fires_j fires_k correlation_jk)``; all states are enumerated, so the fit is
    exact. It starts from voters that are somewhat right; rows with a label fix ``y``.
    """

    prior: float
    rate: np.ndarray
    accuracy: np.ndarray
    correlation: np.ndarray

    @classmethod
    def fit(cls, counts: np.ndarray, voters: int, against: tuple[int, ...] = (), steps: int = 400) -> LabelModel:
        """``counts[pattern, 0..2]``: rows of a vote pattern without label, clean, toxic."""
        fires = (np.arange(1 << voters)[:, None] >> np.arange(voters) & 1).astype(float)
        left, right = np.triu_indices(voters, 1)
        terms = np.concatenate([np.ones((len(fires), 1)), fires, fires[:, left] * fires[:, right]], axis=1)
        # One column per parameter: those that do not depend on y, then those that do.
        start = np.where(np.isin(np.arange(voters), against), -2.0, 2.0)
        theta = np.zeros(terms.shape[1] - 1 + 1 + voters)
        theta[-voters:] = start
        theta[-voters - 1] = -2.0
        # What accuracies can explain is not left to correlations, which could explain all.
        restraint = np.full(len(theta), 1e-4)
        restraint[voters : voters + len(left)] = 1e-2
        total = max(counts.sum(), 1.0)
        weight = counts / total
        momentum, scale = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            free = terms[:, 1:] @ theta[: terms.shape[1] - 1]
            toxic = free + terms[:, : voters + 1] @ theta[-voters - 1 :]
            top = max(free.max(), toxic.max())
            z = np.exp(free - top).sum() + np.exp(toxic - top).sum()
            model = np.stack([np.exp(free - top), np.exp(toxic - top)], axis=1) / z
            posterior = model[:, 1] / model.sum(axis=1)
            seen = np.stack(
                [weight[:, 0] * (1 - posterior) + weight[:, 1], weight[:, 0] * posterior + weight[:, 2]], axis=1
            )
            gap = seen - model
            gradient = np.concatenate([terms[:, 1:].T @ gap.sum(axis=1), terms[:, : voters + 1].T @ gap[:, 1]])
            gradient -= restraint * theta
            momentum = 0.9 * momentum + 0.1 * gradient
            scale = 0.99 * scale + 0.01 * gradient**2
            theta += 0.1 * (momentum / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-8)
        pairs = np.zeros((voters, voters))
        pairs[left, right] = theta[voters : voters + len(left)]
        return cls(theta[-voters - 1], theta[:voters], theta[-voters:], pairs + pairs.T)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of toxic for each vote pattern."""
        fires = np.asarray(patterns)[:, None] >> np.arange(len(self.rate)) & 1
        return 1 / (1 + np.exp(-(self.prior + fires @ self.accuracy)))


def fit_linear(
    dense: np.ndarray, owner: np.ndarray, word: np.ndarray, size: int, target: np.ndarray, weight: np.ndarray
) -> np.ndarray:
    """Weights (bias, dense features, lexicon words) of a logistic regression on soft
    targets; ``word[i]`` occurs in row ``owner[i]``."""
    wide = np.concatenate([np.ones((len(dense), 1)), dense], axis=1)
    theta = np.zeros(wide.shape[1] + size)
    momentum, scale = np.zeros_like(theta), np.zeros_like(theta)
    total = max(weight.sum(), 1.0)
    for step in range(1, 401):
        z = wide @ theta[: wide.shape[1]] + np.bincount(owner, theta[wide.shape[1] + word], len(wide))
        gap = weight * (target - 1 / (1 + np.exp(-z))) / total
        gradient = np.concatenate([wide.T @ gap, np.bincount(word, gap[owner], size)])
        gradient[1:] -= 1e-5 * theta[1:]
        momentum = 0.9 * momentum + 0.1 * gradient
        scale = 0.99 * scale + 0.01 * gradient**2
        theta += 0.1 * (momentum / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-8)
    return theta


@dataclass
class ToxicityModel:
    """Sorted hashes of the lexicon, the quarter of each by strength, hashes of the seed
    words, weights (bias, dense features, words) and the label model."""

    lexicon: np.ndarray
    tier: np.ndarray
    seeds: np.ndarray
    weights: np.ndarray
    label_model: LabelModel

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``score``, 0 to 1; one of that name is replaced.

        Null or empty text scores as one without any word of the lexicon. Neither
        ids nor other columns are looked at, and no row is shuffled.
        """
        plain = docs.drop("score")
        model = plain.sparkSession.sparkContext.broadcast((self.lexicon, self.tier, self.seeds, self.weights))

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lexicon, tier, seeds, weights = model.value
            head = 1 + len(_DENSE)
            for piece in pieces(batches, "text"):
                _, dense, owner, word = _observed(piece.column("text"), lexicon, tier, seeds)
                z = weights[0] + dense @ weights[1:head]
                z += np.bincount(owner, weights[head + word], piece.num_rows)
                score = pa.array(1 / (1 + np.exp(-z)), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, score], schema=piece.schema.append(pa.field("score", pa.float64()))
                )

        return plain.mapInArrow(rows, T.StructType([*plain.schema, T.StructField("score", T.DoubleType())]))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 20_000,
    max_words: int = 65_536,
    min_contexts: int = 4,
    min_ratio: float = 20.0,
) -> ToxicityModel:
    """Model from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``).

    Voters are a learnt lexicon in quarters, seed words and patterns. The lexicon is
    learnt from all labelled rows: words after at least
    ``min_contexts`` different words in toxic texts, at ``min_ratio`` times the rate of
    clean texts; ``max_words`` with the clearest difference, far more than such words,
    bound what every task gets. Contexts are counted, not texts, since near copies repeat
    a word in one context. A seed word that is seen in two contexts and misses this ratio
    is an ordinary word here and does not vote.

    A generative label model of all voters, their accuracies and pairwise correlations
    is fitted to the vote patterns of all documents that are not held out; where such
    a document has a label, it fixes the document's true label in this fit. Its posteriors,
    one per vote pattern, are what the linear classifier is trained on: all documents
    without a lexicon word count, and of the different feature rows of those with one about
    ``max_rows``, each with the number of its documents.

    Labels of rows that :func:`held_out` names are never read. Null labels are none;
    of several labels of an id the highest counts; a row without ``doc_id`` has none.
    Repeated rows count as often as they occur. Without labels the seed words and
    patterns alone vote. Empty tables give a model that scores all texts alike. Other
    columns are not used. What reaches the driver is bounded by the parameters: the
    lexicon, 512 vote patterns and about ``max_rows`` different feature rows, picked by a
    hash of the row itself, so neither a hot id nor missing ids nor copies add to them.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(~held_out(F.col("doc_id")))
    known = stored(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic")),
        "toxic-labels",
    )

    small = known.limit(_BROADCAST_LABELS + 1).count() <= _BROADCAST_LABELS
    taught = rows.where(F.col("text").isNotNull()).join(F.broadcast(known) if small else known, "doc_id")
    taught = taught.select("toxic", "text")
    seeds = Words(pa.array([" ".join(SEED_WORDS)]), NON_ALPHANUMERIC).hashes()
    rated, totals = _rated_words(taught, seeds, min_contexts)
    toxic_rate, clean_rate = _rates(F.col("clean"), totals)
    telling = toxic_rate >= min_ratio * clean_rate
    lexicon = (
        rated.where(F.col("toxic") >= min_contexts)
        .where(telling)
        .orderBy(((toxic_rate - clean_rate) / F.sqrt(toxic_rate + clean_rate)).desc(), "word")
        .limit(max_words)
        .select("word")
    )
    strongest = np.array([r.word for r in lexicon.collect()], np.int64).view(np.uint64)
    common = (
        rated.where(F.col("word").isin(signed(seeds).tolist()))
        .where(F.col("toxic") + F.col("clean") >= 2)
        .where(~telling)
        .collect()
    )
    seeds = np.setdiff1d(seeds, np.array([r.word for r in common], np.int64).view(np.uint64))
    order = np.argsort(strongest)
    vocabulary, tier = strongest[order], order * 4 // max(len(order), 1)
    words = spark.sparkContext.broadcast((vocabulary, tier, seeds))

    label = F.when(F.col("toxic").isNull(), 0).when(F.col("toxic") > 0, 2).otherwise(1)
    # Documents with the same votes and features are one row with their number, and all
    # without a word of the lexicon are few such rows.
    patterns = stored(
        rows.mapInArrow(_features(words), "doc_id bigint, votes int, dense array<double>, words array<int>")
        .join(F.broadcast(known) if small else known, "doc_id", "left")
        .groupBy("votes", "dense", "words", label.alias("label"))
        .agg(F.count("*").alias("n")),
        "toxic-features",
    )
    counts = np.zeros((1 << len(VOTERS), 3))
    for votes, kind, n in patterns.groupBy("votes", "label").agg(F.sum("n")).collect():
        counts[votes, kind] = n
    model = LabelModel.fit(counts, len(VOTERS), against=(VOTERS.index("nothing"),))

    plain = patterns.where(F.size("words") == 0).groupBy("votes", "dense").agg(F.sum("n").alias("n")).collect()
    hits = patterns.where(F.size("words") > 0).groupBy("votes", "dense", "words").agg(F.sum("n").alias("n"))
    share = min(1.0, max_rows / max(hits.count(), 1))
    chosen = F.pmod(F.xxhash64("votes", "dense", "words"), F.lit(1_000_000)) < int(share * 1_000_000)
    table = hits.where(chosen).toPandas()
    dense = np.array([*(r.dense for r in plain), *table["dense"]], float).reshape(-1, len(_DENSE))
    votes = np.array([*(r.votes for r in plain), *table["votes"]], np.int64)
    owner = np.repeat(np.arange(len(table)) + len(plain), [len(x) for x in table["words"]])
    word = np.array([w for x in table["words"] for w in x], np.int64)
    weight = np.array([*(r.n for r in plain), *table["n"]], float)
    # Documents without a hit far outnumber the others; they weigh as much together.
    ratio = max(weight[len(plain) :].sum(), 1.0) / max(weight[: len(plain)].sum(), 1.0)
    weight[: len(plain)] *= min(1.0, ratio)
    weights = fit_linear(dense, owner.astype(np.int64), word, len(vocabulary), model.posterior(votes), weight)
    return ToxicityModel(vocabulary, tier, seeds, weights, model)
