"""Mixing sources to target weights by Pfair scheduling of their blocks."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalstats.llm.common import stored

#: Sources from which on a mix is refused unless the caller says otherwise.
MAX_SOURCES = 1_000
#: Denominator of the weights: finer than a double, so that it adds no deviation at any number of slots.
QUANTA = 1 << 62
#: Rows of one source that are numbered together, on average.
_BUCKET_ROWS = 512
#: Blocks that the schedule hands over at a time.
_BATCH = 10_000


def quantised(weights: dict[str, float], quanta: int = QUANTA) -> dict[str, int]:
    """Positive whole shares of ``quanta`` by largest remainders, at least one each."""
    ratios = {s: Fraction(w) for s, w in weights.items()}
    unit = math.lcm(*(r.denominator for r in ratios.values()))
    parts = {s: r.numerator * (unit // r.denominator) for s, r in ratios.items()}
    total = sum(parts.values())
    shares = {s: max(1, n * quanta // total) for s, n in parts.items()}
    while (gap := quanta - sum(shares.values())) != 0:
        step = 1 if gap > 0 else -1
        able = [s for s in shares if step > 0 or shares[s] > 1]
        able.sort(key=lambda s: (step * (parts[s] * quanta - shares[s] * total), s), reverse=True)
        for s in able[: abs(gap)]:
            shares[s] += step
    return shares


def pfair(shares: dict[str, int]) -> Iterator[str]:
    """The schedule without end: the source of every slot.

    With weight ``w = share / sum of shares`` block ``i`` (from 0) of a source is
    released at slot ``floor(i / w)`` and due before slot ``ceil((i + 1) / w)``. Each
    slot goes to the released block with the earliest deadline. On one queue that
    meets every deadline, so after any number of slots ``t`` a source has ``w t``
    blocks with a deviation of less than one.
    """
    total = sum(shares.values())
    waiting = [(0, -(-total // n), s, 0) for s, n in shares.items()]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slot = 0
    while True:
        while waiting and waiting[0][0] <= slot:
            _, due, source, block = heapq.heappop(waiting)
            heapq.heappush(ready, (due, source, block))
        _, source, block = heapq.heappop(ready)
        yield source
        n, block, slot = shares[source], block + 1, slot + 1
        heapq.heappush(waiting, (block * total // n, -(-(block + 1) * total // n), source, block))


def pfair_period(shares: dict[str, int]) -> list[str]:
    """One period of :func:`pfair`."""
    return list(islice(pfair(shares), sum(shares.values())))


def schedule(blocks: dict[str, int], weights: dict[str, float], quanta: int = QUANTA) -> Iterator[tuple[str, int]]:
    """Source and block of every slot.

    A phase ends with the slot in which a source has given its last block; the next
    one mixes the others by their weights.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    given = dict.fromkeys(left, 0)
    while left:
        shares = quantised({s: weights[s] for s in left}, max(quanta, len(left)))
        for source in pfair(shares):
            yield source, given[source]
            given[source] += 1
            left[source] -= 1
            if not left[source]:
                del left[source]
                break


def _slots(weights: dict[str, float], exponent: float, block_rows: int):
    """Rows ``(__s, block, slot)`` of the whole schedule from rows ``(__s, n)`` of all sources."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: dict[str, int] = {}
        for batch in batches:
            sizes.update(zip(batch.column("__s").to_pylist(), batch.column("n").to_pylist(), strict=True))
        target = {s: float(weights.get(s, n**exponent)) for s, n in sizes.items()}
        slots = schedule({s: -(-n // block_rows) for s, n in sizes.items()}, target)
        start = 0
        while part := list(islice(slots, _BATCH)):
            sources, blocks = zip(*part, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sources, pa.string()),
                    pa.array(blocks, pa.int64()),
                    pa.array(range(start, start + len(part)), pa.int64()),
                ],
                ["__s", "block", "slot"],
            )
            start += len(part)

    return rows


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    exponent: float = 0.7,
    block_rows: int = 32,
    seed: int = 0,
    max_sources: int | None = MAX_SOURCES,
) -> DataFrame:
    """All columns of ``docs`` and ``block`` (of its source), ``slot`` and ``position``:
    ordered by ``position`` the rows follow the target weights. No row is lost.

    ``weights`` gives each source's share of the blocks. Without it, or for a source
    that it does not name, the weight is the source's number of rows to the power
    ``exponent``, which lifts small sources. Rows of a source are shuffled by a hash
    of ``doc_id`` and cut into blocks of ``block_rows``; the last may be shorter. The
    blocks are interleaved by :func:`schedule`; ``position`` is ``slot * block_rows``
    and the place in the block, so it rises without being dense.

    Null source: the source ''. Rows with one ``doc_id`` lie next to each other, in
    the order of their text; null ids are ordered by text. An empty table gives an
    empty result. More than ``max_sources`` sources: ``ValueError``; with None any number
    is mixed. Columns of the three result names are replaced.

    Rows are numbered in two steps, by buckets of the hash and within a bucket, so no
    task holds a source. The schedule is made by one task, which reads a row per source
    and writes a row per block; each slot depends on the one before, and
    every source that is used up weighs the others anew. Rows are joined with it by
    source and block.
    """
    docs = docs.drop("block", "slot", "position")
    source = F.coalesce(F.col("source"), F.lit(""))
    counts = stored(docs.groupBy(source.alias("__s")).agg(F.count("*").alias("n")), "source-counts")
    if max_sources is not None and counts.limit(max_sources + 1).count() > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    weights = dict(weights or {})
    wrong = [s for s, w in weights.items() if w <= 0]
    if wrong and counts.where(F.col("__s").isin(wrong)).take(1):
        raise ValueError("weights must be positive")
    slots = stored(
        counts.repartition(1).mapInArrow(
            _slots(weights, exponent, block_rows), "__s string, block bigint, slot bigint"
        ),
        "slots",
    )

    buckets = max(1, (counts.agg(F.max("n")).first()[0] or 0) // _BUCKET_ROWS)
    spread = F.xxhash64(F.lit(seed), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    keyed = (
        docs.withColumn("__s", source)
        .withColumn("__h", spread)
        .withColumn("__t", F.xxhash64("text"))
        .withColumn("__b", F.pmod(F.shiftrightunsigned("__h", 8), F.lit(buckets)))
    )
    before = (
        keyed.groupBy("__s", "__b")
        .agg(F.count("*").alias("n"))
        .withColumn("__before", F.sum("n").over(Window.partitionBy("__s").orderBy("__b")) - F.col("n"))
        .drop("n")
    )
    number = F.row_number().over(Window.partitionBy("__s", "__b").orderBy("__h", "doc_id", "__t"))
    numbered = (
        keyed.withColumn("__n", number - 1)
        .join(before, ["__s", "__b"])
        .withColumn("__n", F.col("__before") + F.col("__n"))
        .withColumn("block", F.floor(F.col("__n") / block_rows))
    )
    return (
        numbered.join(slots, ["__s", "block"])
        .withColumn("position", F.col("slot") * block_rows + F.pmod(F.col("__n"), F.lit(block_rows)))
        .select(*docs.columns, "block", "slot", "position")
    )
