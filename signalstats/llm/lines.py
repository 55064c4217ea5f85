"""Line dedup: lines that many documents hold are dropped from all but one. SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalstats.llm.common import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


def _hash(key: Column) -> Column:
    """128 bits, so that no two of 10^13 lines are expected to share them."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(7), key).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with deduplicated ``text``, and ``n_lines`` (before) and ``n_dropped``.

    A line's key is the line without blanks at both ends, in lower case. Keys of at
    least ``min_chars`` code points that at least ``min_docs`` documents hold lose
    all their lines, except in the document with the largest ``doc_id`` among them;
    there all stay, repeated ones too.

    Null or empty text: one empty line, the result is empty text. Rows that share a
    ``doc_id`` are one document when counting, and each loses the same keys. A row
    without ``doc_id`` is no document: it does not count and loses nothing. Other
    columns pass through; an ``n_lines`` or ``n_dropped`` among them is replaced.

    One row of two hashes per long line is written and counted with map-side
    combining; the join back to the lines is one that adaptive execution splits for
    frequent keys. The text is shuffled once, by document.
    """
    long_keys = F.filter(
        F.transform(_lines(F.col("text")), lambda x: line_key(x)), lambda k: F.char_length(k) >= min_chars
    )
    keyed = stored(
        docs.where(F.col("doc_id").isNotNull())
        .select("doc_id", F.explode(F.array_distinct(F.transform(long_keys, _hash))).alias("k"))
        .select("doc_id", "k.a", "k.b"),
        "line-keys",
    )
    # Written, so that the join below reads two plain shuffles, which can be split.
    frequent = stored(
        keyed.distinct()
        .groupBy("a", "b")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("a", "b", "keeper"),
        "frequent-lines",
    )
    lost = (
        keyed.join(frequent, ["a", "b"])
        .where(F.col("doc_id") != F.col("keeper"))
        .groupBy(F.col("doc_id").alias("__lost_id"))
        .agg(F.collect_set(F.struct("a", "b")).alias("__lost"))
    )
    lines = _lines(F.col("text"))
    untouched = F.col("__lost").isNull()
    return (
        docs.join(lost, F.col("doc_id") == F.col("__lost_id"), "left")
        .withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("__kept", F.filter(lines, lambda x: ~F.array_contains(F.col("__lost"), _hash(line_key(x)))))
        .withColumn("n_dropped", F.when(untouched, 0).otherwise(F.col("n_lines") - F.size("__kept")).cast("long"))
        .withColumn("text", F.when(untouched, F.coalesce("text", F.lit(""))).otherwise(F.array_join("__kept", "\n")))
        .drop("__lost_id", "__lost", "__kept")
    )
