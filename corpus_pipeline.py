"""Corpus pipeline over ``documents``: drop toxic documents, drop repeated lines, keep one
of each group of near duplicates, drop contaminated documents, mix the sources.

Every stage works on all rows of the one before. A null text is an empty document:
nothing rejects it, and it is in no group. Rows may share a ``doc_id`` or have none; an
empty table gives an empty one. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalstats.llm.common import stored
from signalstats.llm.decontaminate import find_benchmark
from signalstats.llm.lines import line_dedup
from signalstats.llm.mixing import mix_sources
from signalstats.llm.ngram_join import ngram_components
from signalstats.llm.toxicity import fit_toxicity
from signalstats.session import ship_package

#: Score from which a document counts as toxic.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below :data:`TOXIC`; the labels train the model."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return model.score(docs).where(F.col("score") < TOXIC).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that another one keeps; ``n_chars`` follows the text."""
    shorter = line_dedup(docs)
    if "n_chars" in docs.columns:
        shorter = shorter.withColumn("n_chars", F.char_length("text").cast("long"))
    return shorter.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest ``doc_id``, one
    without id only where the group has no other; of several texts with that id the one
    with the smallest hash, of repeated rows one. Documents without words are in no group
    and all stay.
    """
    groups = ngram_components(docs).where("component IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash"))
    stays = groups.groupBy(F.col("component").alias("__component")).agg(first.alias("__first"))
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    named = docs.where(worded).withColumn("__text_hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__first.doc_id")) & (F.col("__text_hash") == F.col("__first.text_hash"))
    kept = named.join(stays, same).dropDuplicates(["__component"]).select(docs.columns)
    return kept.unionByName(docs.where(~worded))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth occurs in the benchmark."""
    found = find_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~F.col("contaminated")).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mix of the sources."""
    return mix_sources(docs, max_sources=None)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix),
]

#: SQL cannot express the first stage, a trained model, on which all others build.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every stage reads what the one before has written."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
