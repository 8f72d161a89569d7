"""The corpus pipeline: documents become packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and all but
the last return the columns of documents; ``run`` writes each stage's rows as Parquet and
reads them back for the next one. Nulls, empty texts, repeated rows and empty tables are
handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave.llm import exact, near, packing, suffixes, toxicity
from tripweave.llm.common import stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold stay."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    column = next(name for i in range(len(docs.columns) + 1) if (name := f"toxicity_{i}") not in docs.columns)
    scored = toxicity.score(docs, model, column=column)
    return scored.where(F.col(column) < toxicity.THRESHOLD).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the longest stays."""
    return exact.keep_one(docs).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return near.keep_one(docs).select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that stand anywhere else are cut out; every document
    stays, with the rest of its text and its new number of characters."""
    cut = suffixes.remove_repeats(docs, whole_characters=True)
    changed = {"text": F.col("kept").cast("string"), "n_chars": F.length(F.col("kept").cast("string")).cast("long")}
    columns = [
        changed[c].alias(c) if c in changed else F.col(c) if c == "doc_id" else F.col("others")[c].alias(c) for c in docs.columns
    ]
    return cut.select(*columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: one row per piece of a document, with its ids."""
    pieces = packing.pack_texts(docs, "doc_id", "text")
    columns = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    return pieces.select(*columns, F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("suffix_dedup", without_repeats),
    ("packing", packed),
]

# A trained classifier and sketches are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
