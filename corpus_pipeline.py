"""The corpus pipeline: stages in order, each over all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staveline.llm.common import table
from staveline.llm.lines import dedup_lines
from staveline.llm.ngram_join import one_of_each
from staveline.llm.packing import pack
from staveline.llm.tokens import vocabulary_path
from staveline.llm.toxicity import score
from staveline.session import settled, tune


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.7; the classifier learns from the labelled rows that op5 learns from."""
    scored = score(docs, table(spark, sf_dir, "labels"), modulus=3, remainder=1, carry=True)
    return scored.filter("predicted = 0").select("document.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more share, but for the last holder; n_chars follows."""
    kept = dedup_lines(docs, min_chars=20, min_docs=3)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest doc_id, of each group that near copies link.

    Links are a Jaccard similarity of 0.8 or more over five-word shingles.
    Documents without words are no copies of each other, and stay.
    """
    return one_of_each(docs, words=5, num=80, den=100)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 2048 tokens."""
    return pack(docs, vocabulary_path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_copies),
    ("best_fit_packing", packing),
]

# A trained classifier and tokenizers are beyond SQL; the tests check run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    tune(spark)
    # Whole documents pass the Python workers; a few hundred of them bound a batch, whatever its stage.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
