"""From raw documents to packed training sequences, one operator per stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscope.llm.decontamination import decontaminated
from termscope.llm.jaccard import near_duplicates_removed
from termscope.llm.lines import dedup_lines
from termscope.llm.packing import pack_documents
from termscope.llm.toxicity import without_toxic
from termscope.sources.storage import stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from ``labels``."""
    return without_toxic(docs, _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks of lines that an earlier document has.

    Documents of which nothing is left were copies throughout and go. So ``n_chars``
    says how long the text now is.
    """
    found = dedup_lines(docs).where("n_removed < n_lines or n_lines = 0")
    changed = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType)).select(
        *docs.columns
    )


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of least doc_id, of each group of near duplicates."""
    return near_duplicates_removed(docs, words=5, percent=80).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten consecutive words of a benchmark item."""
    return decontaminated(docs, _table(spark, sf_dir, "benchmark")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left and their places in sequences of 4096 tokens."""
    return pack_documents(docs, TOKENIZER)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Learned weights, hashes and token ids cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage's result written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
