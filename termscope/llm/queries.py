"""The registered queries of the operators, over the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscope.llm.conversations import REPAIR_SQL, repaired_conversations
from termscope.llm.decontamination import CONTAMINATION_SQL, contamination
from termscope.llm.embeddings import near_vectors
from termscope.llm.exact import EXACT_SQL, exact_duplicates
from termscope.llm.html_text import extract_text
from termscope.llm.jaccard import jaccard_components
from termscope.llm.lines import LINES_SQL, dedup_lines
from termscope.llm.merkle import MANIFEST_SQL, manifest
from termscope.llm.packing import pack_documents
from termscope.llm.recompression import kept_words
from termscope.llm.secrets import secrets
from termscope.llm.suffix import kept_bytes
from termscope.llm.toxicity import toxicity


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", "text")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kept_bytes(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pack_documents(_table(spark, sf_dir, "documents"), TOKENIZER)
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kept_words(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_conversations(_table(spark, sf_dir, "conversations"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_line_dedup": op5_line_dedup,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_secret_scans": op7_secret_scans,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLES: dict[str, str] = {
    "op1_benchmark_decontamination": CONTAMINATION_SQL
    + """
SELECT w.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words,
       coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)""",
    "op5_line_dedup": LINES_SQL
    + """
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN c.text END AS text
FROM documents d LEFT JOIN cleaned c USING (doc_id)""",
    "op11_conversation_repair": REPAIR_SQL,
    "op12_exact_dedup": EXACT_SQL,
    "op13_merkle_manifest": MANIFEST_SQL,
}
