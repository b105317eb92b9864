"""Tokenizing and filtering."""

from pyspark.sql import functions as F

from termscope.catalog.base import (
    SQL_DELIMITERS,
    STOP,
    docs,
    sql_corpus,
    sql_docs,
    sql_terms,
    sql_with,
    sql_words,
    table,
)
from termscope.functions.text import keep_terms, words
from termscope.operators.terms import document_terms, drop_stopwords, tokens
from termscope.sources.stopwords import normalize_stopwords

_POSITIONED = f"""tok AS (
  SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (
    SELECT doc_id, regexp_split_to_array(reviewText, '{SQL_DELIMITERS}') AS w FROM docs)),
tokens AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INT) AS pos,
         lower(w) AS token
  FROM tok WHERE w <> '')"""


def tokenize(spark, sf_dir):
    return tokens(docs(spark, sf_dir), ["doc_id"])


def filter_tokens(spark, sf_dir):
    kept = docs(spark, sf_dir).select(
        "doc_id", F.posexplode(keep_terms(words("reviewText"), STOP)).alias("pos", "token")
    )
    return kept.select("doc_id", "pos", "token")


def doc_terms(spark, sf_dir):
    return document_terms(docs(spark, sf_dir), ["doc_id", "category"], STOP)


def _benchmark_words(spark, sf_dir):
    """Every word of the benchmark texts, as the lines of a stopword file."""
    return table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("value"))


def stopword_anti_join(spark, sf_dir):
    terms = document_terms(docs(spark, sf_dir), ["doc_id", "category"])
    return drop_stopwords(terms, normalize_stopwords(_benchmark_words(spark, sf_dir))).select(
        "doc_id", "category", "term"
    )


def stopword_norm(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(
        F.explode(
            F.array(
                F.concat(F.lit(" "), F.upper("p_name"), F.lit(" \t")),
                F.concat(F.col("p_type"), F.lit(" ")),
                F.lit("  "),
            )
        ).alias("value")
    )
    return normalize_stopwords(names)


def events_json_key(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("k")
    )


QUERIES = {
    "tokenize": tokenize,
    "filter_tokens": filter_tokens,
    "doc_terms": doc_terms,
    "stopword_anti_join": stopword_anti_join,
    "stopword_norm": stopword_norm,
    "events_json_key": events_json_key,
}

ORACLES = {
    "tokenize": sql_with(sql_docs(), _POSITIONED, select="SELECT doc_id, pos, token FROM tokens"),
    "filter_tokens": sql_with(
        sql_docs(),
        _POSITIONED,
        "words AS (SELECT doc_id, pos, token AS term, '' AS category FROM tokens)",
        sql_terms(),
        select="""SELECT doc_id, term AS token, CAST(row_number()
  OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INT) AS pos FROM kept""",
    ),
    "doc_terms": sql_with(*sql_corpus(), select="SELECT doc_id, category, term FROM terms"),
    "stopword_anti_join": sql_with(
        sql_docs(),
        sql_words(),
        sql_terms(stop=False),
        "stop AS (SELECT DISTINCT lower(trim(w, chr(10) || chr(9) || chr(13) || ' ')) AS term FROM "
        "(SELECT unnest(string_split(text, ' ')) AS w FROM benchmark))",
        select="SELECT doc_id, category, term FROM terms "
        "WHERE NOT EXISTS (SELECT 1 FROM stop WHERE stop.term = terms.term)",
    ),
    "stopword_norm": """SELECT DISTINCT term FROM (
  SELECT lower(trim(p_name)) AS term FROM part UNION ALL SELECT lower(trim(p_type)) FROM part)
WHERE term <> ''""",
    "events_json_key": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
}
