"""Relational term weights."""

from pyspark.sql import functions as F

from termscope.catalog.base import STOP, docs, reviews, sql_corpus, sql_docs, sql_with
from termscope.operators import vectors as ops


def term_frequency(spark, sf_dir):
    return ops.term_frequency(docs(spark, sf_dir), STOP)


def vocabulary(spark, sf_dir):
    return ops.vocabulary(docs(spark, sf_dir), STOP)


def idf(spark, sf_dir):
    return ops.idf(docs(spark, sf_dir), STOP).withColumn("idf", F.round("idf", 6))


def tfidf(spark, sf_dir):
    return ops.tfidf(docs(spark, sf_dir), STOP).withColumn("weight", F.round("weight", 6))


def l2_tfidf(spark, sf_dir):
    weights = ops.unit_tfidf(docs(spark, sf_dir), STOP)
    return weights.withColumn("weight", F.round("weight", 6))


def label_index(spark, sf_dir):
    return ops.label_index(reviews(spark, sf_dir, "source"))


QUERIES = {
    "term_frequency": term_frequency,
    "vocabulary": vocabulary,
    "idf": idf,
    "tfidf": tfidf,
    "l2_tfidf": l2_tfidf,
    "label_index": label_index,
}

_TF = "tf AS (SELECT doc_id, term, count(*) AS tf FROM kept GROUP BY doc_id, term)"
_IDF = """df AS (SELECT term, count(*) AS df FROM terms GROUP BY term),
idf AS (SELECT term, df, ln((m + 1.0) / (df + 1.0)) AS idf
        FROM df CROSS JOIN (SELECT CAST(count(*) AS DOUBLE) AS m FROM docs))"""
_W = "w AS (SELECT doc_id, term, tf * idf AS weight FROM tf JOIN idf USING (term))"

ORACLES = {
    "term_frequency": sql_with(*sql_corpus(), _TF, select="SELECT doc_id, term, tf FROM tf"),
    "vocabulary": sql_with(
        *sql_corpus(),
        "freq AS (SELECT term, count(*) AS freq FROM kept GROUP BY term)",
        select="SELECT row_number() OVER (ORDER BY freq DESC, term) - 1 AS idx, term, freq FROM freq",
    ),
    "idf": sql_with(*sql_corpus(), _IDF, select="SELECT term, df, round(idf, 6) AS idf FROM idf"),
    "tfidf": sql_with(
        *sql_corpus(), _TF, _IDF, _W, select="SELECT doc_id, term, round(weight, 6) AS weight FROM w"
    ),
    "l2_tfidf": sql_with(
        *sql_corpus(),
        _TF,
        _IDF,
        _W,
        "len AS (SELECT doc_id, sqrt(sum(weight * weight)) AS len FROM w GROUP BY doc_id)",
        select="""SELECT doc_id, term,
  round(CASE WHEN len = 0 THEN 0.0 ELSE weight / len END, 6) AS weight FROM w JOIN len USING (doc_id)""",
    ),
    "label_index": sql_with(
        sql_docs("source"),
        "c AS (SELECT category AS label, count(*) AS cnt FROM docs GROUP BY category)",
        select="SELECT label, row_number() OVER (ORDER BY cnt DESC, label) - 1 AS idx, cnt FROM c",
    ),
}
