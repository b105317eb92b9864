"""Document-presence counters."""

from pyspark.sql import functions as F

from termscope.catalog.base import STOP, docs, sql_corpus, sql_counts, sql_docs, sql_with, table
from termscope.operators import counts as ops
from termscope.sources.storage import new_path


def _tally(spark, sf_dir, category="lang"):
    return ops.tally(docs(spark, sf_dir, category), STOP)


def count_docs(spark, sf_dir):
    return docs(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


def category_doc_counts(spark, sf_dir):
    return docs(spark, sf_dir).groupBy("category").agg(F.count(F.lit(1)).alias("nc"))


def term_doc_freq(spark, sf_dir):
    return ops.term_rows(_tally(spark, sf_dir))


def category_term_doc_freq(spark, sf_dir):
    return ops.category_term_rows(_tally(spark, sf_dir))


def tagged_counts(spark, sf_dir):
    """Written as the counts table and read back, as a later run would."""
    path = new_path(spark, "counts")
    ops.write_counts(ops.tagged_counts(_tally(spark, sf_dir)), path)
    return ops.read_counts(spark, path)


def counts_grouping_sets(spark, sf_dir):
    counted = ops.tagged_counts(_tally(spark, sf_dir, "source"))
    return counted.where(F.col("tag").isin("NT", "NTC")).select("category", "term", "cnt")


def counts_demux(spark, sf_dir):
    return ops.with_tag(ops.tagged_counts(_tally(spark, sf_dir)), "NT").select("term", "cnt")


def corpus_meta(spark, sf_dir):
    return ops.corpus_meta(ops.tagged_counts(_tally(spark, sf_dir)))


def known_categories(spark, sf_dir):
    """Counts per source, kept where the metadata of the low-quality toxic
    documents knows the source."""
    labels = table(spark, sf_dir, "labels").where("quality = 0 AND toxic = 1").select("doc_id")
    corpus = docs(spark, sf_dir, "source")
    meta = corpus.select("doc_id", "category").join(labels, "doc_id").groupBy("category").agg(
        F.count(F.lit(1)).alias("nc")
    )
    return ops.known_categories(ops.category_term_rows(ops.tally(corpus, STOP)), meta).select(
        "category", "term", "ntc"
    )


QUERIES = {
    "count_docs": count_docs,
    "category_doc_counts": category_doc_counts,
    "term_doc_freq": term_doc_freq,
    "category_term_doc_freq": category_term_doc_freq,
    "tagged_counts": tagged_counts,
    "counts_grouping_sets": counts_grouping_sets,
    "counts_demux": counts_demux,
    "corpus_meta": corpus_meta,
    "known_categories": known_categories,
}

_LANG = (*sql_corpus(), sql_counts())
_SOURCE = (*sql_corpus("source"), sql_counts())

ORACLES = {
    "count_docs": sql_with(sql_docs(), select="SELECT count(*) AS n FROM docs"),
    "category_doc_counts": sql_with(
        sql_docs(), select="SELECT category, count(*) AS nc FROM docs GROUP BY category"
    ),
    "term_doc_freq": sql_with(*_LANG, select="SELECT term, nt FROM nt"),
    "category_term_doc_freq": sql_with(*_LANG, select="SELECT category, term, ntc FROM ntc"),
    "tagged_counts": sql_with(
        *_LANG,
        select="""SELECT 'N' AS tag, NULL AS category, NULL AS term, n AS cnt FROM n
UNION ALL SELECT 'NC', category, NULL, nc FROM nc
UNION ALL SELECT 'NT', NULL, term, nt FROM nt
UNION ALL SELECT 'NTC', category, term, ntc FROM ntc""",
    ),
    "counts_grouping_sets": sql_with(
        *sql_corpus("source"),
        select="""SELECT category, term, count(*) AS cnt FROM terms
GROUP BY GROUPING SETS ((category, term), (term))""",
    ),
    "counts_demux": sql_with(*_LANG, select="SELECT term, nt AS cnt FROM nt"),
    "corpus_meta": sql_with(*_LANG, select="SELECT category, n, nc FROM nc CROSS JOIN n"),
    "known_categories": sql_with(
        *_SOURCE,
        "meta AS (SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) "
        "WHERE quality = 0 AND toxic = 1)",
        select="SELECT category, term, ntc FROM ntc WHERE category IN (SELECT source FROM meta)",
    ),
}
