"""Association scores and top terms."""

from pyspark.sql import functions as F

from termscope.catalog.base import (
    STOP,
    docs,
    sql_corpus,
    sql_counts,
    sql_global,
    sql_ranked,
    sql_scored,
    sql_with,
)
from termscope.operators import scores as ops
from termscope.operators.counts import run_summary as summarize
from termscope.operators.counts import tally


def table(spark, sf_dir, category="lang"):
    return ops.contingency(tally(docs(spark, sf_dir, category), STOP))


def scored(spark, sf_dir, category="lang"):
    return ops.score_pairs(table(spark, sf_dir, category))


def ranked(spark, sf_dir, category="lang"):
    return ops.top_terms(scored(spark, sf_dir, category))


def join_nt_ntc(spark, sf_dir):
    return ops.join_term_totals(tally(docs(spark, sf_dir), STOP))


def chi_square_scores(spark, sf_dir):
    return scored(spark, sf_dir)


def topk_terms_per_category(spark, sf_dir):
    return ranked(spark, sf_dir)


def topk_terms_per_source(spark, sf_dir):
    return ranked(spark, sf_dir, "source")


def topn_terms_global(spark, sf_dir):
    return ops.top_terms_global(table(spark, sf_dir))


def run_summary(spark, sf_dir):
    pairs = scored(spark, sf_dir)
    return summarize(pairs, ops.top_terms(pairs))


QUERIES = {
    "join_nt_ntc": join_nt_ntc,
    "chi_square_scores": chi_square_scores,
    "topk_terms_per_category": topk_terms_per_category,
    "topk_terms_per_source": topk_terms_per_source,
    "topn_terms_global": topn_terms_global,
    "run_summary": run_summary,
}

_LANG = (*sql_corpus(), sql_counts(), sql_scored())
_RANKED = "SELECT category, rk, term, chi2 FROM ranked"

ORACLES = {
    "join_nt_ntc": sql_with(
        *sql_corpus(), sql_counts(), select="SELECT category, term, ntc, nt FROM ntc JOIN nt USING (term)"
    ),
    "chi_square_scores": sql_with(*_LANG, select="SELECT category, term, chi2 FROM scored"),
    "topk_terms_per_category": sql_with(*_LANG, sql_ranked(), select=_RANKED),
    "topk_terms_per_source": sql_with(
        *sql_corpus("source"), sql_counts(), sql_scored(), sql_ranked(), select=_RANKED
    ),
    "topn_terms_global": sql_with(
        *sql_corpus(), sql_counts(), sql_global(), select="SELECT term, nt, chi2 FROM top"
    ),
    "run_summary": sql_with(
        *_LANG,
        sql_ranked(),
        select="""SELECT (SELECT count(*) FROM scored) AS scored_pairs,
  count(DISTINCT category) AS categories, count(DISTINCT term) AS merged_terms FROM ranked""",
    ),
}
