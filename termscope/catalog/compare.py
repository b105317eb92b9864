"""Comparisons of two runs. The second run takes each line of a text as a document."""

from pyspark.sql import functions as F

from termscope.catalog.base import (
    STOP,
    docs,
    sql_corpus,
    sql_counts,
    sql_global,
    sql_lines,
    sql_ranked,
    sql_scored,
    sql_terms,
    sql_with,
    sql_words,
    text_lines,
)
from termscope.catalog.scores import ranked, scored, table
from termscope.operators import compare as ops
from termscope.operators.counts import tally
from termscope.operators.numbering import top_k_per_group
from termscope.operators.scores import contingency, score_pairs, top_terms, top_terms_global


def compare_scores(spark, sf_dir):
    by_line = score_pairs(contingency(tally(text_lines(docs(spark, sf_dir)), STOP)))
    return ops.compare_scores(scored(spark, sf_dir), by_line)


def _dictionary_and_global(spark, sf_dir):
    counts = table(spark, sf_dir)
    return top_terms(score_pairs(counts)).select("term").distinct(), top_terms_global(counts)


def term_set_overlap(spark, sf_dir):
    return ops.term_set_overlap(*_dictionary_and_global(spark, sf_dir))


def term_set_difference(spark, sf_dir):
    dictionary, selected = _dictionary_and_global(spark, sf_dir)
    return ops.term_set_difference(selected, dictionary)


def order_only_diff(spark, sf_dir):
    """Ties broken by ascending against descending term."""
    pairs = scored(spark, sf_dir, "source")
    other = top_k_per_group(pairs, ["category"], [F.desc("chi2"), F.desc("term")], 75)
    return ops.order_differences(ranked(spark, sf_dir, "source"), other)


QUERIES = {
    "compare_scores": compare_scores,
    "term_set_overlap": term_set_overlap,
    "term_set_difference": term_set_difference,
    "order_only_diff": order_only_diff,
}

_BOTH = (*sql_corpus(), sql_counts(), sql_scored(), sql_ranked(), sql_global())

ORACLES = {
    "compare_scores": sql_with(
        *sql_corpus(),
        sql_counts(),
        sql_scored(),
        sql_lines(p="b_"),
        sql_words("b_"),
        sql_terms("b_"),
        sql_counts("b_"),
        sql_scored("b_"),
        select="""SELECT count(*) FILTER (WHERE r.chi2 IS NULL) AS only_left,
  count(*) FILTER (WHERE l.chi2 IS NULL) AS only_right,
  count(*) FILTER (WHERE round(l.chi2, 6) <> round(r.chi2, 6)) AS differing,
  count(*) FILTER (WHERE round(l.chi2, 6) = round(r.chi2, 6)) AS equal
FROM scored l FULL JOIN b_scored r ON l.category = r.category AND l.term = r.term""",
    ),
    "term_set_overlap": sql_with(
        *_BOTH,
        "dict AS (SELECT DISTINCT term FROM ranked)",
        select="""SELECT (SELECT count(*) FROM dict) AS left_terms,
  (SELECT count(*) FROM top) AS right_terms,
  (SELECT count(*) FROM dict JOIN top USING (term)) AS shared""",
    ),
    "term_set_difference": sql_with(
        *_BOTH, select="SELECT term FROM top EXCEPT SELECT term FROM ranked"
    ),
    "order_only_diff": sql_with(
        *sql_corpus("source"),
        sql_counts(),
        sql_scored(),
        sql_ranked(),
        sql_ranked("b_", ties="term DESC").replace("b_scored", "scored"),
        "paired AS (SELECT coalesce(l.category, r.category) AS category, l.rk AS a, r.rk AS b "
        "FROM ranked l FULL JOIN b_ranked r ON l.category = r.category AND l.term = r.term)",
        select="""SELECT category, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS shared,
  count(*) FILTER (WHERE a <> b) AS moved,
  CAST(count(*) = count(a + b) AND count(*) FILTER (WHERE a <> b) > 0 AS INT) AS order_only
FROM paired GROUP BY category""",
    ),
}
