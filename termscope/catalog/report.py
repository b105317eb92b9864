"""Report lines and the merged dictionary."""

from pyspark.sql import functions as F

from termscope.catalog.base import sql_corpus, sql_counts, sql_ranked, sql_scored, sql_with
from termscope.catalog.scores import ranked
from termscope.operators import report as ops


def category_lines(spark, sf_dir):
    return ops.category_lines(ranked(spark, sf_dir))


def parse_ranked(spark, sf_dir):
    """Category names with blanks and a colon."""
    named = ranked(spark, sf_dir, "source").withColumn(
        "category", F.concat("category", F.lit(" and: so on"))
    )
    parsed = ops.parse_ranked_lines(ops.category_lines(named))
    return parsed.withColumn("chi2", F.round("chi2", 6))


def merged_dictionary(spark, sf_dir):
    return ops.merged_dictionary(ranked(spark, sf_dir))


QUERIES = {
    "category_lines": category_lines,
    "parse_ranked": parse_ranked,
    "merged_dictionary": merged_dictionary,
}

_RANKED = (*sql_corpus(), sql_counts(), sql_scored(), sql_ranked())

ORACLES = {
    "category_lines": sql_with(
        *_RANKED,
        select="""SELECT category, category || ' ' ||
  string_agg(term || ':' || printf('%.4f', chi2), ' ' ORDER BY rk) AS line
FROM ranked GROUP BY category ORDER BY category""",
    ),
    "parse_ranked": sql_with(
        *sql_corpus("source"),
        sql_counts(),
        sql_scored(),
        sql_ranked(),
        select="SELECT category || ' and: so on' AS category, rk, term, round(CAST(printf('%.4f', chi2) AS DOUBLE), 6) AS chi2 FROM ranked",
    ),
    "merged_dictionary": sql_with(
        *_RANKED, select="SELECT DISTINCT term FROM ranked ORDER BY term"
    ),
}
