"""The document tables the queries read, and the SQL text they share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscope.functions.text import DEFAULT_STOPWORDS
from termscope.sources.reviews import required_fields
from termscope.sources.storage import spread

STOP = DEFAULT_STOPWORDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str, category: str = "lang") -> DataFrame:
    """``documents`` as reviews, not yet checked for required fields."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col(category).alias("category"), F.col("text").alias("reviewText")
    )


def docs(spark: SparkSession, sf_dir: str, category: str = "lang") -> DataFrame:
    """Valid documents ``(doc_id, category, reviewText)``."""
    df = spread(reviews(spark, sf_dir, category), "doc_id")
    return required_fields(df, keep=("doc_id",))


def text_lines(documents: DataFrame) -> DataFrame:
    """Each line of each text as a document of its own."""
    lines = documents.select(
        "doc_id", "category", F.posexplode(F.split("reviewText", "\n")).alias("pos", "reviewText")
    )
    return required_fields(lines, keep=("doc_id", "pos"))


# The delimiter class in RE2 syntax, whose \s and \d are ASCII only.
SQL_DELIMITERS = (
    r"[\s\x0b\p{Z}\p{Nd}\x{85}\x1c-\x1f()\[\]{}.!?,;:+=\-_\"''`~#@&*%€$§\\/]+"
)
SQL_STOP = ", ".join(f"'{w}'" for w in STOP)


def sql_docs(category: str = "lang", p: str = "") -> str:
    return (
        f"{p}docs AS (SELECT doc_id, {category} AS category, text AS reviewText "
        f"FROM documents WHERE {category} <> '' AND text <> '')"
    )


def sql_lines(category: str = "lang", p: str = "") -> str:
    return f"""{p}docs AS (
  SELECT doc_id * 1000000 + pos AS doc_id, category, reviewText FROM (
    SELECT doc_id, {category} AS category,
           unnest(string_split(text, chr(10))) AS reviewText,
           generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents WHERE {category} <> '' AND text <> '')
  WHERE reviewText <> '')"""


def sql_words(p: str = "") -> str:
    return f"""{p}words AS (
  SELECT doc_id, category, lower(w) AS term FROM (
    SELECT doc_id, category,
           unnest(regexp_split_to_array(reviewText, '{SQL_DELIMITERS}')) AS w
    FROM {p}docs) WHERE w <> '')"""


def sql_terms(p: str = "", stop: bool = True) -> str:
    """Kept terms with repeats (``kept``) and once per document (``terms``)."""
    no_stop = f" AND term NOT IN ({SQL_STOP})" if stop else ""
    return f"""{p}kept AS (SELECT * FROM {p}words WHERE length(term) >= 2{no_stop}),
{p}terms AS (SELECT DISTINCT doc_id, category, term FROM {p}kept)"""


def sql_counts(p: str = "") -> str:
    return f"""{p}n AS (SELECT count(*) AS n FROM {p}docs),
{p}nc AS (SELECT category, count(*) AS nc FROM {p}docs GROUP BY category),
{p}nt AS (SELECT term, count(*) AS nt FROM {p}terms GROUP BY term),
{p}ntc AS (SELECT category, term, count(*) AS ntc FROM {p}terms GROUP BY category, term)"""


def sql_scored(p: str = "") -> str:
    return f"""{p}pairs AS (
  SELECT category, term, n, nc, nt, ntc, CAST(n * ntc - nc * nt AS DOUBLE) AS d
  FROM {p}ntc JOIN {p}nt USING (term) JOIN {p}nc USING (category) CROSS JOIN {p}n),
{p}scored AS (
  SELECT category, term,
         CASE WHEN n = nt OR n = nc THEN 0.0
              ELSE CAST(n AS DOUBLE) * d * d
                   / (CAST(nt AS DOUBLE) * (n - nt) * nc * (n - nc)) END AS chi2
  FROM {p}pairs)"""


def sql_ranked(p: str = "", k: int = 75, ties: str = "term") -> str:
    return f"""{p}ranked AS (
  SELECT category, CAST(rk AS INT) AS rk, term, chi2 FROM (
    SELECT *, row_number() OVER (PARTITION BY category ORDER BY chi2 DESC, {ties}) AS rk
    FROM {p}scored) WHERE rk <= {k})"""


def sql_global(p: str = "", top: int = 2000) -> str:
    """Presence x all categories, cell by cell, zero cells included."""
    return f"""{p}cells AS (
  SELECT term, n, nc, nt, CAST(n * coalesce(ntc, 0) - nc * nt AS DOUBLE) AS d
  FROM {p}nt CROSS JOIN {p}nc CROSS JOIN {p}n LEFT JOIN {p}ntc USING (category, term)),
{p}globals AS (
  SELECT term, nt, round(sum(CASE WHEN n = nt THEN 0.0
         ELSE d * d / (CAST(nc AS DOUBLE) * nt * (n - nt)) END), 6) AS chi2
  FROM {p}cells GROUP BY term, nt),
{p}top AS (SELECT term, nt, chi2 FROM {p}globals ORDER BY chi2 DESC, term LIMIT {top})"""


def sql_with(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def sql_corpus(category: str = "lang", p: str = "", stop: bool = True) -> tuple[str, ...]:
    return (sql_docs(category, p), sql_words(p), sql_terms(p, stop))
