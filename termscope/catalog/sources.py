"""Scans, shards and samples."""

from pyspark.sql import functions as F

from termscope.catalog.base import reviews, table
from termscope.sources import reviews as src
from termscope.sources.storage import new_path, spread


def _json_lines(spark, sf_dir):
    """Documents as JSON lines next to their id."""
    line = F.to_json(F.struct("category", "reviewText"))
    return spread(reviews(spark, sf_dir), "doc_id").select("doc_id", line.alias("value"))


def _with_bad_lines(spark, sf_dir):
    """Of ten lines one is cut short, one no object, one without text, and two go on
    after their object, behind a bracket that would close an array around them."""
    kind = F.pmod("doc_id", F.lit(10))
    return _json_lines(spark, sf_dir).withColumn(
        "value",
        F.when(kind == 0, F.expr("left(value, char_length(value) - 1)"))
        .when(kind == 1, F.lit("123"))
        .when(kind == 2, F.lit('{"category":"en","reviewText":""}'))
        .when(kind == 3, F.concat("value", F.lit("] junk")))
        .when(kind == 4, F.concat("value", F.lit('],[{"category":"x"}')))
        .otherwise(F.col("value")),
    )


def scan_reviews_json(spark, sf_dir):
    return src.parse_reviews(_json_lines(spark, sf_dir), keep=("doc_id",))


def drop_malformed(spark, sf_dir):
    return src.parse_reviews(_with_bad_lines(spark, sf_dir), keep=("doc_id",))


def required_fields(spark, sf_dir):
    """Texts of two sources lost before the filter: one NULL, one empty."""
    lossy = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("lang").alias("category"),
        F.when(F.col("source") == "src3", F.lit(None))
        .when(F.col("source") == "src7", F.lit(""))
        .otherwise(F.col("text"))
        .alias("reviewText"),
    )
    return src.required_fields(lossy, keep=("doc_id",))


def load_quality(spark, sf_dir):
    return src.load_quality(_with_bad_lines(spark, sf_dir))


def round_robin_shards(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return src.round_robin_shards(src.number_rows(ids, ["doc_id"]))


def shard_union(spark, sf_dir):
    """Four JSON shards written, then read back as one scan of four paths."""
    sharded = reviews(spark, sf_dir).withColumn("shard", F.pmod("doc_id", F.lit(4)))
    paths = src.write_shards(sharded, new_path(spark, "shards"), ["category", "reviewText"])
    return src.load_documents(spark, paths)


def sample_head(spark, sf_dir):
    return src.sample_head(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), ["doc_id"], 300)


def number_lines(spark, sf_dir):
    """Texts written as lines of several files, numbered in file order."""
    path = new_path(spark, "lines")
    ids = table(spark, sf_dir, "documents").select(F.format_string("%012d", "doc_id").alias("value"))
    ids.repartitionByRange(3, "value").sortWithinPartitions("value").write.text(path)
    return src.number_lines(spark, path).select("line", F.col("value").cast("bigint").alias("doc_id"))


QUERIES = {
    "scan_reviews_json": scan_reviews_json,
    "drop_malformed": drop_malformed,
    "required_fields": required_fields,
    "load_quality": load_quality,
    "round_robin_shards": round_robin_shards,
    "shard_union": shard_union,
    "sample_head": sample_head,
    "number_lines": number_lines,
}

ORACLES = {
    "scan_reviews_json": "SELECT doc_id, lang AS category, text AS reviewText FROM documents",
    "drop_malformed": """SELECT doc_id,
  CASE WHEN doc_id % 10 = 2 THEN 'en' ELSE lang END AS category,
  CASE WHEN doc_id % 10 = 2 THEN '' ELSE text END AS reviewText
FROM documents WHERE doc_id % 10 NOT IN (0, 1, 3, 4)""",
    "required_fields": """SELECT doc_id, lang AS category, text AS reviewText FROM documents
WHERE source NOT IN ('src3', 'src7') AND lang <> '' AND text <> ''""",
    "load_quality": """SELECT count(*) AS lines,
  count(*) FILTER (WHERE doc_id % 10 IN (0, 1, 3, 4)) AS malformed,
  count(*) FILTER (WHERE doc_id % 10 = 2) AS incomplete,
  count(*) FILTER (WHERE doc_id % 10 > 4) AS valid FROM documents""",
    "round_robin_shards": """SELECT doc_id, n_chars,
  CAST((row_number() OVER (ORDER BY doc_id) - 1) % 4 AS INT) AS shard FROM documents""",
    "shard_union": "SELECT lang AS category, text AS reviewText FROM documents",
    "number_lines": "SELECT row_number() OVER (ORDER BY doc_id) AS line, doc_id FROM documents",
    "sample_head": "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 300",
}
