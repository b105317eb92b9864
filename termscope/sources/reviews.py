"""The review scan: JSON lines in, valid (category, text) documents out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termscope.operators.numbering import global_rank
from termscope.sources.storage import join_by_size, spread

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("reviewerID", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("reviewerName", T.StringType()),
        T.StructField("helpful", T.ArrayType(T.IntegerType())),
        T.StructField("reviewText", T.StringType()),
        T.StructField("overall", T.DoubleType()),
        T.StructField("summary", T.StringType()),
        T.StructField("unixReviewTime", T.LongType()),
        T.StructField("reviewTime", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)
REQUIRED_FIELDS = ("category", "reviewText")

_LINE_KEY = ("_file", "_block", "_seq")
_LINE_END = "_end_of_line"


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Raw lines of one or many text files as ``value``."""
    return spark.read.text([paths] if isinstance(paths, str) else list(paths))


def parse_line(value: Column, fields: Sequence[str] = REQUIRED_FIELDS) -> Column:
    """A line as a struct of the named fields, NULL unless it is one JSON object.

    The line is parsed as the first element of an array whose second is a mark. Text
    after the object, which a plain object parse would ignore, then breaks the array,
    closes it before the mark, or adds an element. Only the named fields are
    converted, so a mistyped field nobody reads does no harm.
    """
    fields_and_mark = [REVIEW_SCHEMA[name] for name in fields] + [
        T.StructField(_LINE_END, T.IntegerType())
    ]
    wrapped = F.concat(F.lit("["), value, F.lit(f',{{"{_LINE_END}":1}}]'))
    options = {"allowSingleQuotes": "false"}
    parsed = F.from_json(wrapped, T.ArrayType(T.StructType(fields_and_mark)), options)
    review = F.get(parsed, F.lit(0))
    whole = (
        (F.size(parsed) == 2)
        & (F.get(parsed, F.lit(1))[_LINE_END] == 1)
        & review.isNotNull()
        & review[_LINE_END].isNull()
    )
    return F.when(whole, F.struct(*(review[name].alias(name) for name in fields)))


def parse_reviews(
    lines: DataFrame,
    value: str = "value",
    fields: Sequence[str] = REQUIRED_FIELDS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parse JSON lines and drop those that are no JSON object."""
    parsed = lines.select(*keep, parse_line(F.col(value), fields).alias("_review"))
    return parsed.where(F.col("_review").isNotNull()).select(
        *keep, *[F.col("_review")[name].alias(name) for name in fields]
    )


def scan_reviews(
    spark: SparkSession,
    paths: str | Sequence[str],
    fields: Sequence[str] = REQUIRED_FIELDS,
) -> DataFrame:
    """Reviews of one or many JSON-lines files, malformed lines dropped."""
    return parse_reviews(spread(read_lines(spark, paths)), fields=fields)


def required_fields(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Valid documents: both fields present and not empty."""
    return df.where("category <> '' AND reviewText <> ''").select(
        *keep, *REQUIRED_FIELDS
    )


def load_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Scan, parse and keep the valid documents: ``(category, reviewText)``."""
    return required_fields(scan_reviews(spark, paths))


def load_quality(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row: lines read, malformed lines, lines without a required field."""
    review = parse_line(F.col(value))
    return lines.select(review.alias("review")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("review").isNull()).alias("malformed"),
        F.count_if(
            F.col("review").isNotNull()
            & (
                (F.coalesce("review.category", F.lit("")) == "")
                | (F.coalesce("review.reviewText", F.lit("")) == "")
            )
        ).alias("incomplete"),
        F.count_if(
            F.col("review.category").isNotNull()
            & (F.col("review.category") != "")
            & F.col("review.reviewText").isNotNull()
            & (F.col("review.reviewText") != "")
        ).alias("valid"),
    )


def read_ordered_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines with a key that sorts them in file order, without numbering them.

    Within one split ids grow with the line, and splits sort by file and offset.
    """
    return read_lines(spark, paths).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
        "value",
    )


def _lines_in_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(_file, line, value)``: lines numbered from 1 within their file; no text is moved.

    A first pass counts the lines of each split. Within a split ids already grow by
    one, so its first line's number is all that has to be joined back.
    """
    lines = read_ordered_lines(spark, paths)
    splits = lines.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first")
    )
    before = (
        Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    starts = splits.select("_file", "_block", (start - F.col("_first") + 1).alias("_shift"))
    placed = join_by_size(lines, starts, ["_file", "_block"], "splits")
    return placed.select("_file", (F.col("_seq") + F.col("_shift")).alias("line"), "value")


def load_keyed_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Valid documents with a unique ``doc_id`` made of file and line number.

    The key is that of the data alone: it does not depend on how many splits a file is
    read in, nor on the cluster, and neither do splits and folds taken from it.
    """
    lines = _lines_in_files(spark, paths)
    keyed = lines.select(F.concat_ws(":", "_file", "line").alias("doc_id"), "value")
    keyed = spread(keyed, "doc_id")
    return required_fields(parse_reviews(keyed, keep=("doc_id",)), keep=("doc_id",))


def sample_head(df: DataFrame, order: Sequence[str] = _LINE_KEY, n: int = 5000) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)


def head_lines(spark: SparkSession, paths: str | Sequence[str], n: int = 5000) -> DataFrame:
    """The first ``n`` lines of the files in order, as ``value``, without reading the rest.

    Files are taken one after the other until there are enough lines. Of a file, splits are
    read in order, one at first and four times as many each time that was too few, and each
    only up to the lines that are missing. So little more than ``n`` lines are read of files
    of any size. At most ``n`` lines reach the driver: ``n`` is the size of a sample.
    """
    found: list[tuple[str]] = []
    for path in sorted([paths] if isinstance(paths, str) else paths):
        if len(found) >= n:
            break
        for file in _files(spark, path):
            found += map(tuple, spark.read.text(file).limit(n - len(found)).collect())
            if len(found) >= n:
                break
    return spark.createDataFrame(found, "value string")


def _files(spark: SparkSession, path: str) -> list[str]:
    """The files that a path, folder or pattern stands for, by name."""
    return sorted(spark.read.text(path).inputFiles())


def number_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of all files numbered from 1 in file order: ``(line, value)``.

    Only per-file totals, one row each, are added up in order.
    """
    lines = _lines_in_files(spark, paths)
    totals = lines.groupBy("_file").agg(F.max("line").alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    shifts = totals.select("_file", shift.alias("_shift"))
    placed = join_by_size(lines, shifts, "_file", "files")
    return placed.select((F.col("line") + F.col("_shift")).alias("line"), "value")


def number_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows of a table numbered from 1 by columns that order it totally."""
    return global_rank(df, [F.col(c) for c in order], "line")


def round_robin_shards(numbered: DataFrame, shards: int = 4) -> DataFrame:
    """Deal numbered rows to shards in turn: row 1 to shard 0, row 2 to shard 1."""
    shard = F.pmod(F.col("line") - 1, F.lit(shards)).cast("int")
    return numbered.withColumn("shard", shard).drop("line")


def write_shards(df: DataFrame, path: str, columns: Sequence[str], shards: int = 4) -> list[str]:
    """Write sharded rows as JSON lines, one folder per shard; return the folders."""
    df.select("shard", *columns).write.partitionBy("shard").json(path)
    return [f"{path}/shard={i}" for i in range(shards)]
