"""Text and JSON sinks on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.sources.storage import move_parts


def write_text(lines: DataFrame, path: str, column: str = "line") -> None:
    """Write one text column; an ordered input keeps its order across parts."""
    lines.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_dictionary(terms: DataFrame, path: str) -> None:
    """Write sorted terms as one blank-separated line without building the line:
    the parts, read in order, are the line."""
    terms.select(F.col("term").alias("value")).write.mode("overwrite").option(
        "lineSep", " "
    ).text(path)


def write_report(lines: DataFrame, terms: DataFrame, path: str) -> None:
    """Write ordered ``lines (line)``, then all of ``terms (term)`` as one line.

    The last line is written by as many tasks as the sorted terms have parts: each writes
    its terms with blanks between, and the parts read in order are the line. So it may be
    of any length. Only its greatest term, which ends the line, goes apart.
    """
    spark = lines.sparkSession
    greatest = terms.agg(F.coalesce(F.max("term"), F.lit("")).alias("value"))
    rest = terms.where(F.col("term") < greatest.scalar()).select("term").distinct().orderBy("term")
    sections = [
        (lines.select(F.col("line").alias("value")), "\n"),
        (rest.select(F.col("term").alias("value")), " "),
        (greatest, "\n"),
    ]
    folders = [f"{path}-section-{i}" for i in range(len(sections))]
    for (rows, end), folder in zip(sections, folders):
        rows.write.mode("overwrite").option("lineSep", end).text(folder)
    move_parts(spark, folders, path)


def write_terms(terms: DataFrame, path: str) -> None:
    """Write selected terms, one per line."""
    write_text(terms, path, "term")


def write_json(rows: DataFrame, path: str) -> None:
    """Write rows as JSON lines."""
    rows.write.mode("overwrite").json(path)
