"""Ranked terms as report lines, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.functions.text import term_score


def category_lines(ranked: DataFrame) -> DataFrame:
    """One line per category, ``category term:score term:score ...``, sorted.

    A group holds at most the k ranked terms of its category.
    """
    cell = F.struct("rk", term_score("term", "chi2").alias("cell"))
    cells = F.sort_array(F.collect_list(cell))
    grouped = ranked.groupBy("category").agg(cells.alias("_cells"))
    line = F.concat_ws(" ", F.col("category"), F.array_join(F.col("_cells.cell"), " "))
    return grouped.select("category", line.alias("line")).orderBy("category")


def merged_dictionary(ranked: DataFrame) -> DataFrame:
    """The distinct terms of all categories, sorted."""
    return ranked.select("term").distinct().orderBy("term")


# A cell: a term, which has no blank, and a number.
_CELL = r" \S*:-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?"
_RANKED_LINE = rf"^(\S*(?: \S+)*?)((?:{_CELL})*)$"


def parse_ranked_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Category lines back to rows ``(category, rk, term, chi2)``.

    The cells are the longest tail of ``term:number`` words; all before them is the
    category, which may hold blanks and colons. A line without cells gives no rows.
    """
    split = lines.select(
        F.regexp_extract(line, _RANKED_LINE, 1).alias("category"),
        F.split(F.ltrim(F.regexp_extract(line, _RANKED_LINE, 2)), " ").alias("cells"),
    )
    exploded = split.select("category", F.posexplode("cells").alias("pos", "cell"))
    pattern = r"^(.*):([^:]*)$"
    return exploded.where("cell <> ''").select(
        "category",
        (F.col("pos") + 1).alias("rk"),
        F.regexp_extract("cell", pattern, 1).alias("term"),
        F.regexp_extract("cell", pattern, 2).try_cast("double").alias("chi2"),
    )
