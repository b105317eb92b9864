"""Globally selected terms: documents in, term list out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from termscope.operators.counts import tally
from termscope.operators.scores import contingency, top_terms_global
from termscope.operators.selection import term_statistics, top_statistics
from termscope.operators.stages import NUM_TOP_FEATURES
from termscope.operators.terms import StopWords
from termscope.sources.report import write_terms


def select_terms(
    docs: DataFrame,
    output: str,
    stopwords: StopWords = (),
    num_features: int = NUM_TOP_FEATURES,
) -> DataFrame:
    """Select terms by their counts per document and write them, the best one first.

    Every term of the corpus takes part, however many there are.
    """
    terms = top_statistics(term_statistics(docs, stopwords), num_features)
    write_terms(terms.orderBy("rk").select("term"), output)
    return terms


def select_terms_by_presence(
    docs: DataFrame,
    output: str,
    stopwords: StopWords = (),
    num_features: int = NUM_TOP_FEATURES,
) -> DataFrame:
    """Select by the chi-square of document presence over all categories.

    A plain aggregation: no vocabulary cap, no limit on distinct weights, and
    ranked by the statistic, which does not underflow as p-values do.
    """
    terms = top_terms_global(contingency(tally(docs, stopwords)), num_features)
    write_terms(terms.select("term"), output)
    return terms
