"""Named queries over the test tables, each with its SQL twin where SQL can say it."""

from termscope.catalog import compare, counts, ml, report, scores, sources, text, tuning, vectors

_PARTS = (text, counts, scores, report, compare, sources, vectors, tuning, ml)


def all_queries():
    return {name: run for part in _PARTS for name, run in part.QUERIES.items()}


def all_oracles():
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
