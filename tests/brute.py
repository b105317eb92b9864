"""Plain-Python definitions the Spark results are checked against."""

from collections import Counter
from fractions import Fraction

SIGNS = set("()[]{}.!?,;:+=-_\"'`~#@&*%€$§\\/")


def is_delimiter(sign):
    return sign in SIGNS or sign.isspace() or sign.isdecimal()


def words(text):
    """Letter by letter: a delimiter ends the word before it."""
    found, word = [], ""
    for sign in text + " ":
        if not is_delimiter(sign):
            word += sign
        elif word:
            found.append(word.lower())
            word = ""
    return found


def terms(text, stop=()):
    """Distinct words in the order of their first use, short and stop words aside."""
    kept = {}
    for word in words(text):
        if len(word) > 1:
            kept.setdefault(word, word in stop)
    return {word for word, stopped in kept.items() if not stopped}


def chi_square(n, nc, nt, ntc):
    table = [[ntc, nc - ntc], [nt - ntc, n - nc - nt + ntc]]
    return float(statistic(table))


def statistic(table):
    """Pearson's statistic of any table, exactly; 0 when a margin is empty."""
    rows = [sum(r) for r in table]
    cols = [sum(c) for c in zip(*table)]
    n = sum(rows)
    if 0 in rows or 0 in cols:
        return Fraction(0)
    return sum(
        (Fraction(table[i][j]) - Fraction(rows[i] * cols[j], n)) ** 2 / Fraction(rows[i] * cols[j], n)
        for i in range(len(rows))
        for j in range(len(cols))
    )


def counts(docs, stop=()):
    docs = [(c, terms(t, stop)) for c, t in docs if c and t]
    return (
        len(docs),
        Counter(c for c, _ in docs),
        Counter(t for _, ts in docs for t in ts),
        Counter((c, t) for c, ts in docs for t in ts),
    )


def scores(docs, stop=()):
    n, nc, nt, ntc = counts(docs, stop)
    return {(c, t): chi_square(n, nc[c], nt[t], k) for (c, t), k in ntc.items()}


def top(docs, k, stop=()):
    by_category = {}
    for (c, t), s in scores(docs, stop).items():
        by_category.setdefault(c, []).append((-s, t))
    return {c: [(t, -s) for s, t in sorted(v)[:k]] for c, v in by_category.items()}


def global_scores(docs, stop=()):
    n, nc, nt, ntc = counts(docs, stop)
    return {
        t: float(
            statistic([[ntc[c, t] for c in nc], [nc[c] - ntc[c, t] for c in nc]])
        )
        for t in nt
    }
