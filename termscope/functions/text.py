"""Column expressions that turn review text into terms.

Everything here is a built-in Spark function, so no row leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words are separated by whitespace, digits and these signs, and a
# term has at least two characters.
DELIMITER_SIGNS = "()[]{}.!?,;:+=-_\"'`~#@&*%€$§\\/"
MIN_TERM_LENGTH = 2

_LATIN_WHITESPACE = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0"
_LATIN_DELIMITERS = _LATIN_WHITESPACE + "0123456789" + DELIMITER_SIGNS.replace("€", "")

# Java tests listed characters below U+0100 with one table look-up, while a range
# or a class such as \s costs a call per character. So the common delimiters are
# listed, and the Unicode classes are asked only about characters beyond.
DELIMITER_PATTERN = (
    "(?U)["
    + "".join(f"\\x{{{ord(c):x}}}" for c in _LATIN_DELIMITERS)
    + r"[\x{100}-\x{10FFFF}&&[\s\d€]]]+"
)

BLANK_EDGES_PATTERN = r"^(?U)[\s\x1c-\x1f]+|(?U)[\s\x1c-\x1f]+$"

# A short list of function words of our own, used when no list is given.
DEFAULT_STOPWORDS = (
    "a", "am", "an", "and", "any", "are", "as", "at", "be", "been", "but", "by",
    "can", "did", "do", "does", "for", "from", "had", "has", "have", "he", "her",
    "his", "if", "in", "into", "is", "it", "its", "me", "my", "no", "not", "of",
    "on", "or", "our", "she", "so", "than", "that", "the", "their", "them", "then",
    "there", "they", "this", "to", "us", "was", "we", "were", "what", "which",
    "who", "will", "with", "you", "your",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text: Column | str) -> Column:
    """Lower-cased words of a text, in order, with repeats and without blanks.

    Each word is folded on its own. Folding the text before the split comes to
    the same and saves a pass, except around a capital sigma, whose small form
    depends on its neighbours; there each delimiter run becomes a space first.
    """
    text = _col(text)
    spaced = F.regexp_replace(text, DELIMITER_PATTERN, " ")
    split = F.when(
        F.contains(text, F.lit("Σ")), F.split(F.lower(spaced), " ")
    ).otherwise(F.split(F.lower(text), DELIMITER_PATTERN))
    return F.array_remove(split, "")


def is_term(word: Column | str, stopwords: Iterable[str] = ()) -> Column:
    """Whether a lower-cased word is long enough and no stopword."""
    word = _col(word)
    keep = F.char_length(word) >= MIN_TERM_LENGTH
    stopwords = sorted(set(stopwords))
    if stopwords:
        keep = keep & ~word.isin(stopwords)
    return keep


def keep_terms(tokens: Column | str, stopwords: Iterable[str] = ()) -> Column:
    """The array form of :func:`is_term`; repeats survive."""
    stopwords = tuple(stopwords)
    return F.filter(_col(tokens), lambda word: is_term(word, stopwords))


def normalize_stopword(line: Column | str) -> Column:
    """A stopword line without blank edges, lower-cased; NULL when blank."""
    return F.nullif(
        F.lower(F.regexp_replace(_col(line), BLANK_EDGES_PATTERN, "")), F.lit("")
    )


def term_score(term: Column | str, score: Column | str) -> Column:
    """``term:score`` with four decimals, the cell of a report line."""
    return F.concat(_col(term), F.lit(":"), F.format_string("%.4f", _col(score)))
