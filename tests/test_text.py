import pandas as pd
from brute import is_delimiter
from brute import words as brute_words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termscope.functions.text import DELIMITER_PATTERN, keep_terms, words
from termscope.operators.terms import document_terms, drop_stopwords, tokens
from termscope.sources.stopwords import inline_stopwords, normalize_stopwords, read_stopwords


def _words(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.w for r in df.select("i", words("t").alias("w")).orderBy("i").collect()]


def test_words_and_filter(spark):
    df = spark.createDataFrame([("Two LAMPS; a lamp (of glass) & 2 shades",)], "t string")
    kept = df.select(keep_terms(words("t"), {"of", "two"}).alias("w")).first().w
    assert kept == ["lamps", "lamp", "glass", "shades"]


def test_unicode_delimiters(spark):
    texts = ["a b٣c\u001cd é", "a\u000bb\u0085c", "", "123 ...", "a§b€c\\d/e"]
    assert _words(spark, texts) == [
        ["a", "b", "c", "d", "é"],
        ["a", "b", "c"],
        [],
        [],
        ["a", "b", "c", "d", "e"],
    ]


def test_every_code_point_splits_as_defined(spark):
    """All but digits younger than the JVM's Unicode tables."""
    points = [p for p in range(1, 0x20000) if not 0xD800 <= p < 0xE000]
    texts = pd.DataFrame({"p": points, "t": [f"x{chr(p)}y" for p in points]})
    df = spark.createDataFrame(texts, "p int, t string")
    split = {r.p for r in df.where(F.size(F.split("t", DELIMITER_PATTERN)) == 2).collect()}
    expected = {p for p in points if is_delimiter(chr(p))}
    assert split <= expected
    missing = expected - split
    assert len(missing) <= 40 and all(p > 0xFFFF and chr(p).isdecimal() for p in missing)


def test_case_is_folded_per_word(spark):
    # A final sigma depends on the word, not on the text around it.
    texts = ["ΟΔΟΣ.ΑΒΓ", "ΟΔΟΣ ΑΒΓ", "ΟΔΟΣΑΒΓ", "İSTANBUL", "Straße GROẞ", "K2 Kelvin"]
    assert _words(spark, texts) == [brute_words(t) for t in texts]


def test_length_is_counted_after_folding_in_code_points(spark):
    df = spark.createDataFrame([("é 𝒳 ab 𝒳𝒳 a",)], "t string")
    assert df.select(keep_terms(words("t")).alias("w")).first().w == ["ab", "𝒳𝒳"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aBÉß .,9' ٩-\tΣ_", max_size=40), min_size=1, max_size=20))
def test_words_equal_the_definition(spark, texts):
    assert _words(spark, texts) == [brute_words(t) for t in texts]


def test_tokens_keep_order_and_repeats(spark, reviews):
    rows = tokens(reviews([("c", "b a, b")]), ["doc_id"]).orderBy("pos").collect()
    assert [(r.pos, r.token) for r in rows] == [(0, "b"), (1, "a"), (2, "b")]


def test_document_terms_are_distinct(spark, reviews):
    df = document_terms(reviews([("c", "cup Saucer cup spoon Cup y")]), ["doc_id"], {"spoon"})
    assert sorted(r.term for r in df.collect()) == ["cup", "saucer"]


def test_stopword_file(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text(" The \n\nthe\n\tAnd \n   \nof", encoding="utf-8")
    words_df = read_stopwords(spark, str(path))
    assert inline_stopwords(words_df) == ("and", "of", "the")
    terms = spark.createDataFrame([("the",), ("cat",), ("cat",)], "term string")
    assert [r.term for r in drop_stopwords(terms, words_df).collect()] == ["cat", "cat"]


def test_long_stopword_list_is_not_inlined(spark, monkeypatch):
    monkeypatch.setattr("termscope.sources.stopwords.MAX_INLINE_WORDS", 3)
    lines = spark.range(5).select(F.concat(F.lit("w"), "id").alias("value"))
    assert inline_stopwords(normalize_stopwords(lines)) is None
