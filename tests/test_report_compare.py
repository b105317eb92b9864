import random

import brute
import pytest
from pyspark.sql import functions as F

from termscope.operators import compare, report
from termscope.operators.counts import read_counts, tally
from termscope.operators.scores import contingency, score_pairs, top_terms
from termscope.plans.feature_selection import select_terms_by_presence
from termscope.sources.report import write_report
from termscope.plans.term_report import report_from_counts, term_report

K = 7


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    letters = "abcdefghij"
    return [
        (f"Cat{rnd.randrange(5)}", " ".join(rnd.choice(letters) * 2 + rnd.choice(letters) for _ in range(8)))
        for _ in range(200)
    ]


@pytest.fixture
def ranked(reviews, rows):
    return top_terms(score_pairs(contingency(tally(reviews(rows)))), K)


def test_report_of_a_small_corpus(reviews, tmp_path):
    """Worked by hand: red and blue tell the categories apart, pear does not."""
    docs = reviews([("B b", "blue pear"), ("A", "red apple"), ("B b", "plum blue"), ("A", "pear red")])
    ranked = top_terms(score_pairs(contingency(tally(docs))), 2)
    write_report(report.category_lines(ranked), ranked, str(tmp_path / "r"))
    assert _text(tmp_path / "r") == (
        "A red:4.0000 apple:1.3333\nB b blue:4.0000 plum:1.3333\napple blue plum red\n"
    )


def _text(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*")))


def test_a_report_line_is_written_by_many_tasks(spark, tmp_path):
    """Terms of many parts, repeated ones too, are one line; no terms are an empty one."""
    words = [f"t{i % 3000:05d}" for i in range(6000)]
    terms = spark.createDataFrame([(w,) for w in words], "term string")
    lines = spark.createDataFrame([("b x:1",), ("c y:2",)], "line string")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_report(lines, terms, str(tmp_path / "r"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert _text(tmp_path / "r") == "b x:1\nc y:2\n" + " ".join(sorted(set(words))) + "\n"
    assert len(list((tmp_path / "r").glob("part-*"))) > 4
    assert [p.name for p in tmp_path.iterdir()] == ["r"]
    write_report(lines.limit(0), terms.limit(0), str(tmp_path / "r"))
    assert _text(tmp_path / "r") == "\n"


def test_report_content_equals_the_definition(ranked, rows):
    got = {r.category: r.line for r in report.category_lines(ranked).collect()}
    for category, pairs in brute.top(rows, K).items():
        terms = [cell.rsplit(":", 1)[0] for cell in got[category].split()[1:]]
        assert terms == [t for t, _ in pairs]
        values = [float(cell.rsplit(":", 1)[1]) for cell in got[category].split()[1:]]
        assert values == pytest.approx([s for _, s in pairs], abs=6e-5)


def test_lines_parse_back(spark, ranked):
    parsed = report.parse_ranked_lines(report.category_lines(ranked))
    expected = ranked.select("category", "rk", "term", F.round("chi2", 4).alias("chi2"))
    key = ["category", "rk", "term", "chi2"]
    assert sorted(parsed.select(key).collect()) == sorted(expected.select(key).collect())


def test_parse_keeps_colons_in_terms_and_empty_lines(spark):
    rows = ["Cat a:b:1.5 c:0.25", "Lonely", "Home Kitchen d:2", "To: do 5:x e:0.5", "f:1"]
    lines = spark.createDataFrame([(r,) for r in rows], "line string")
    got = [tuple(r) for r in report.parse_ranked_lines(lines).orderBy("category", "rk").collect()]
    assert got == [
        ("Cat", 1, "a:b", 1.5),
        ("Cat", 2, "c", 0.25),
        ("Home Kitchen", 1, "d", 2.0),
        ("To: do 5:x", 1, "e", 0.5),
    ]


def test_whole_run_writes_everything(spark, reviews, rows, tmp_path):
    out = str(tmp_path / "run")
    ranked = term_report(reviews(rows), out, k=K)
    lines = [p.read_text() for p in sorted((tmp_path / "run/report").glob("part-*"))]
    text = "".join(lines).splitlines()
    assert len(text) == 5 + 1
    assert text[-1].split() == [r.term for r in report.merged_dictionary(ranked).collect()]
    dictionary = "".join(p.read_text() for p in sorted((tmp_path / "run/dictionary").glob("part-*")))
    assert dictionary.split() == text[-1].split()
    again = report_from_counts(read_counts(spark, f"{out}/counts"), str(tmp_path / "again"), K)
    assert sorted(again.collect()) == sorted(ranked.collect())


def test_selection_by_presence_is_written_in_order(reviews, rows, tmp_path):
    terms = select_terms_by_presence(reviews(rows), str(tmp_path / "t"), num_features=10)
    text = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*"))).split()
    best = sorted(brute.global_scores(rows).items(), key=lambda x: (-round(x[1], 6), x[0]))[:10]
    assert text == [t for t, _ in best] and terms.count() == 10


def _scores(spark, rows):
    return spark.createDataFrame(rows, "category string, term string, chi2 double")


def test_compare_scores(spark):
    left = _scores(spark, [("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0)])
    right = _scores(spark, [("a", "x", 1.0), ("a", "y", 2.5), ("c", "x", 3.0)])
    row = compare.compare_scores(left, right).first()
    assert (row.only_left, row.only_right, row.differing, row.equal) == (1, 1, 1, 1)


def test_term_sets(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",)], "term string")
    right = spark.createDataFrame([("b",), ("c",), ("d",)], "term string")
    row = compare.term_set_overlap(left, right).first()
    assert (row.left_terms, row.right_terms, row.shared) == (2, 3, 1)
    assert [r.term for r in compare.term_set_difference(left, right).collect()] == ["a"]


def test_order_differences(spark):
    schema = "category string, term string, rk int"
    left = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 1), ("c", "z", 1)], schema)
    right = spark.createDataFrame([("a", "y", 1), ("a", "x", 2), ("b", "x", 1), ("c", "w", 1)], schema)
    got = {r.category: (r.shared, r.moved, r.order_only) for r in compare.order_differences(left, right).collect()}
    assert got == {"a": (2, 2, 1), "b": (1, 0, 0), "c": (0, 0, 0)}
