import json
import math
import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from termscope.functions.stats import chi_square
from termscope.operators import counts as c
from termscope.operators import scores as s
from termscope.sources.reviews import required_fields
from termscope.operators.numbering import best_per_group, global_rank, top_k_per_group

STOP = ("the", "and")


def corpus(seed, docs=120, categories=4, vocabulary=40, hot=0.4):
    """Random texts in which one category and one word hold a large share."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(docs):
        cat = "c0" if rnd.random() < hot else f"c{rnd.randrange(categories)}"
        size = rnd.randrange(0, 15)
        text = " ".join(f"w{chr(97 + rnd.randrange(vocabulary) % 26)}x" for _ in range(size))
        if rnd.random() < hot:
            text += " hot The, the AND"
        rows.append((cat, text or "42 !"))
    return rows


CORPORA = [corpus(1), corpus(2, categories=1), corpus(3, docs=1), [("a", "x y 1"), ("b", "the")]]


@pytest.mark.parametrize("rows", CORPORA)
def test_counts_equal_the_definition(reviews, rows):
    n, nc, nt, ntc = brute.counts(rows, STOP)
    t = c.tally(reviews(rows), STOP)
    assert c.total_documents(t).first().n == n
    assert {r.category: r.nc for r in c.category_rows(t).collect()} == nc
    assert {r.term: r.nt for r in c.term_rows(t).collect()} == nt
    assert {(r.category, r.term): r.ntc for r in c.category_term_rows(t).collect()} == ntc


def test_documents_without_terms_count(reviews):
    t = c.tally(reviews([("a", "the 123 x"), ("b", "word")]), STOP)
    assert c.total_documents(t).first().n == 2
    assert {r.category: r.nc for r in c.category_rows(t).collect()} == {"a": 1, "b": 1}


def test_tagged_counts_stored_and_read_back(spark, reviews, tmp_path):
    rows = CORPORA[0]
    n, nc, nt, ntc = brute.counts(rows, STOP)
    expected = {("N", None, None): n}
    expected |= {("NC", k, None): v for k, v in nc.items()}
    expected |= {("NT", None, k): v for k, v in nt.items()}
    expected |= {("NTC", *k): v for k, v in ntc.items()}
    path = str(tmp_path / "counts")
    c.write_counts(c.tagged_counts(c.tally(reviews(rows), STOP)), path)
    stored = c.read_counts(spark, path)
    assert {(r.tag, r.category, r.term): r.cnt for r in stored.collect()} == expected
    plan = c.with_tag(stored, "NT")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tag" in plan
    scored = s.score_pairs(s.contingency_from_counts(stored))
    assert {(r.category, r.term): r.chi2 for r in scored.collect()} == pytest.approx(
        brute.scores(rows, STOP), rel=1e-12, abs=1e-12
    )
    meta = c.corpus_meta(stored).collect()
    assert {r.category: r.nc for r in meta} == nc and {r.n for r in meta} == {n}
    assert json.loads(c.corpus_meta_json(stored).first().value) == {"N": n, "Nc": dict(nc)}


def test_category_named_like_a_counter(reviews):
    rows = [("N", "word"), ("NC", "word two"), ("__N__", "two")]
    scored = s.score_pairs(s.contingency(c.tally(reviews(rows))))
    assert {(r.category, r.term): r.chi2 for r in scored.collect()} == pytest.approx(brute.scores(rows))


@pytest.mark.parametrize("rows", CORPORA)
def test_scores_and_top_terms_equal_the_definition(reviews, rows):
    scored = s.score_pairs(s.contingency(c.tally(reviews(rows), STOP)))
    assert {(r.category, r.term): r.chi2 for r in scored.collect()} == pytest.approx(
        brute.scores(rows, STOP), rel=1e-12, abs=1e-12
    )
    got = {}
    for r in s.top_terms(scored, 5).orderBy("category", "rk").collect():
        got.setdefault(r.category, []).append((r.rk, r.term))
    expected = {
        cat: [(i + 1, t) for i, (t, _) in enumerate(v)]
        for cat, v in brute.top(rows, 5, STOP).items()
    }
    assert got == expected


@pytest.mark.parametrize("rows", CORPORA)
def test_global_scores_equal_the_full_table(reviews, rows):
    got = {r.term: r.chi2 for r in s.global_scores(s.contingency(c.tally(reviews(rows), STOP))).collect()}
    assert got == pytest.approx(brute.global_scores(rows, STOP), abs=2e-6)


def test_join_and_window_totals_agree(reviews):
    t = c.tally(reviews(CORPORA[0]), STOP)
    columns = ["category", "term", "ntc", "nt"]
    assert sorted(s.join_term_totals(t).select(columns).collect()) == sorted(
        s.with_term_totals(c.category_term_rows(t)).select(columns).collect()
    )


@pytest.mark.parametrize(
    "n,nc,nt,ntc,expected",
    [
        (100, 50, 20, 15, 6.25),
        (100, 50, 0, 0, 0.0),
        (100, 50, 100, 50, 0.0),
        (100, 100, 20, 20, 0.0),
        (78_812_386, 22_504_600, 40_000_000, 22_000_000, None),
        (135_000_000_000, 45_000_000_000, 60_000_000_000, 44_000_000_000, None),
    ],
)
def test_chi_square_values(spark, n, nc, nt, ntc, expected):
    df = spark.createDataFrame([(n, nc, nt, ntc)], "n bigint, nc bigint, nt bigint, ntc bigint")
    got = df.select(chi_square(*map(F.col, df.columns)).alias("x")).first().x
    expected = brute.chi_square(n, nc, nt, ntc) if expected is None else expected
    assert math.isfinite(got) and got == pytest.approx(expected, rel=1e-12)


def test_ties_at_the_boundary_go_by_term(spark):
    df = spark.createDataFrame([("x", "b", 1.0), ("x", "a", 1.0), ("x", "c", 2.0)],
                               "category string, term string, chi2 double")
    assert [r.term for r in s.top_terms(df, 2).orderBy("rk").collect()] == ["c", "a"]


@pytest.mark.parametrize("k", [3, 5000])
def test_top_k_below_and_above_the_window_limit(spark, k):
    rows = [("hot" if i % 3 else f"g{i % 30}", i * 7919 % 10007) for i in range(9000)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(4)
    got = top_k_per_group(df, ["g"], [F.desc("v")], k)
    expected = set()
    for g in {g for g, _ in rows}:
        best = sorted((v for x, v in rows if x == g), reverse=True)[:k]
        expected |= {(g, v, i + 1) for i, v in enumerate(best)}
    assert {tuple(r) for r in got.collect()} == expected


def _plan(df, final=False):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if final else text


def test_top_k_prunes_before_its_shuffle(reviews):
    """Also where the category table is too large to broadcast."""
    plan = _plan(s.top_terms(s.score_pairs(s.contingency(c.tally(reviews(CORPORA[0]), STOP)))))
    assert "SortMergeJoin" in plan and plan.count("WindowGroupLimit") == 2


def test_scores_without_broadcast(spark, reviews):
    rows = CORPORA[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = s.score_pairs(s.contingency(c.tally(reviews(rows), STOP)))
        got = {(r.category, r.term): r.chi2 for r in scored.collect()}
        assert "BroadcastHashJoin" not in _plan(scored, final=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == pytest.approx(brute.scores(rows, STOP), rel=1e-12, abs=1e-12)


def _tally_filters(df):
    """Filters at and below the tally's aggregation, without expression ids."""
    plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().optimizedPlan().toString())
    lines = [line.lstrip(" :+-") for line in plan.splitlines()]
    scans = [x for x in lines if x.startswith("Filter") and "reviewText" in x and "isnotnull" in x]
    terms = [x for x in lines if x.startswith("Filter") and "char_length(term)" in x]
    return scans, terms


def test_scoring_shares_one_scan(spark, reviews, tmp_path):
    """Readers of the tally put the same filters below it, so one shuffle serves all."""
    path = str(tmp_path / "docs")
    reviews(CORPORA[0]).write.parquet(path)
    docs = required_fields(spark.read.parquet(path), keep=("doc_id",))
    table = s.contingency(c.tally(docs, STOP))
    scored = s.score_pairs(table)
    for result, readers in (
        (s.top_terms(scored), 3),
        (s.top_terms_global(table), 3),
        (c.run_summary(scored, s.top_terms(scored)), 5),
        (s.join_term_totals(c.tally(docs, STOP)), 2),
    ):
        for filters in _tally_filters(result):
            assert len(filters) == readers and len(set(filters)) == 1


def test_scoring_runs_the_tally_once(spark, reviews, tmp_path):
    """Counted in tasks: one scan of five splits, however many readers."""
    path = str(tmp_path / "docs")
    reviews(CORPORA[0]).repartition(5).write.parquet(path)
    group = "tally-once"
    spark.sparkContext.setJobGroup(group, group)
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        docs = spark.read.parquet(path)
        assert docs.rdd.getNumPartitions() == 5
        s.top_terms(s.score_pairs(s.contingency(c.tally(docs, STOP)))).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {i for job in tracker.getJobIdsForGroup(group) for i in tracker.getJobInfo(job).stageIds}
    sizes = [info.numTasks for info in map(tracker.getStageInfo, stages) if info and info.numCompletedTasks]
    assert sizes.count(5) == 1


def test_global_rank_numbers_every_row(spark):
    rows = [(i * 37 % 5, f"t{i * 101 % 997}") for i in range(997)]
    df = spark.createDataFrame(rows, "f int, t string").repartition(7)
    got = global_rank(df, [F.desc("f"), F.asc("t")]).collect()
    expected = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert {r.rk: (r.f, r.t) for r in got} == {i + 1: r for i, r in enumerate(expected)}
    assert len(got) == len(rows)


def test_global_rank_of_nothing(spark):
    assert global_rank(spark.range(0), [F.col("id")]).count() == 0


def test_best_per_group_breaks_ties_by_order(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("b", 3, 1.0)], "g string, k int, v double")
    best = best_per_group(df, ["g"], [F.desc("v"), F.asc("k")])
    assert {tuple(r) for r in best.collect()} == {("a", 1, 5.0), ("b", 3, 1.0)}


def test_known_categories(spark, reviews):
    counts = c.category_term_rows(c.tally(reviews([("a", "word"), ("b", "word")])))
    meta = spark.createDataFrame([("a", 1)], "category string, nc bigint")
    assert [r.category for r in c.known_categories(counts, meta).collect()] == ["a"]


def test_run_summary(reviews):
    scored = s.score_pairs(s.contingency(c.tally(reviews([("a", "one two"), ("b", "two")]))))
    row = c.run_summary(scored, s.top_terms(scored)).first()
    assert (row.scored_pairs, row.categories, row.merged_terms) == (3, 2, 2)
