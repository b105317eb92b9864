import math
import random
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from termscope.operators import evaluation as ev
from termscope.operators import vectors as v

STOP = {"the"}


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    texts = [" ".join(f"t{chr(97 + min(rnd.randrange(20), rnd.randrange(20)))}" for _ in range(rnd.randrange(30))) for _ in range(60)]
    return [("c", t or "1") for t in texts] + [("c", "the the solo"), ("c", "the 7")]


def _tf(rows):
    return [Counter(w for w in brute.words(t) if len(w) >= 2 and w not in STOP) for _, t in rows]


def test_term_frequency(reviews, rows):
    got = {(r.doc_id, r.term): r.tf for r in v.term_frequency(reviews(rows), STOP).collect()}
    assert got == {(i, t): n for i, tf in enumerate(_tf(rows)) for t, n in tf.items()}


def test_term_frequency_shuffles_nothing(reviews, rows):
    plan = v.term_frequency(reviews(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_vocabulary(reviews, rows):
    freq = sum(_tf(rows), Counter())
    expected = sorted(freq, key=lambda t: (-freq[t], t))
    got = v.vocabulary(reviews(rows), STOP).orderBy("idx").collect()
    assert [r.term for r in got] == expected and [r.idx for r in got] == list(range(len(expected)))
    first = v.vocabulary(reviews(rows), STOP, size=3).orderBy("idx").collect()
    assert [r.term for r in first] == expected[:3]


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("max_terms", [1000, 0])
def test_tfidf_and_unit_length(no_auto_broadcast, reviews, rows, max_terms):
    tfs = _tf(rows)
    df = Counter(t for tf in tfs for t in tf)
    m = len(rows)
    expected = {
        (i, t): n * math.log((m + 1) / (df[t] + 1)) for i, tf in enumerate(tfs) for t, n in tf.items()
    }
    weights = v.tfidf(reviews(rows), STOP, max_terms=max_terms)
    shuffled = "SortMergeJoin" in weights._jdf.queryExecution().executedPlan().toString()
    assert shuffled == (max_terms == 0)
    assert {(r.doc_id, r.term): r.weight for r in weights.collect()} == pytest.approx(expected)
    squares = defaultdict(float)
    for (i, _), w in expected.items():
        squares[i] += w * w
    unit = {(r.doc_id, r.term): r.weight for r in v.l2_normalize(weights).collect()}
    assert unit == pytest.approx({k: w / math.sqrt(squares[k[0]]) for k, w in expected.items()})


def test_idf_golden_and_min_doc_freq(reviews):
    docs = reviews([("c", "once both"), ("c", "both")])
    got = {r.term: r.idf for r in v.idf(docs).collect()}
    assert got == pytest.approx({"once": math.log(3 / 2), "both": 0.0})
    assert {r.term: r.idf for r in v.idf(docs, min_doc_freq=2).collect()} == {"once": 0.0, "both": 0.0}
    assert {r.term: r.df for r in v.document_frequency(docs).collect()} == {"once": 1, "both": 2}


def test_zero_vector_stays_zero(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (1, "b", 0.0)], "doc_id bigint, term string, weight double")
    assert {r.weight for r in v.l2_normalize(df).collect()} == {0.0}


def test_label_index(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "category string")
    got = {r.label: r.idx for r in v.label_index(df).collect()}
    assert got == {"c": 0, "a": 1, "b": 2}


def test_split_is_the_same_under_any_partitioning(spark):
    ids = spark.range(1000).withColumnRenamed("id", "doc_id")
    one = {r.doc_id: r.split for r in ev.assign_split(ids.coalesce(1)).collect()}
    many = {r.doc_id: r.split for r in ev.assign_split(ids.repartition(13)).collect()}
    assert one == many
    assert {r.split: r.docs for r in ev.split_counts(ids).collect()} == {
        "train": 714, "validation": 152, "test": 134,
    }
    union = ev.split_part(ids, "train").unionByName(ev.split_part(ids, "validation"))
    assert sorted(union.collect()) == sorted(ev.train_val_union(ids).collect())


def test_folds_do_not_follow_the_split(spark):
    ids = spark.range(2000).withColumnRenamed("id", "doc_id")
    counted = ev.assign_fold(ev.assign_split(ids)).groupBy("split", "fold").count().collect()
    per_split = defaultdict(dict)
    for r in counted:
        per_split[r.split][r.fold] = r["count"]
    for folds in per_split.values():
        assert set(folds) == {0, 1} and min(folds.values()) > 0.4 * sum(folds.values())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_weighted_f1_equals_spark(spark, seed):
    rnd = random.Random(seed)
    rows = [(float(min(rnd.randrange(5), rnd.randrange(5))), float(rnd.randrange(6))) for _ in range(200)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = ev.weighted_f1(ev.confusion_counts(df)).first().f1
    theirs = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert ours == pytest.approx(theirs, rel=1e-12)


def test_main_effects(spark):
    rows = [(2000, "on", 0.6), (2000, "off", 0.4), (500, "on", 0.5), (500, "off", 0.1)]
    df = spark.createDataFrame(rows, "features int, std string, f1 double")
    got = {(r.factor, r.level): (r.mean, r.delta) for r in ev.main_effects(df, ["features", "std"], "f1").collect()}
    assert got == {
        ("features", "2000"): (0.5, 0.2),
        ("features", "500"): (0.3, 0.0),
        ("std", "on"): (0.55, 0.3),
        ("std", "off"): (0.25, 0.0),
    }


def test_unit_weights_shuffle_only_texts(spark, tmp_path):
    """Over many splits: one exchange by document, below the explode."""
    rows = spark.range(0, 400, 1, 16).selectExpr(
        "id AS doc_id", "'a' AS category", "concat('aa bb', id % 7, ' cc') AS reviewText"
    )
    rows.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    unit = v.unit_tfidf(docs)
    plan = unit._jdf.queryExecution().executedPlan().toString().splitlines()
    exchanges = [line for line in plan if "Exchange hashpartitioning(doc_id" in line]
    assert len(exchanges) == 1
    deeper = plan.index(exchanges[0])
    assert any("Generate inline" in line for line in plan[:deeper])
    length = unit.groupBy("doc_id").agg(F.round(F.sum(F.col("weight") * F.col("weight")), 9).alias("s"))
    assert {r.s for r in length.collect()} <= {0.0, 1.0}


def test_lengths_need_no_sort_and_rows_without_an_id_are_one_document(spark):
    rows = [(1, "a", "river road road"), (1, "b", "hook"), (None, "a", "hook hook fish"), (None, "c", "tree")]
    docs = spark.createDataFrame(rows, "doc_id bigint, category string, reviewText string")
    unit = v.unit_tfidf(docs)
    plan = unit._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort " not in plan and "ShuffledHashJoin" in plan
    squares = {}
    for r in unit.collect():
        squares[r.doc_id] = squares.get(r.doc_id, 0) + r.weight**2
    assert squares == pytest.approx({1: 1.0, None: 1.0})
