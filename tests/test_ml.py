import math
import random
from decimal import Decimal, localcontext

import duckdb
import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import CountVectorizerModel, IDFModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from termscope.functions.stats import log_chi_square_tail, log_chi_square_tail_bounds
from termscope.operators import evaluation, selection, stages, tuning
from termscope.operators import vectors as v
from termscope.operators.certificate import duality_gap
from termscope.operators.counts import tally, tally_of
from termscope.operators.scores import contingency, global_scores
from termscope.operators.scoring import ModelTables, model_tables, predictions
from termscope.operators.selection import best_terms, term_statistics, top_statistics
from termscope.plans.classification import fit_classifier, tune_and_evaluate
from termscope.plans.feature_selection import select_terms

STOP = ("the", "and")


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    own = {"Fish": "salmon trout river hook", "Cars": "engine wheel brake road", "Food": "bread salt oven taste"}
    shared = "good great the and item box".split()
    out = []
    for _ in range(150):
        cat = rnd.choice(list(own))
        out.append((cat, " ".join(rnd.choices(own[cat].split(), k=3) + rnd.choices(shared, k=4)) + " é 12"))
    return out


@pytest.fixture
def docs(reviews, rows):
    return reviews(rows)


def test_tokens_and_filter(reviews):
    df = stages.review_tokenizer().transform(reviews([("c", "The RIVER, river é x 12 and Hook")]))
    for stage in stages.term_filters(STOP):
        df = stage.transform(df)
    row = df.first()
    assert row.tokens == ["the", "river", "river", "é", "x", "and", "hook"]
    assert row.filtered == ["river", "river", "hook"]


def test_idf_stage_equals_the_long_form(docs):
    model = Pipeline(
        stages=[*stages.count_stages(STOP, 1000), stages.inverse_document_frequency()]
    ).fit(docs)
    vocabulary = next(s for s in model.stages if isinstance(s, CountVectorizerModel)).vocabulary
    weights = next(s for s in model.stages if isinstance(s, IDFModel)).idf.toArray()
    expected = {r.term: r.idf for r in v.idf(docs, STOP).collect()}
    assert dict(zip(vocabulary, weights)) == pytest.approx(expected)


def test_normalizer_equals_the_long_form(docs):
    model = Pipeline(
        stages=[
            *stages.count_stages(STOP, 1000),
            stages.inverse_document_frequency(),
            stages.l2_normalizer().setInputCol("tfidf_features"),
        ]
    ).fit(docs)
    vocabulary = next(s for s in model.stages if isinstance(s, CountVectorizerModel)).vocabulary
    rows = stages.vector_entries(model.transform(docs), ["doc_id"], "norm_features").collect()
    got = {(r.doc_id, vocabulary[r.slot]): r.weight for r in rows}
    expected = {
        (r.doc_id, r.term): r.weight for r in v.l2_normalize(v.tfidf(docs, STOP)).collect() if r.weight
    }
    assert got == pytest.approx(expected)


def test_labels_equal_the_index(docs):
    model = stages.label_indexer().fit(docs)
    expected = [r.label for r in v.label_index(docs).orderBy("idx").collect()]
    assert model.labels == expected


@pytest.mark.parametrize("k", [1, 5, 1000])
def test_slices_equal_the_selector(docs, k):
    prefix = Pipeline(stages=[*stages.count_stages(STOP, 1000), stages.inverse_document_frequency()])
    weighted = prefix.fit(docs).transform(docs)
    selector = stages.chi_square_selector(k).fit(weighted)
    sliced = stages.slice_top_features(stages.feature_statistics(weighted), k)
    assert list(sliced.getIndices()) == sorted(selector.selectedFeatures)
    a = sliced.transform(weighted).select("doc_id", vector_to_array("selected_features").alias("x"))
    b = selector.transform(weighted).select("doc_id", vector_to_array("selected_features").alias("x"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_select_terms_writes_the_selection(docs, tmp_path):
    terms = select_terms(docs, str(tmp_path / "t"), STOP, num_features=12)
    text = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*"))).split()
    assert text == [r.term for r in terms.orderBy("rk").collect()]
    assert {"salmon", "engine", "bread"} <= set(text) and len(text) == 12


def test_fixed_vocabulary(docs):
    model = Pipeline(stages=stages.count_stages(STOP, ["salmon", "engine"])).fit(docs)
    sizes = model.transform(docs).select(F.size(vector_to_array("raw_features")).alias("n"))
    assert {r.n for r in sizes.distinct().collect()} == {2}


def test_default_grid_has_24_points():
    grid = tuning.parameter_grid()
    assert len(grid) == len(set(grid)) == 24
    assert grid[0] == tuning.GridPoint(2000, 0.01, True, 50)


def test_classifier_learns_and_skips_unknown_labels(docs, reviews):
    model = fit_classifier(docs, tuning.GridPoint(12, 0.01, True, 5), STOP)
    fresh = reviews([("Fish", "salmon hook"), ("Cars", "brake road"), ("Birds", "wing")])
    predicted = model.transform(fresh).select("category", "label", "prediction").collect()
    assert {r.category: r.label == r.prediction for r in predicted} == {"Fish": True, "Cars": True}


def test_kept_training_set_changes_nothing(docs):
    """Against Spark's own pipeline of the same stages."""
    point = tuning.GridPoint(8, 0.05, True, 4)
    ovr = stages.one_vs_rest(stages.linear_svm(point.regParam, point.maxIter))
    terms = best_terms(docs, point.numTopFeatures, STOP)
    whole = stages.classifier_stages(STOP, ovr, terms).fit(docs)
    ours = fit_classifier(docs, point, STOP)
    assert len(ours.stages) == len(whole.stages)
    for a, b in zip(ours.stages[-1].models, whole.stages[-1].models):
        assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray(), abs=1e-9)


def test_training_set_is_merged_by_size(spark, docs, monkeypatch):
    model = stages.fit_selection(docs, STOP, 4)
    features = model.transform(docs.repartition(6)).select("label", "selected_features")
    assert tuning.training_set(features, 4).rdd.getNumPartitions() == 1
    monkeypatch.setattr(tuning, "ENTRIES_PER_PART", 4 * 40)
    kept = tuning.training_set(features, 4)
    assert kept.rdd.getNumPartitions() == 4 and kept.count() == 150


def test_parts_are_sized_by_the_entries_that_are_there(spark, monkeypatch):
    """500 vectors of 3 entries each, among 2000 features, are 3500 entries with their rows."""
    vectors = [(float(i % 2), Vectors.sparse(2000, [i, i + 1, i + 2], [1.0, 2.0, 3.0])) for i in range(500)]
    rows = spark.createDataFrame(vectors, ["label", "norm_features"])
    monkeypatch.setattr(tuning, "ENTRIES_PER_PART", 2000)
    kept = tuning.training_set(rows, 2000)
    assert kept.rdd.getNumPartitions() == 2 and kept.count() == 500


def test_binary_svm(docs):
    two = docs.where("category <> 'Food'")
    terms = best_terms(two, 8, STOP)
    model = stages.classifier_stages(STOP, stages.linear_svm(0.01, 5), terms).fit(two)
    assert tuning.f1_score(model.transform(two)) == 1.0


def test_tuning_end_to_end(docs, tmp_path):
    grid = tuning.parameter_grid((8, 2), (0.01,), (True,), (3,))
    tuned = tune_and_evaluate(docs, STOP, grid, output=str(tmp_path / "metrics"))
    rows = tuned.metrics.collect()
    assert [r.numTopFeatures for r in rows] == [8, 2]
    assert rows[0].f1 > rows[1].f1
    assert tuned.best == grid[0] and tuned.test_f1 > 0.95
    stored = docs.sparkSession.read.schema(tuning.METRICS_SCHEMA).json(str(tmp_path / "metrics"))
    assert sorted(stored.collect()) == sorted(rows)
    test = docs.sparkSession.read.json(str(tmp_path / "metrics-test")).first()
    assert test.f1 == tuned.test_f1 and test.skipped == 0 and test.documents > 0


def test_fold_scores_equal_full_refits(docs):
    """Shared features give what fitting everything per point would give."""
    from termscope.operators.evaluation import assign_fold

    point = tuning.GridPoint(6, 0.1, True, 3)
    shared = tuning.grid_search(docs, [point], STOP).first().f1
    folded = assign_fold(docs, 2)
    separate = []
    for fold in (0, 1):
        model = fit_classifier(folded.where(F.col("fold") != fold), point, STOP)
        separate.append(tuning.f1_score(model.transform(folded.where(F.col("fold") == fold))))
    assert shared == pytest.approx(sum(separate) / 2, abs=1e-9)


def test_statistics_equal_the_ml_test(docs):
    prefix = Pipeline(stages=[*stages.count_stages(STOP, 1000), stages.inverse_document_frequency()])
    model = prefix.fit(docs)
    vocabulary = next(s for s in model.stages if isinstance(s, CountVectorizerModel)).vocabulary
    rows = stages.feature_statistics(model.transform(docs)).collect()
    expected = {vocabulary[r.featureIndex]: (r.degreesOfFreedom, r.statistic) for r in rows}
    found = {r.term: (r.dof, r.statistic) for r in term_statistics(docs, STOP).collect()}
    assert set(found) == set(expected)
    for term, (dof, statistic) in expected.items():
        assert found[term][0] == dof and found[term][1] == pytest.approx(statistic, abs=1e-6)


def test_selection_has_no_cap_and_breaks_ties_by_term(spark, reviews):
    rows = [("a", " ".join(f"aa{chr(97 + i)}{chr(97 + j)}" for j in range(26))) for i in range(26)]
    corpus = reviews([*rows, ("b", "zz")])
    top = top_statistics(term_statistics(corpus), 10_000).orderBy("rk").collect()
    assert len(top) == 26 * 26 + 1 and top[0].term == "zz"
    tied = [r.term for r in top[1:]]
    assert tied == sorted(tied)


def test_a_stopword_table_gives_what_a_list_gives(spark, docs):
    table = spark.createDataFrame([(w,) for w in STOP], "term string")
    listed, joined = (term_statistics(docs, s).orderBy("term").collect() for s in (STOP, table))
    assert listed == joined
    a, b = (v.idf(docs, s).orderBy("term").collect() for s in (STOP, table))
    assert a == b
    point = tuning.GridPoint(6, 0.1, True, 2)
    scores = [tuning.grid_search(docs, [point], s).first().f1 for s in (STOP, table)]
    assert scores[0] == pytest.approx(scores[1])


def test_command_line_takes_long_stopword_lists(docs, tmp_path):
    from termscope.__main__ import main

    docs.select("category", "reviewText").coalesce(1).write.json(str(tmp_path / "in"))
    outputs = []
    for name, words in (("short", STOP), ("long", [*STOP, *(f"zz{i}" for i in range(20_000))])):
        (tmp_path / name).write_text("\n".join(words))
        args = ["--input", str(tmp_path / "in"), "--stopwords", str(tmp_path / name), "--top", "9"]
        for run in ("select", "select-by-presence"):
            main([run, *args, "--output", str(tmp_path / f"{run}-{name}")])
            parts = sorted((tmp_path / f"{run}-{name}").glob("part-*"))
            outputs.append("".join(p.read_text() for p in parts).split())
    assert outputs[:2] == outputs[2:] and len(outputs[0]) == 9


def _exact_log_tail(statistic, dof):
    """By the finite sum for even degrees and the series of the lower part for odd ones."""
    x, terms = Decimal(statistic) / 2, Decimal(1)
    with localcontext() as context:
        context.prec = 80 + int(x)
        if dof % 2 == 0:
            total = Decimal(1)
            for k in range(1, dof // 2):
                terms = terms * x / k
                total += terms
            return float(total.ln() - x)
        a = Decimal(dof) / 2
        terms = total = 1 / a
        n = 0
        while n < x or terms > total * Decimal(10) ** -(context.prec - 5):
            n += 1
            terms = terms * x / (a + n)
            total += terms
        gamma = Decimal(
            "1.7724538509055160272981674833411451827975494561223871282138077898529112845910321813749506567385446654162268"
        )
        for k in range(dof // 2):
            gamma *= Decimal(k) + Decimal("0.5")
        return float((1 - (a * x.ln() - x).exp() * total / gamma).ln())


def test_log_tails_equal_exact_sums(spark):
    rows = [
        (float(s), d)
        for d in (1, 2, 3, 4, 7, 18, 30, 99, 100, 401)
        for s in (0.001, 0.5, d - 0.5, d + 1.9, d + 2.1, d + 30.0, 2.0 * d + 40)
        if d % 2 == 0 or s < 140
    ]
    df = spark.createDataFrame(rows, "s double, d int")
    for r in df.withColumn("tail", log_chi_square_tail(F.col("s"), F.col("d"))).collect():
        assert r.tail == pytest.approx(_exact_log_tail(r.s, r.d), rel=1e-9, abs=1e-12), r
    odd = spark.createDataFrame(
        [(90_000.0, 18), (90_000.0, 17), (0.0, 3), (5.0, 0), (None, 2)], "s double, d int"
    )
    tails = [r.tail for r in odd.select(log_chi_square_tail(F.col("s"), F.col("d")).alias("tail")).collect()]
    assert tails[0] < -44_000 and tails[1] < tails[0] and tails[2:] == [0.0, 0.0, None]


@pytest.mark.parametrize("k", [3, 8, 12])
def test_selection_equals_the_ml_selector(docs, k):
    """The same terms, and p-values, wherever these are no zeros to the ML stage."""
    prefix = Pipeline(stages=[*stages.count_stages(STOP, 1000), stages.inverse_document_frequency()])
    model = prefix.fit(docs)
    vocabulary = next(s for s in model.stages if isinstance(s, CountVectorizerModel)).vocabulary
    p = {vocabulary[r.featureIndex]: r.pValue for r in stages.feature_statistics(model.transform(docs)).collect()}
    ours = top_statistics(term_statistics(docs, STOP), 1000).orderBy("rk").collect()
    for row in ours:
        if p[row.term] > 1e-9:
            assert math.exp(row.log_p) == pytest.approx(p[row.term], rel=1e-4)
    order = [r.term for r in ours]
    tested = [t for t in order if p[t] > 1e-12]
    assert tested == sorted(tested, key=lambda t: (round(math.log(p[t]), 6), t))
    assert all(p[t] <= 1e-9 for t in order[: len(order) - len(tested)])


def test_degrees_of_freedom_matter(spark, reviews):
    """A term of many counts needs a larger statistic than one that is there or not."""
    statistics = spark.createDataFrame([("many", 18, 53.0), ("once", 3, 50.9)], "term string, dof int, statistic double")
    assert [r.term for r in top_statistics(statistics, 2).orderBy("rk").collect()] == ["once", "many"]


@pytest.fixture
def two(docs):
    """Vectors and labels of two categories."""
    pair = docs.where("category <> 'Food'")
    terms = best_terms(pair, 12, STOP)
    steps = [*stages.selection_stages(STOP, terms).getStages(), stages.l2_normalizer()]
    return Pipeline(stages=steps).fit(pair).transform(pair).select("label", "norm_features").persist()


@pytest.mark.parametrize("scaled", [True, False])
def test_duality_gap_is_that_of_the_definition(two, scaled):
    model = stages.linear_svm(0.1, 200, scaled).fit(two)
    row = duality_gap(two, model).first()
    x = np.array([r.norm_features.toArray() for r in two.collect()])
    y = np.array([2 * r.label - 1 for r in two.collect()])
    w, b = model.coefficients.toArray(), model.intercept
    spread = x.std(axis=0, ddof=1) if scaled else np.ones(x.shape[1])
    primal = np.maximum(0, 1 - y * (x @ w + b)).mean() + 0.05 * ((w * spread) ** 2).sum()
    assert row.documents == len(y) and row.primal == pytest.approx(primal)
    # No plane of a few hundred, near the fitted one or not, is below the bound.
    rnd = np.random.default_rng(1)
    for size in (0, 0.01, 0.1, 1, 5):
        for _ in range(60):
            v, c = w + size * rnd.normal(size=len(w)), b + size * rnd.normal()
            other = np.maximum(0, 1 - y * (x @ v + c)).mean() + 0.05 * ((v * spread) ** 2).sum()
            assert other >= row.dual - 1e-9
    assert 0 <= row.gap < (0.2 if scaled else 0.05)


def test_a_guess_has_a_wide_gap(two):
    """Of a fit, of one step of it, and of a fit to labels that tell nothing."""
    good = stages.linear_svm(0.1, 100, False).fit(two)
    poor = stages.linear_svm(0.1, 1, False).fit(two)
    constant = stages.linear_svm(0.1, 100, False).fit(two.withColumn("label", F.lit(1.0)))
    assert abs(constant.coefficients.toArray()).max() < 1e-9
    gaps = [duality_gap(two, m).first().gap for m in (good, poor, constant)]
    assert gaps[0] < 0.05 and min(gaps[1:]) > 0.2


def test_predictions_from_tables_equal_the_stages(spark, docs, reviews, tmp_path):
    """Row for row, in another session, and by SQL over the stored tables."""
    model = fit_classifier(docs, tuning.GridPoint(12, 0.01, True, 20), STOP)
    model_tables(model).write(str(tmp_path))
    fresh = reviews([
        ("Fish", "salmon hook"), ("Cars", "brake, ROAD brake"), ("Food", "nothing known"),
        ("Birds", "wing"), ("Food", ""), ("Fish", "salmon the oven é bread item"),
    ]).unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000))
    expected = {r.doc_id: (int(r.label), int(r.prediction)) for r in model.transform(fresh).collect()}
    other = spark.newSession()
    tables = ModelTables.read(other, str(tmp_path))
    again = other.createDataFrame(fresh.collect(), fresh.schema)
    found = {r.doc_id: (r.label, r.prediction) for r in predictions(again, tables, STOP).collect()}
    assert found == expected and 3 not in found
    con = duckdb.connect()
    for name in ("labels", "terms", "weights"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    tf = v.term_frequency(fresh.where("doc_id >= 1000"), STOP).toPandas()  # noqa: F841
    rows = con.execute("""
        WITH w AS (SELECT doc_id, term, tf * idf AS x FROM tf JOIN terms USING (term)),
        len AS (SELECT doc_id, sqrt(sum(x * x)) AS len FROM w GROUP BY doc_id),
        margins AS (SELECT w.doc_id, l.label, max(intercept) + sum(x * coalesce(weight, 0)) / max(len) AS m
                    FROM w JOIN len USING (doc_id) CROSS JOIN labels l
                    LEFT JOIN weights ON weights.label = l.label AND weights.term = w.term
                    GROUP BY w.doc_id, l.label)
        SELECT doc_id, arg_min(label, (-m, label)) FROM margins GROUP BY doc_id""").fetchall()
    assert len(rows) == 150 and all(expected[doc][1] == label for doc, label in rows)


def test_majority_f1(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 3 + [(2,)], "label int")
    guess = evaluation.confusion_counts(df.withColumn("prediction", F.lit(0)))
    assert evaluation.majority_f1(df).first().f1 == pytest.approx(evaluation.weighted_f1(guess).first().f1)


def test_a_stopped_search_goes_on_from_its_log(docs, tmp_path, monkeypatch):
    grid = tuning.parameter_grid((8, 2), (0.01,), (True, False), (2, 4))
    whole = sorted(tuning.grid_search(docs, grid, STOP).collect())
    log = str(tmp_path / "log")
    append, fit, fits = tuning.TrialLog.append, tuning.fit_label, []

    def stops(self, fold, point, f1):
        append(self, fold, point, f1)
        if len(self.scores()) == 5:
            raise KeyboardInterrupt

    def counted(train, point, label):
        fits.append((point, label))
        return fit(train, point, label)

    monkeypatch.setattr(tuning, "fit_label", counted)
    monkeypatch.setattr(tuning.TrialLog, "append", stops)
    with pytest.raises(KeyboardInterrupt):
        tuning.grid_search(docs, grid, STOP, parallelism=1, log=log)
    fits.clear()
    monkeypatch.setattr(tuning.TrialLog, "append", append)
    rest = sorted(tuning.grid_search(docs, grid, STOP, log=log).collect())
    assert [r[:4] for r in rest] == [r[:4] for r in whole]
    assert [r.f1 for r in rest] == pytest.approx([r.f1 for r in whole], abs=1e-9)
    assert len(fits) <= 3 * (len(grid) * 2 - 5)
    fits.clear()
    assert sorted(tuning.grid_search(docs, grid, STOP, log=log).collect()) == rest and not fits
    with pytest.raises(ValueError, match="another search"):
        tuning.grid_search(docs, grid, ("the",), log=log)


def test_fits_that_stopped_early_are_shared(two, monkeypatch):
    fits = []
    inner = tuning.fit_label
    monkeypatch.setattr(tuning, "fit_label", lambda *a: fits.append(a[1]) or inner(*a))
    points = [tuning.GridPoint(12, 0.1, False, n) for n in (400, 2, 300)]
    models = tuning.shared_fits(two, points, 1)
    assert [p.maxIter for p in fits] == [2, 300]
    assert models[points[0]] is models[points[2]] and models[points[1]] is not models[points[2]]


def test_no_text_below_a_training_set(docs):
    model = stages.fit_selection(docs, STOP, 4)
    features = stages.l2_normalizer().transform(model.transform(docs)).select("label", "norm_features")
    train = tuning.training_set(features, 4)
    plan = train._jdf.queryExecution().analyzed().toString()
    assert "parquet" in plan and "reviewText" not in plan and "tokens" not in plan


def test_bounds_hold_the_log_tail(spark):
    rows = [
        (float(s), d)
        for d in (1, 2, 3, 4, 7, 18, 99, 100, 401)
        for s in (0.001, 0.5, 0.9 * d, d + 0.1, d + 2.1, d + 30.0, 2.0 * d + 40, 50_000.0)
    ]
    df = spark.createDataFrame([*rows, (5.0, 0), (0.0, 3), (None, 2)], "s double, d int")
    below, above = log_chi_square_tail_bounds(F.col("s"), F.col("d"))
    tail = log_chi_square_tail(F.col("s"), F.col("d"))
    *found, none, zero, unknown = df.select("*", below.alias("a"), tail.alias("tail"), above.alias("b")).collect()
    assert all(r.a - 1e-9 <= r.tail <= r.b + 1e-9 for r in found)
    assert none[2:] == zero[2:] == (0.0, 0.0, 0.0) and unknown[2:] == (None, None, None)


def test_only_terms_that_may_be_best_are_tested_in_full(spark):
    """Those with bounds too far off are left out, ties at the edge are not."""
    rnd = random.Random(5)
    rows = [(f"t{i:04d}", rnd.choice((1, 3, 6, 9, 40)), rnd.expovariate(0.05)) for i in range(3000)]
    rows += [(f"tie{i:02d}", 3, 300.0) for i in range(40)] + [("none", 0, 0.0)]
    statistics = spark.createDataFrame(rows, "term string, dof int, statistic double")
    tail = F.round(log_chi_square_tail(F.col("statistic"), F.col("dof")), 6)
    whole = [r.term for r in statistics.orderBy(tail, "term").select("term").collect()]
    for n in (1, 20, 60, 5000):
        assert [r.term for r in top_statistics(statistics, n).orderBy("rk").collect()] == whole[:n]
    assert selection._candidates(statistics, 60).count() < 300


def test_selected_terms_read_the_texts_of_a_tally_once(docs):
    """One shuffle of the tally, which both of its readers share, and only of some terms."""
    terms = docs.sparkSession.createDataFrame([("salmon",), ("great",)], "term string")
    whole = global_scores(contingency(tally(docs, STOP))).where(F.col("term").isin("salmon", "great"))
    scored = global_scores(contingency(tally_of(tally(docs, STOP), terms)))
    assert sorted(scored.collect()) == sorted(whole.collect())
    assert tally_of(tally(docs, STOP), terms).where("tally < 0").count() == 3


def test_texts_are_tokenized_once_for_counts_and_weights(docs):
    """What Spark's own pipeline gives, from stored counts; repeated and null ids are rows."""
    terms = best_terms(docs, 8, STOP)
    odd = docs.unionByName(docs.where("doc_id < 3")).unionByName(
        docs.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("bigint"))
    )
    whole = stages.selection_stages(STOP, terms).fit(odd)
    model, features = stages.weighted_documents(odd, STOP, terms)
    plan = features._jdf.queryExecution().analyzed().toString()
    assert "reviewText" not in plan and "tokens" not in plan
    a, b = (
        sorted(
            stages.vector_entries(df, ["doc_id", "label"], "selected_features").collect(),
            key=lambda r: (r.doc_id is None, r),
        )
        for df in (whole.transform(odd), features)
    )
    assert a == b and [s.uid[:4] for s in model.stages] == [s.uid[:4] for s in whole.stages]


def test_entries_of_vectors(spark):
    rows = [
        (1, Vectors.sparse(2000, [3, 1999], [1.5, 0.0])),
        (2, Vectors.dense([0.0, 2.0])),
        (3, Vectors.dense([])),
        (4, Vectors.sparse(5, [], [])),
        (5, None),
    ]
    df = spark.createDataFrame(rows, ["id", "v"])
    entries = stages.vector_entries(df, ["id"], "v")
    assert sorted(map(tuple, entries.collect())) == [(1, 3, 1.5), (2, 1, 2.0)]
    assert "vector_to_array" not in entries._jdf.queryExecution().analyzed().toString()
