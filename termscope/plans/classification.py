"""Category prediction: tune on train and validation, score on test."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.operators.evaluation import (
    FOLDS,
    SEED,
    confusion_counts,
    split_part,
    train_val_union,
    weighted_f1,
)
from termscope.operators.stages import fit_selection, l2_normalizer, linear_svm, one_vs_rest
from termscope.operators.terms import StopWords
from termscope.operators.tuning import (
    GridPoint,
    best_point,
    grid_search,
    parameter_grid,
    training_set,
)
from termscope.sources.report import write_json
from termscope.sources.storage import scratch


@dataclass(frozen=True)
class TunedClassifier:
    metrics: DataFrame
    best: GridPoint
    model: PipelineModel
    test_f1: float


def fit_classifier(
    docs: DataFrame,
    point: GridPoint,
    stopwords: StopWords = (),
    parallelism: int = 2,
) -> PipelineModel:
    """Fit all stages with one configuration."""
    svm = linear_svm(point.regParam, point.maxIter, point.standardization)
    classifier = one_vs_rest(svm, parallelism)
    return fit_stages(docs, classifier, point.numTopFeatures, stopwords)


def fit_stages(
    docs: DataFrame,
    classifier: Estimator,
    num_features: int,
    stopwords: StopWords = (),
) -> PipelineModel:
    """What ``classifier_stages(...).fit`` gives, with a kept training set."""
    selection = fit_selection(docs, stopwords, num_features)
    normalizer = l2_normalizer()
    features = normalizer.transform(selection.transform(docs)).select("label", "norm_features")
    with scratch():
        train = training_set(features, num_features)
        model = classifier.fit(train)
        train.unpersist()
    return PipelineModel(stages=[*selection.stages, normalizer, model])


def tune_and_evaluate(
    docs: DataFrame,
    stopwords: StopWords = (),
    grid: Sequence[GridPoint] | None = None,
    folds: int = FOLDS,
    seed: int = SEED,
    parallelism: int | None = None,
    output: str | None = None,
) -> TunedClassifier:
    """Search the grid on 85 % of the documents, refit the best configuration on
    them and score it on the other 15 %. ``docs`` has ``doc_id``. With ``output``, the
    grid's metrics go there, the test score beside it, to ``output``-test, and every
    finished trial to ``output``-trials, from which a stopped run goes on."""
    known = train_val_union(docs, seed=seed)
    log = None if output is None else f"{output}-trials"
    metrics = grid_search(known, grid or parameter_grid(), stopwords, folds, seed, parallelism, log)
    if output is not None:
        write_json(metrics, output)
    best = best_point(metrics)
    model = fit_classifier(known, best, stopwords, parallelism or 2)
    score = test_score(model, split_part(docs, "test", seed=seed))
    row = score.first()
    if output is not None:
        write_json(score, f"{output}-test")
    return TunedClassifier(metrics, best, model, row.f1)


def test_score(model: PipelineModel, held_out: DataFrame) -> DataFrame:
    """One row ``(documents, skipped, f1)``.

    Documents whose label the training part did not have cannot be scored; they are
    counted as ``skipped``.
    """
    predicted = model.transform(held_out)
    documents = held_out.agg(F.count(F.lit(1)).alias("n")).scalar()
    scored = predicted.agg(F.count(F.lit(1)).alias("n")).scalar()
    return weighted_f1(confusion_counts(predicted)).select(
        documents.alias("documents"), (documents - scored).alias("skipped"), "f1"
    )


test_score.__test__ = False
