"""Grid search with cross-validation, features computed once per fold, all fits in step."""

from __future__ import annotations

import math
from collections.abc import Callable, Generator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import asdict, dataclass, fields
from functools import partial
from itertools import product

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVCModel, OneVsRestModel
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscope.operators.evaluation import (
    FOLDS,
    SEED,
    assign_fold,
    confusion_counts,
    weighted_f1,
)
from termscope.operators.hinge import HingeRows, in_step
from termscope.operators.selection import best_terms
from termscope.operators.stages import (
    count_stages,
    inverse_document_frequency,
    l2_normalizer,
    linear_svm,
    one_vs_rest,
)
from termscope.operators.terms import StopWords
from termscope.sources.storage import in_scope, scratch, stored

# Most entries in a part of a training set: 25 MB if all are stored. Much less would be
# less work than the start of a task.
ENTRIES_PER_PART = 2_000_000

# What a sparse vector and its label take besides the entries, in entries.
ROW_ENTRIES = 4

# Folds whose vectors are computed at a time: most of their jobs leave cores idle.
FOLDS_AT_A_TIME = 2

# Points scored at a time, beside the fits.
SCORED_AT_A_TIME = 4

METRICS_SCHEMA = (
    "numTopFeatures int, regParam double, standardization boolean, maxIter int, f1 double"
)


# The levels of the grid.
GRID_FEATURES = (2000, 500)
GRID_REG_PARAMS = (0.01, 0.1, 1.0)
GRID_STANDARDIZATION = (True, False)
GRID_MAX_ITERS = (50, 100)


@dataclass(frozen=True)
class GridPoint:
    """One configuration; fields are named as in the metrics table."""

    numTopFeatures: int
    regParam: float
    standardization: bool
    maxIter: int


def parameter_grid(
    num_top_features: Sequence[int] = GRID_FEATURES,
    reg_params: Sequence[float] = GRID_REG_PARAMS,
    standardization: Sequence[bool] = GRID_STANDARDIZATION,
    max_iters: Sequence[int] = GRID_MAX_ITERS,
) -> list[GridPoint]:
    """All combinations, 24 by default, those of one feature count together."""
    return [
        GridPoint(*point)
        for point in product(num_top_features, reg_params, standardization, max_iters)
    ]


class TrialLog:
    """Scores of a grid search, one file for each finished point of a fold.

    Each is written by a job of its own and is there as a whole or not at all, so a search
    may be stopped at any time. A log belongs to one search; another one is refused.
    """

    SCHEMA = (
        "search string, fold int, numTopFeatures int, regParam double, "
        "standardization boolean, maxIter int, f1 double"
    )

    def __init__(self, spark: SparkSession, path: str, search: str):
        self.spark, self.path, self.search = spark, path, search
        spark.createDataFrame([], self.SCHEMA).write.mode("append").json(path)
        others = self.read().where(F.col("search") != search).limit(1).count()
        if others:
            raise ValueError(f"{path} is the log of another search")

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).json(self.path)

    def append(self, fold: int, point: GridPoint, f1: float) -> None:
        row = (self.search, fold, *asdict(point).values(), f1)
        self.spark.createDataFrame([row], self.SCHEMA).coalesce(1).write.mode("append").json(self.path)

    def scores(self) -> dict[tuple[int, GridPoint], float]:
        """F1 by fold and point; of a trial that was logged twice, the first counts."""
        names = [field.name for field in fields(GridPoint)]
        rows = self.read().groupBy("fold", *names).agg(F.min("f1").alias("f1")).collect()
        return {(r.fold, GridPoint(*(r[name] for name in names))): r.f1 for r in rows}


def f1_score(predictions: DataFrame) -> float:
    return weighted_f1(confusion_counts(predictions)).first().f1


def training_set(features: DataFrame, num_features: int) -> DataFrame:
    """Label and vector for the iterations of a fit, in few enough parts.

    They are stored in the shared folder and kept in memory from there: what a lost
    executor had is read again, and no text below is tokenized a second time. Vectors are
    far smaller than the texts they came from, and every iteration runs one task per part.
    A part holds about ``ENTRIES_PER_PART`` entries, counted in the stored vectors: most
    documents have few of the selected terms, and an iteration on parts sized as if they
    had all of them is mostly the start of its tasks.
    """
    rows = stored(features, "training")
    rows_per_part = max(1, ENTRIES_PER_PART // min(num_features, _row_entries(rows)))
    parts = max(1, -(-rows.count() // rows_per_part))
    splits = rows.rdd.getNumPartitions()
    if parts != splits:
        rows = rows.coalesce(parts) if parts < splits else rows.repartition(parts)
    return rows.persist(StorageLevel.MEMORY_AND_DISK)


def _row_entries(rows: DataFrame) -> int:
    """Entries that a row of a training set takes on average, rounded up; one at least."""
    vector = next(f.name for f in rows.schema if isinstance(f.dataType, VectorUDT))
    held = rows.where(F.col(vector).isNotNull())
    documents = held.count()
    if not documents:
        return 1
    there = held.select(Summarizer.metrics("numNonZeros").summary(F.col(vector)).alias("s"))
    return ROW_ENTRIES + math.ceil(there.first().s.numNonZeros.toArray().sum() / documents)


def fit_point(train: DataFrame, point: GridPoint, parallelism: int = 1) -> OneVsRestModel:
    """One multi-class SVM on normalized features."""
    svm = linear_svm(point.regParam, point.maxIter, point.standardization)
    return one_vs_rest(svm, parallelism).fit(train)


def fit_label(train: HingeRows, point: GridPoint, label: int) -> Generator:
    """One of the binary SVMs of :func:`fit_point`: the label against all others.

    The fit is a generator for ``in_step``. It goes on where one of the same problem and a
    lower limit ended, as that one's steps are its first ones; the two take turns.
    """
    way = train.minimizer(label, point.regParam, point.standardization)
    yield from way.until(point.maxIter)
    return way.model()


def shared_fits(
    train: DataFrame, points: Sequence[GridPoint], label: int
) -> dict[GridPoint, LinearSVCModel]:
    """The binary SVMs of points that differ in ``maxIter`` only, the least one first."""
    found: dict[GridPoint, LinearSVCModel] = {}
    rows = HingeRows(train)
    in_step([(_shared_fits(rows, points, label, found.__setitem__), rows)])
    return found


def _shared_fits(
    train: HingeRows,
    points: Sequence[GridPoint],
    label: int,
    found: Callable[[GridPoint, LinearSVCModel], None],
) -> Generator:
    """Fits of :func:`shared_fits`; ``found`` is told each model as soon as it is there.

    A fit that stopped before its limit would stop there under any higher limit, so it is
    the model of all points that follow.
    """
    model = None
    for point in sorted(points, key=lambda p: p.maxIter):
        way = train.minimizer(label, point.regParam, point.standardization)
        if model is None or way.iterations >= limit:
            model, limit = (yield from fit_label(train, point, label)), point.maxIter
        found(point, model)


def _sharing(point: GridPoint) -> tuple:
    """What two points must have in common to share a run of the optimizer."""
    return point.numTopFeatures, point.regParam, point.standardization


@dataclass
class _Fold:
    """Vectors of one fold by number of features, and the number of labels."""

    train: dict[int, HingeRows]
    held_out: dict[int, DataFrame]
    labels: int

    def release(self) -> None:
        for part in self.held_out.values():
            part.unpersist()


def _fold_vectors(
    train: DataFrame, held_out: DataFrame, sizes: Sequence[int], stopwords: StopWords
) -> _Fold:
    """The vectors of one fold.

    The ranking of the terms, their counts and weights depend on the fold alone. The
    best terms of the largest selection are counted once and stored; as they are in order
    of rank, a smaller selection is the first of them. No text is tokenized for a point.
    """
    terms = best_terms(train, max(sizes), stopwords)
    counting = Pipeline(stages=count_stages(stopwords, terms)).fit(train)
    counts = [
        stored(counting.transform(part).select("label", "raw_features"), "counts")
        for part in (train, held_out)
    ]
    weighting = inverse_document_frequency().fit(counts[0])
    fold = _Fold({}, {}, len(counting.stages[0].labels))
    for size in sizes:
        select = VectorSlicer(
            inputCol="tfidf_features",
            outputCol="selected_features",
            indices=list(range(min(size, len(terms)))),
        )
        train_vectors, held_vectors = (
            l2_normalizer()
            .transform(select.transform(weighting.transform(part)))
            .select("label", "norm_features")
            for part in counts
        )
        fold.train[size] = HingeRows(train_vectors)
        fold.held_out[size] = training_set(held_vectors, size)
    return fold


def _scores(
    folds: dict[int, _Fold],
    grid: dict[int, Sequence[GridPoint]],
    session: SparkSession,
    parallelism: int | None,
    finished: Callable[[int, GridPoint, float], None],
) -> None:
    """F1 of every point on its folds, told to ``finished`` as soon as it is known.

    All binary fits, of whatever fold, point and label, go in step, and points are scored
    beside them. Points whose fits are the same models are scored once.
    """
    models: dict[tuple[int, GridPoint], dict[int, LinearSVCModel]] = {}
    scored: dict[tuple, Future] = {}
    waiting: list[tuple[int, GridPoint, Future]] = []
    score = inheritable_thread_target(session)(_score)

    def found(fold, label, point, model):
        own = models.setdefault((fold, point), {})
        own[label] = model
        if len(own) == folds[fold].labels:
            ordered = [own[i] for i in sorted(models.pop((fold, point)))]
            key = tuple(m.uid for m in ordered)
            if key not in scored:
                scored[key] = pool.submit(score, ordered, folds[fold].held_out[point.numTopFeatures])
            waiting.append((fold, point, scored[key]))

    def report(all_of_them=False):
        for trial in [t for t in waiting if all_of_them or t[2].done()]:
            waiting.remove(trial)
            finished(*trial[:2], trial[2].result())

    fits = []
    for number, fold in folds.items():
        families: dict[tuple, list[GridPoint]] = {}
        for point in grid[number]:
            families.setdefault(_sharing(point), []).append(point)
        for family, points in families.items():
            rows = fold.train[family[0]]
            for label in range(fold.labels):
                told = partial(found, number, label)
                fits.append((_shared_fits(rows, points, label, told), rows))
    with ThreadPoolExecutor(SCORED_AT_A_TIME) as pool:
        try:
            in_step(fits, parallelism, report)
            report(all_of_them=True)
        finally:
            pool.shutdown(cancel_futures=True)


def _score(models: Sequence[LinearSVCModel], held_out: DataFrame) -> float:
    """F1 of one-vs-rest by the models; the JVM's own transformer needs no Python workers."""
    model = OneVsRestModel(models=list(models)).setFeaturesCol("norm_features")
    model._set(classifier=linear_svm(), predictionCol="prediction", rawPredictionCol="")
    predicted = model._to_java().transform(held_out._jdf)
    return f1_score(DataFrame(predicted, held_out.sparkSession))


def grid_search(
    docs: DataFrame,
    grid: Sequence[GridPoint],
    stopwords: StopWords = (),
    folds: int = FOLDS,
    seed: int = SEED,
    parallelism: int | None = None,
    log: str | None = None,
) -> DataFrame:
    """Mean F1 over the folds for every point: the metrics table.

    Folds are hash buckets of ``doc_id``, and nothing is fitted on the held-out
    fold. ``parallelism`` binary SVMs are trained at a time, by default as many as have
    their weights in one job. With ``log``, a folder, every finished point of a fold is
    appended there at once, and a search that was stopped goes on where it was: points
    that the log has are not fitted again, a fold it has is not read.
    """
    if not isinstance(stopwords, DataFrame):
        stopwords = tuple(stopwords)
    trials = None
    known: dict[tuple[int, GridPoint], float] = {}
    if log is not None:
        trials = TrialLog(docs.sparkSession, log, _search_name(docs, stopwords, folds, seed))
        known = trials.scores()
    folded = assign_fold(docs, folds, seed=seed)
    left = {fold: [p for p in grid if (fold, p) not in known] for fold in range(folds)}

    def finished(fold, point, f1):
        known[fold, point] = f1
        if trials is not None:
            trials.append(fold, point, f1)

    vectors: dict[int, _Fold] = {}
    with scratch():

        def prepare(fold):
            parts = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
            sizes = sorted({p.numTopFeatures for p in left[fold]})
            vectors[fold] = _fold_vectors(*parts, sizes, stopwords)

        try:
            with ThreadPoolExecutor(FOLDS_AT_A_TIME) as pool:
                own_thread = inheritable_thread_target(docs.sparkSession)(in_scope(prepare))
                list(pool.map(own_thread, [fold for fold, points in left.items() if points]))
            _scores(vectors, left, docs.sparkSession, parallelism, finished)
        finally:
            for fold in vectors.values():
                fold.release()
    rows = [
        (*asdict(point).values(), sum(known[fold, point] for fold in range(folds)) / folds)
        for point in grid
    ]
    return docs.sparkSession.createDataFrame(rows, METRICS_SCHEMA)


def _search_name(docs: DataFrame, stopwords: StopWords, folds: int, seed: int) -> str:
    """What a log must have been written for: documents, stopwords and folds."""
    words = stopwords.count() if isinstance(stopwords, DataFrame) else len(stopwords)
    sums = docs.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.crc32(F.concat_ws("|", "doc_id", "category", "reviewText").cast("binary"))).alias("s"),
    ).first()
    return f"documents={sums.n}/{sums.s} stopwords={words} folds={folds} seed={seed}"


def best_point(metrics: DataFrame) -> GridPoint:
    """The configuration of highest F1; ties go to the smaller model."""
    row = metrics.orderBy(
        F.desc("f1"), "numTopFeatures", "maxIter", "regParam", "standardization"
    ).first()
    return GridPoint(row.numTopFeatures, row.regParam, row.standardization, row.maxIter)
