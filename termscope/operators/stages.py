"""Spark ML stages for text features and the multi-class linear SVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    CountVectorizerModel,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    StringIndexer,
    UnivariateFeatureSelector,
    VectorSlicer,
)
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscope.functions.text import DELIMITER_PATTERN, MIN_TERM_LENGTH
from termscope.operators.selection import best_terms
from termscope.operators.terms import StopWords
from termscope.sources.storage import stored

Stage = Estimator | Transformer

# Fixed value: features kept by selection.
NUM_TOP_FEATURES = 2000


def label_indexer(label: str = "category") -> StringIndexer:
    """Label to index by frequency; unknown and NULL labels are skipped."""
    return StringIndexer(inputCol=label, outputCol="label", handleInvalid="skip")


def review_tokenizer(text: str = "reviewText", output: str = "tokens") -> RegexTokenizer:
    """Lower-case, then split at the delimiters. NULL text is an error: filter it."""
    return RegexTokenizer(
        pattern=DELIMITER_PATTERN, gaps=True, toLowercase=True, inputCol=text, outputCol=output
    )


def term_filters(stopwords: Iterable[str]) -> list[Stage]:
    """Drop stopwords in any case, then words of one character in any script."""
    return [
        StopWordsRemover(
            stopWords=sorted(set(stopwords)),
            caseSensitive=False,
            inputCol="tokens",
            outputCol="unstopped",
        ),
        SQLTransformer(
            statement="SELECT *, filter(unstopped, t -> char_length(t) >= "
            f"{MIN_TERM_LENGTH}) AS filtered FROM __THIS__"
        ),
    ]


def count_vectorizer(size: int) -> CountVectorizer:
    """Term counts over the most frequent ``size`` terms, all others dropped.

    The vocabulary lives on the driver and in every task, so its bound is an
    argument. The runs do not use it: they select terms first, over all of them, and
    count those with ``fixed_vocabulary``.
    """
    return CountVectorizer(
        inputCol="filtered", outputCol="raw_features", vocabSize=size, minDF=1.0
    )


def fixed_vocabulary(terms: Sequence[str]) -> CountVectorizerModel:
    """Term counts over terms chosen beforehand, such as ``best_terms``."""
    return CountVectorizerModel.from_vocabulary(
        list(terms), inputCol="filtered", outputCol="raw_features"
    )


def inverse_document_frequency(output: str = "tfidf_features") -> IDF:
    return IDF(inputCol="raw_features", outputCol=output)


def chi_square_selector(num_features: int = NUM_TOP_FEATURES) -> UnivariateFeatureSelector:
    """Keep the features of smallest chi-square p-value, ties by index.

    Every distinct weight of a feature is a category of its own; more than 10,000
    of them is an error. ``best_terms`` has neither limit.
    """
    selector = UnivariateFeatureSelector(
        featuresCol="tfidf_features",
        labelCol="label",
        outputCol="selected_features",
        selectionMode="numTopFeatures",
    )
    selector.setFeatureType("categorical").setLabelType("categorical")
    return selector.setSelectionThreshold(num_features)


def l2_normalizer() -> Normalizer:
    return Normalizer(p=2.0, inputCol="selected_features", outputCol="norm_features")


def linear_svm(
    reg_param: float = 0.0,
    max_iter: int = 100,
    standardization: bool = True,
    features: str = "norm_features",
) -> LinearSVC:
    return LinearSVC(
        featuresCol=features,
        labelCol="label",
        predictionCol="prediction",
        regParam=reg_param,
        maxIter=max_iter,
        standardization=standardization,
    )


def one_vs_rest(svm: LinearSVC, parallelism: int = 1) -> OneVsRest:
    """One SVM per label; ``parallelism`` of them are trained at a time."""
    return OneVsRest(
        classifier=svm,
        featuresCol=svm.getFeaturesCol(),
        labelCol="label",
        predictionCol="prediction",
        parallelism=parallelism,
    )


def count_stages(stopwords: StopWords, vocabulary: Sequence[str] | int) -> list[Stage]:
    """From text and category to label and term counts.

    ``vocabulary`` is the most terms to keep, or the terms themselves. A table of
    stopwords goes with given terms only, among which there are none of them.
    """
    if isinstance(vocabulary, int):
        if isinstance(stopwords, DataFrame):
            raise ValueError("select the terms first: a stopword table needs given terms")
        vectorizer = count_vectorizer(vocabulary)
    else:
        vectorizer = fixed_vocabulary(vocabulary)
    listed = () if isinstance(stopwords, DataFrame) else stopwords
    return [label_indexer(), review_tokenizer(), *term_filters(listed), vectorizer]


def selection_stages(stopwords: StopWords, terms: Sequence[str]) -> Pipeline:
    """Text to the TF-IDF weights of selected terms."""
    weights = inverse_document_frequency("selected_features")
    return Pipeline(stages=[*count_stages(stopwords, terms), weights])


def fit_selection(
    docs: DataFrame, stopwords: StopWords = (), num_features: int = NUM_TOP_FEATURES
) -> PipelineModel:
    """Select terms over the whole vocabulary of ``docs``, then weight them."""
    terms = best_terms(docs, num_features, stopwords)
    return selection_stages(stopwords, terms).fit(docs)


def weighted_documents(
    docs: DataFrame, stopwords: StopWords, terms: Sequence[str], keep: Sequence[str] = ("doc_id",)
) -> tuple[PipelineModel, DataFrame]:
    """The fitted stages of :func:`selection_stages` and what they make of ``docs``:
    ``(keep, label, selected_features)``.

    Texts are tokenized once: the counts of the given terms are stored, and the weights are
    fitted on them and applied to them.
    """
    *counting, weights = selection_stages(stopwords, terms).getStages()
    counted = Pipeline(stages=counting).fit(docs)
    counts = counted.transform(docs).select(*keep, "label", "raw_features")
    counts = stored(counts, "counts")
    weighted = weights.fit(counts)
    model = PipelineModel(stages=[*counted.stages, weighted])
    return model, weighted.transform(counts).select(*keep, "label", "selected_features")


def classifier_stages(
    stopwords: StopWords, classifier: OneVsRest, terms: Sequence[str]
) -> Pipeline:
    """Text to a predicted category."""
    selection = selection_stages(stopwords, terms).getStages()
    return Pipeline(stages=[*selection, l2_normalizer(), classifier])


def vocabulary_terms(model: PipelineModel) -> DataFrame:
    """The fitted vocabulary, ``(idx, term)``; its size is an argument of the fit."""
    terms = _stage(model, CountVectorizerModel).vocabulary
    return SparkSession.active().createDataFrame(list(enumerate(terms)), "idx int, term string")


def _stage(model: PipelineModel, kind: type) -> Stage:
    return next(stage for stage in model.stages if isinstance(stage, kind))


def feature_statistics(weighted: DataFrame) -> DataFrame:
    """Chi-square test of every feature: ``(featureIndex, pValue, ..., statistic)``."""
    return ChiSquareTest.test(weighted, "tfidf_features", "label", flatten=True)


def slice_top_features(statistics: DataFrame, num_features: int) -> VectorSlicer:
    """The selection of :func:`chi_square_selector` from statistics already at hand.

    The order of the test results does not depend on how many are kept, so one
    test serves every ``num_features``. Only that many indices are collected.
    """
    best = statistics.orderBy("pValue", "featureIndex").limit(num_features)
    indices = sorted(r.featureIndex for r in best.select("featureIndex").collect())
    return VectorSlicer(
        inputCol="tfidf_features", outputCol="selected_features", indices=indices
    )


def vector_entries(df: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """Non-zero entries of a vector column: ``(keys, slot, weight)``.

    A sparse vector becomes as many rows as it has entries, not as it has slots.
    """
    parts = F.unwrap_udt(F.col(vector))
    every = F.sequence(F.lit(0), F.size(parts["values"]) - 1)
    none = F.size(parts["values"]) == 0
    slots = F.coalesce(parts["indices"], F.when(none, F.array().cast("array<int>")).otherwise(every))
    zipped = F.arrays_zip(slots.alias("slot"), parts["values"].alias("weight"))
    return df.select(*keys, F.inline(zipped).alias("slot", "weight")).where("weight <> 0")
