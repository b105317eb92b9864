"""A fitted classifier as tables, and predictions from these by joins and sums."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.feature import CountVectorizerModel, IDFModel, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscope.operators.terms import StopWords
from termscope.operators.vectors import term_frequency
from termscope.sources.storage import join_by_size


@dataclass(frozen=True)
class ModelTables:
    """``labels (label, name, intercept)``, ``terms (term, idf)`` and
    ``weights (label, term, weight)``: as many rows as the model has numbers."""

    labels: DataFrame
    terms: DataFrame
    weights: DataFrame

    def write(self, path: str) -> None:
        """Write the tables below ``path``; any session can score from there."""
        for name in ("labels", "terms", "weights"):
            getattr(self, name).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> ModelTables:
        return cls(*(spark.read.parquet(f"{path}/{n}") for n in ("labels", "terms", "weights")))


def _stage(model: PipelineModel, kind: type):
    return next(stage for stage in model.stages if isinstance(stage, kind))


def model_tables(model: PipelineModel) -> ModelTables:
    """The tables of a pipeline of counts, weights, unit vectors and one-vs-rest SVMs."""
    spark = SparkSession.active()
    names = _stage(model, StringIndexerModel).labels
    terms = _stage(model, CountVectorizerModel).vocabulary
    idf = _stage(model, IDFModel).idf.toArray()
    svms = _stage(model, OneVsRestModel).models
    labels = [(i, names[i], float(svm.intercept)) for i, svm in enumerate(svms)]
    weights = [
        (i, term, float(w))
        for i, svm in enumerate(svms)
        for term, w in zip(terms, svm.coefficients.toArray())
        if w
    ]
    return ModelTables(
        spark.createDataFrame(labels, "label int, name string, intercept double"),
        spark.createDataFrame([(t, float(w)) for t, w in zip(terms, idf)], "term string, idf double"),
        spark.createDataFrame(weights, "label int, term string, weight double"),
    )


def predictions(docs: DataFrame, tables: ModelTables, stopwords: StopWords = ()) -> DataFrame:
    """``(doc_id, label, prediction)`` of documents ``(doc_id, category, reviewText)``.

    The margin of a label is its intercept plus the sum of the weights of a document's
    terms, each times the term's share of the unit vector. The largest margin wins, ties go
    to the smaller label. Documents without any known term have the intercepts; those whose
    category the model has not seen are left out, as its label index does.

    Terms and weights are joined by measured size, and sums are added up in each task
    before they are shuffled by document.
    """
    counted = term_frequency(docs.select("doc_id", "reviewText"), stopwords)
    weighted = join_by_size(counted, tables.terms, "term", "terms").select(
        "doc_id", "term", (F.col("tf") * F.col("idf")).alias("x")
    )
    by_term = tables.weights.groupBy("term").agg(
        F.map_from_entries(F.collect_list(F.struct("label", "weight"))).alias("w")
    )
    met = weighted.join(F.broadcast(by_term) if _small(by_term) else by_term, "term", "left")
    labels = tables.labels.orderBy("label").collect()
    # One column a label: a model has a handful of them.
    sums = [
        F.sum(F.col("x") * F.coalesce(F.element_at("w", F.lit(r.label)), F.lit(0.0))).alias(f"m{r.label}")
        for r in labels
    ]
    lengths = met.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"), *sums)
    known = docs.select("doc_id", "category").join(
        F.broadcast(tables.labels.select("label", F.col("name").alias("category"))), "category"
    )
    scored = known.join(lengths, "doc_id", "left")
    margins = F.array(
        *(
            F.struct(
                (
                    F.coalesce(F.col(f"m{r.label}") / F.nullif("length", F.lit(0.0)), F.lit(0.0))
                    + F.lit(r.intercept)
                ).alias("margin"),
                F.lit(-r.label).alias("minus"),
            )
            for r in labels
        )
    )
    return scored.select(
        "doc_id", "label", (-F.array_max(margins)["minus"]).cast("int").alias("prediction")
    )


def _small(by_term: DataFrame) -> bool:
    """Whether the weights are few enough to be sent everywhere."""
    return by_term.count() <= 100_000
