"""ML stages, with the library's own defaults: 2000 features, all 24 grid points."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from termscope.catalog.base import (
    SQL_DELIMITERS,
    SQL_STOP,
    STOP,
    docs,
    sql_corpus,
    sql_counts,
    sql_docs,
    sql_with,
    table,
)
from termscope.catalog.tuning import SQL_SPLIT
from termscope.operators import stages
from termscope.operators.certificate import duality_gap
from termscope.operators.counts import tally, tally_of
from termscope.operators.evaluation import (
    confusion_counts,
    majority_f1,
    split_part,
    train_val_union,
    weighted_f1,
)
from termscope.operators.numbering import global_rank
from termscope.operators.scores import contingency, global_scores
from termscope.operators.scoring import ModelTables, model_tables, predictions
from termscope.operators.selection import best_terms, term_statistics, top_statistics
from termscope.operators.tuning import GridPoint, grid_search, parameter_grid
from termscope.plans.classification import fit_classifier, fit_stages, test_score
from termscope.sources.storage import new_path

POINT = GridPoint(numTopFeatures=2000, regParam=0.01, standardization=True, maxIter=100)
PARALLELISM = 4
#: Largest distance to the dual bound, as a share of the objective, that counts as optimal.
MAX_GAP = 0.1


def ml_tokens(spark, sf_dir):
    tokenized = stages.review_tokenizer().transform(docs(spark, sf_dir))
    return tokenized.select("doc_id", F.posexplode("tokens").alias("pos", "token"))


def ml_filtered_tokens(spark, sf_dir):
    df = stages.review_tokenizer().transform(docs(spark, sf_dir))
    for stage in stages.term_filters(STOP):
        df = stage.transform(df)
    return df.select("doc_id", F.posexplode("filtered").alias("pos", "token"))


def ml_feature_statistics(spark, sf_dir):
    """The selector's test of every term of the corpus."""
    return term_statistics(docs(spark, sf_dir), STOP).withColumn(
        "statistic", F.round("statistic", 4)
    )


def ml_selected_terms(spark, sf_dir):
    return top_statistics(term_statistics(docs(spark, sf_dir), STOP), POINT.numTopFeatures)


def selected_terms(spark, sf_dir):
    """The selection's terms with their presence statistic, ranked by it."""
    corpus = docs(spark, sf_dir)
    terms = top_statistics(term_statistics(corpus, STOP), POINT.numTopFeatures).select("term")
    scored = global_scores(contingency(tally_of(tally(corpus, STOP), terms)))
    ranked = global_rank(scored.select("term", "chi2"), [F.desc("chi2"), F.asc("term")])
    return ranked.select("rk", "term", "chi2")


def _entries(model, features, vector):
    """Non-zero weights by term; the table of terms has as many rows as were selected."""
    entries = stages.vector_entries(features, ["doc_id", "label"], vector)
    terms = F.broadcast(stages.vocabulary_terms(model))
    return entries.join(terms, F.col("slot") == F.col("idx")).select(
        "doc_id",
        F.col("label").cast("int").alias("label"),
        "term",
        F.round("weight", 6).alias("weight"),
    )


def selected_features(spark, sf_dir):
    """TF-IDF weights of the selected terms in every document."""
    corpus = docs(spark, sf_dir)
    terms = best_terms(corpus, POINT.numTopFeatures, STOP)
    model, features = stages.weighted_documents(corpus, STOP, terms)
    return _entries(model, features, "selected_features")


def feature_pipeline(spark, sf_dir):
    """All stages before the classifier: label and unit vectors of selected terms."""
    corpus = docs(spark, sf_dir)
    terms = best_terms(corpus, POINT.numTopFeatures, STOP)
    model, features = stages.weighted_documents(corpus, STOP, terms)
    return _entries(model, stages.l2_normalizer().transform(features), "norm_features")


def _fitted(corpus, classifier):
    """A fit of all stages and the vectors it was fitted on."""
    known = train_val_union(corpus)
    model = fit_stages(known, classifier, POINT.numTopFeatures, STOP)
    return model, PipelineModel(stages=model.stages[:-1]).transform(known)


def svm_quality_predictions(spark, sf_dir):
    """Binary: the quality label, learned from the training part, for the test part.

    ``optimal`` says that the fit's duality gap is within bounds: no other hyperplane has an
    objective much lower. A guess of the more frequent label fails that.
    """
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("quality")
    )
    corpus = docs(spark, sf_dir).join(labels, "doc_id").select(
        "doc_id", F.col("quality").alias("category"), "reviewText"
    )
    svm = stages.linear_svm(POINT.regParam, POINT.maxIter, standardization=False)
    model, known = _fitted(corpus, svm)
    gap = duality_gap(known, model.stages[-1]).select("gap").scalar()
    tested = model.transform(split_part(corpus, "test"))
    return tested.select(
        "doc_id",
        F.col("label").cast("int").alias("label"),
        F.col("prediction").isin(0.0, 1.0).alias("known_prediction"),
        (gap <= MAX_GAP).alias("optimal"),
    )


def svm_lang_predictions(spark, sf_dir):
    """One SVM a language. Predictions are made by the fitted stages and once more by
    joins and sums over the model's tables; ``same_by_joins`` compares them."""
    corpus = docs(spark, sf_dir)
    model = fit_classifier(train_val_union(corpus), POINT, STOP, parallelism=PARALLELISM)
    test = split_part(corpus, "test")
    joined = predictions(test, model_tables(model), STOP)
    tested = model.transform(test).select("doc_id", F.col("prediction").alias("expected"))
    return joined.join(tested, "doc_id").select(
        "doc_id", "label", (F.col("prediction") == F.col("expected")).alias("same_by_joins")
    )


def grid_metrics(spark, sf_dir):
    """All 24 points over both folds, through a trial log.

    SQL can only say what rows there are and what a useful search has to reach: no point
    is out of bounds, and the best one beats the most frequent label by far.
    """
    known = train_val_union(docs(spark, sf_dir))
    log = new_path(spark, "trials")
    metrics = grid_search(known, parameter_grid(), STOP, log=log)
    guess = majority_f1(known, "category").scalar()
    best = metrics.agg(F.max("f1").alias("f1")).scalar()
    return metrics.select(
        "numTopFeatures",
        "regParam",
        "standardization",
        "maxIter",
        ((F.col("f1") > 0) & (F.col("f1") <= 1)).alias("f1_in_bounds"),
        (best > guess + (1 - guess) / 2).alias("best_beats_majority"),
    )


def test_f1(spark, sf_dir):
    """F1 on the test part, by the fitted stages and from the stored tables of the model.

    ``f1_from_tables`` says that both are the same to nine digits, ``beats_majority`` that
    at least half of what the most frequent label gets wrong is right.
    """
    corpus = docs(spark, sf_dir)
    model = fit_classifier(train_val_union(corpus), POINT, STOP, parallelism=PARALLELISM)
    test = split_part(corpus, "test")
    path = new_path(spark, "model")
    model_tables(model).write(path)
    joined = predictions(test, ModelTables.read(spark, path), STOP)
    again = weighted_f1(confusion_counts(joined)).scalar()
    guess = majority_f1(joined).scalar()
    return test_score(model, test).select(
        "documents",
        "skipped",
        (F.round("f1", 9) == F.round(again, 9)).alias("f1_from_tables"),
        (F.col("f1") > guess + (1 - guess) / 2).alias("beats_majority"),
    )


QUERIES = {
    "ml_tokens": ml_tokens,
    "ml_filtered_tokens": ml_filtered_tokens,
    "ml_feature_statistics": ml_feature_statistics,
    "ml_selected_terms": ml_selected_terms,
    "selected_terms": selected_terms,
    "selected_features": selected_features,
    "feature_pipeline": feature_pipeline,
    "svm_quality_predictions": svm_quality_predictions,
    "svm_lang_predictions": svm_lang_predictions,
    "grid_metrics": grid_metrics,
    "test_f1": test_f1,
}

_TOKENS = f"""split AS (
  SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (
    SELECT doc_id, regexp_split_to_array(lower(reviewText), '{SQL_DELIMITERS}') AS w FROM docs))"""

_NUMBERED = "CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INT) AS pos"

# Rows of a term's table are its counts per document, zero included.
_STATISTICS = """tf AS (SELECT doc_id, category, term, count(*) AS tf FROM kept GROUP BY ALL),
cell AS (SELECT term, tf, category, count(*) AS o FROM tf GROUP BY ALL),
side AS (SELECT term, tf, sum(o) AS r FROM cell GROUP BY ALL),
present AS (SELECT term, sum(CAST(o AS DOUBLE) * o / (CAST(r AS DOUBLE) * nc)) AS s,
                   count(DISTINCT tf) AS vals
            FROM cell JOIN side USING (term, tf) JOIN nc USING (category) GROUP BY term),
absent AS (SELECT term, sum(CAST(nc - coalesce(ntc, 0) AS DOUBLE) * (nc - coalesce(ntc, 0)) / nc) AS s
           FROM nt CROSS JOIN nc LEFT JOIN ntc USING (category, term) GROUP BY term)"""

_TESTED = """tested AS (
  SELECT term, CAST(CASE WHEN n = nt THEN 0
         ELSE vals * ((SELECT count(*) FROM nc) - 1) END AS INT) AS dof,
         CASE WHEN n = nt THEN 0.0
              ELSE n * (present.s + absent.s / (n - nt)) - n END AS statistic
  FROM nt CROSS JOIN n JOIN present USING (term) JOIN absent USING (term)),
tailed AS (
  SELECT term, dof, statistic, statistic / 2 AS x, dof / 2.0::DOUBLE AS a,
         CASE WHEN dof % 2 = 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS base
  FROM tested),
begun AS (
  SELECT *, CASE WHEN dof % 2 = 1 THEN x / list_reduce(
                   list_prepend(x + 80.5, list_transform(range(40, 0, -1), lambda n: n::DOUBLE)),
                   lambda f, n: x + 2 * n - 1.5 - n * (n - 0.5) / f) ELSE 1.0::DOUBLE END AS h
  FROM tailed),
ranked AS (
  SELECT term, round(statistic, 6) AS statistic, round(CASE
    WHEN dof <= 0 OR x <= 0 THEN 0.0
    WHEN x >= a + 1 THEN (a - 1) * ln(x) - x - lgamma(a) + ln(list_reduce(
      list_prepend(h, list_transform(range(CAST(a - base AS BIGINT)), lambda j: j::DOUBLE)),
      lambda h, j: 1 + h * (base + j) / x))
    ELSE ln(1 - exp(a * ln(x) - x - lgamma(a + 1)) * list_reduce(
      list_prepend(1.0::DOUBLE, list_transform(range(60 + CAST(ceil(9 * sqrt(a)) AS BIGINT), 0, -1), lambda n: n::DOUBLE)),
      lambda s, n: 1 + s * x / (a + n))) END, 6) AS log_p
  FROM begun),
best AS (
  SELECT row_number() OVER (ORDER BY log_p, term) AS rk, term, log_p, statistic
  FROM ranked ORDER BY rk LIMIT 2000)"""

_SELECTION = (*sql_corpus(), sql_counts(), _STATISTICS, _TESTED)

_LABELS = """labelled AS (
  SELECT category, CAST(row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS INT) AS label
  FROM docs GROUP BY category)"""

_WEIGHTS = """w AS (
  SELECT doc_id, label, term, count(*) * ln((max(n) + 1.0) / (max(nt.nt) + 1.0)) AS w
  FROM kept JOIN nt USING (term) CROSS JOIN n JOIN labelled USING (category)
  WHERE term IN (SELECT term FROM best) GROUP BY doc_id, label, term),
len AS (SELECT doc_id, sqrt(sum(w * w)) AS len FROM w GROUP BY doc_id)"""


def _test_part(corpus: str, *flags: str) -> str:
    """Test documents with the index their label has in the training part."""
    true = "".join(f", true AS {flag}" for flag in flags)
    return f"""WITH {SQL_SPLIT},
corpus AS ({corpus}),
labelled AS (
  SELECT category, CAST(row_number() OVER (ORDER BY count(*) DESC, category) - 1 AS INT) AS label
  FROM corpus WHERE split <> 'test' GROUP BY category)
SELECT doc_id, label{true}
FROM corpus JOIN labelled USING (category) WHERE split = 'test'"""


_LANGUAGES = "SELECT doc_id, category, split FROM split JOIN documents USING (doc_id) WHERE text <> '' AND category <> ''"
_QUALITY = """SELECT doc_id, CAST(quality AS VARCHAR) AS category, split
  FROM split JOIN documents USING (doc_id) JOIN labels USING (doc_id)
  WHERE text <> '' AND split.category <> '' AND quality IS NOT NULL"""

ORACLES = {
    "ml_feature_statistics": sql_with(
        *_SELECTION, select="SELECT term, dof, round(statistic, 4) AS statistic FROM tested"
    ),
    "ml_selected_terms": sql_with(*_SELECTION, select="SELECT rk, term, log_p, statistic FROM best"),
    "selected_terms": sql_with(
        *_SELECTION,
        """cells AS (
  SELECT term, n, nc, nt, CAST(n * coalesce(ntc, 0) - nc * nt AS DOUBLE) AS d
  FROM nt CROSS JOIN nc CROSS JOIN n LEFT JOIN ntc USING (category, term)
  WHERE term IN (SELECT term FROM best)),
globals AS (
  SELECT term, round(sum(CASE WHEN n = nt THEN 0.0
         ELSE d * d / (CAST(nc AS DOUBLE) * nt * (n - nt)) END), 6) AS chi2
  FROM cells GROUP BY term)""",
        select="SELECT row_number() OVER (ORDER BY chi2 DESC, term) AS rk, term, chi2 FROM globals",
    ),
    "selected_features": sql_with(
        *_SELECTION,
        _LABELS,
        _WEIGHTS,
        select="SELECT doc_id, label, term, round(w, 6) AS weight FROM w WHERE w <> 0",
    ),
    "feature_pipeline": sql_with(
        *_SELECTION,
        _LABELS,
        _WEIGHTS,
        select="""SELECT doc_id, label, term, round(w / len, 6) AS weight
FROM w JOIN len USING (doc_id) WHERE w <> 0""",
    ),
    "svm_quality_predictions": _test_part(_QUALITY, "known_prediction", "optimal"),
    "svm_lang_predictions": _test_part(_LANGUAGES, "same_by_joins"),
    "grid_metrics": """SELECT CAST(f AS INT) AS numTopFeatures, CAST(r AS DOUBLE) AS regParam,
  s AS standardization, CAST(m AS INT) AS maxIter, true AS f1_in_bounds,
  true AS best_beats_majority
FROM (SELECT unnest([2000, 500]) AS f), (SELECT unnest([0.01, 0.1, 1.0]) AS r),
     (SELECT unnest([true, false]) AS s), (SELECT unnest([50, 100]) AS m)""",
    "test_f1": f"""WITH {SQL_SPLIT},
corpus AS ({_LANGUAGES})
SELECT count(*) FILTER (WHERE split = 'test') AS documents,
  count(*) FILTER (WHERE split = 'test'
    AND category NOT IN (SELECT category FROM corpus WHERE split <> 'test')) AS skipped,
  true AS f1_from_tables, true AS beats_majority FROM corpus""",
    "ml_tokens": sql_with(
        sql_docs(), _TOKENS, select=f"SELECT doc_id, {_NUMBERED}, w AS token FROM split WHERE w <> ''"
    ),
    "ml_filtered_tokens": sql_with(
        sql_docs(),
        _TOKENS,
        select=f"""SELECT doc_id, {_NUMBERED}, w AS token FROM split
WHERE length(w) >= 2 AND w NOT IN ({SQL_STOP})""",
    ),
}
