"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termscope.llm.arrays import U64, mix, parts
from termscope.llm.bits import hashed_ids, id_bits
from termscope.sources.storage import stored

#: Lengths of the n-grams, in lower-case characters, white space included.
ORDERS = (3, 4, 5)

#: n-grams are told apart by a hash of so many bits.
HASH_BITS = 20

#: At most so many labelled documents of each class are learned from, those with the
#: least hash of their doc_id.
MAX_TRAINING = 10_000

#: Features need this many documents of the sample, and this log-count ratio.
LEAST_DOCUMENTS = 5
LEAST_RATIO = 1.0
MAX_FEATURES = 50_000

PENALTY = 1e-2
ROUNDS = 300


def _ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the hashed n-gram at each place and the text it is in.

    Places whose n-gram would reach into the next text are left out.
    """
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(U64)
    lengths = np.array([len(t) for t in lowered], np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    rolled = codes.copy()
    for order in range(1, max(ORDERS) + 1):
        if order > 1:
            if len(codes) < order:
                return
            rolled = rolled[:-1] * U64(0x9E3779B97F4A7C15) + codes[order - 1 :]
        if order in ORDERS:
            own = owner[: len(rolled)] == owner[order - 1 :]
            hashes = mix(rolled + U64(order)) >> U64(64 - HASH_BITS)
            yield hashes[own].astype(np.int64), owner[: len(rolled)][own]


def _presence(texts: list[str], chosen: np.ndarray | None = None):
    """``(text, feature)`` pairs, each once; ``chosen`` maps hashes to features or -1."""
    rows, columns = [], []
    for hashes, owner in _ngrams(texts):
        if chosen is not None:
            hashes = chosen[hashes]
            hit = np.flatnonzero(hashes >= 0)
            hashes, owner = hashes[hit], owner[hit]
        rows.append(owner.astype(np.int64))
        columns.append(hashes)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = np.unique((np.concatenate(rows) << 32) | np.concatenate(columns))
    return keys >> 32, keys & 0xFFFFFFFF


@dataclass
class Model:
    """Hashes and weights of the features, ratios included, and the intercept."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float

    def table(self) -> np.ndarray:
        chosen = np.full(1 << HASH_BITS, -1, np.int64)
        chosen[self.hashes] = np.arange(len(self.hashes))
        return chosen

    def scores(self, texts: list[str], table: np.ndarray) -> np.ndarray:
        rows, features = _presence(texts, table)
        sums = np.bincount(rows, weights=self.weights[features], minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(sums + self.intercept, -60, 60)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept for testing: crc32 of its id as text is 0 modulo 5."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> DataFrame:
    """``(text, toxic)`` of at most ``most`` labelled rows of each class."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic").where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()
    )
    known = known.withColumn("order", F.xxhash64("doc_id"))
    picked = [
        known.where(F.col("toxic") == c).orderBy("order", "doc_id").limit(most) for c in (0, 1)
    ]
    ids = stored(picked[0].union(picked[1]).select("doc_id", "toxic"), "sample")
    bits = id_bits(ids, "doc_id")

    def near(batches):
        for batch in batches:
            yield batch.filter(pa.array(hashed_ids(batch.column("doc_id"), bits.value)))

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = texts.mapInArrow(near, "doc_id bigint, text string").join(ids, "doc_id")
    return stored(rows.select("text", "toxic"), "training")


def _log_count_ratios(sample: DataFrame, toxic: int, clean: int) -> DataFrame:
    """``(hash, ratio)`` of the features worth a weight, over the whole sample."""

    def count(batches):
        found = np.zeros((2, 1 << HASH_BITS), np.int64)
        for batch, _, _ in parts(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows, hashes = _presence(texts)
            label = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)[rows]
            for c in (0, 1):
                found[c] += np.bincount(hashes[label == c], minlength=found.shape[1])
        at = np.flatnonzero(found.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(found[1][at]), pa.array(found[0][at])], ["hash", "p", "q"]
        )

    counts = sample.mapInArrow(count, "hash bigint, p bigint, q bigint")
    counts = counts.groupBy("hash").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    ratio = F.log((F.col("p") + 1) / F.lit(toxic + 2.0)) - F.log(
        (F.col("q") + 1) / F.lit(clean + 2.0)
    )
    return (
        counts.where(F.col("p") + F.col("q") >= LEAST_DOCUMENTS)
        .select("hash", ratio.alias("ratio"), (F.col("p") + F.col("q")).alias("n"))
        .where(F.abs("ratio") >= LEAST_RATIO)
        .orderBy(F.desc(F.abs("ratio") * F.log("n")), "hash")
        .limit(MAX_FEATURES)
        .select("hash", "ratio")
    )


def _fitted(rows, columns, values, labels) -> tuple[np.ndarray, float]:
    """Weights and intercept of a penalized logistic regression, by Nesterov steps.

    Both classes weigh the same, however few toxic documents there are.
    """
    n, k = len(labels), len(values)
    toxic = max(labels.sum(), 1)
    each = np.where(labels > 0, 0.5 / toxic, 0.5 / max(n - toxic, 1))
    scale = values[columns]

    def sums(w, b):
        return np.bincount(rows, weights=scale * w[columns], minlength=n) + b

    def back(error):
        return np.bincount(columns, weights=scale * error[rows], minlength=k)

    # The largest curvature, by power iteration, bounds the step.
    probe, bend = np.ones(k) / np.sqrt(max(k, 1)), 1.0
    for _ in range(20):
        turned = back(each * sums(probe, 0.0))
        bend = max(float(np.linalg.norm(turned)), 1e-9)
        probe = turned / bend
    step = 1.0 / (0.3 * bend + 0.3 + PENALTY)
    w, b = np.zeros(k), 0.0
    last_w, last_b = w, b
    for t in range(ROUNDS):
        move = t / (t + 3)
        at_w, at_b = w + move * (w - last_w), b + move * (b - last_b)
        error = each * (1 / (1 + np.exp(-np.clip(sums(at_w, at_b), -60, 60))) - labels)
        last_w, last_b = w, b
        w = at_w - step * (back(error) + PENALTY * at_w)
        b = at_b - step * error.sum()
    return w, b


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> Model:
    """Learn from labelled rows that are not held out.

    The sample, its counts and its sparse rows are made on executors. The driver gets
    the chosen features and, for the last step, which of them each document of the
    sample has: both are bounded by ``MAX_TRAINING`` and ``MAX_FEATURES``, whatever
    the size of the corpus. Without labels of both classes nothing is toxic.
    """
    sample = training_sample(docs, labels, most)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Model(np.zeros(0, np.int64), np.zeros(0), -60.0)
    ratios = _log_count_ratios(sample, toxic, clean).toPandas()
    hashes, values = ratios["hash"].to_numpy(), ratios["ratio"].to_numpy()
    table = Model(hashes, values, 0.0).table()

    def present(batches):
        for batch, _, _ in parts(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows, features = _presence(texts, table)
            ends = np.searchsorted(rows, np.arange(len(texts) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(features.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), lists], ["toxic", "features"]
            )

    found = sample.mapInArrow(present, "toxic int, features array<int>").toArrow()
    found = found.combine_chunks()
    features = found.column("features").combine_chunks()
    rows = np.repeat(np.arange(len(features)), pc.list_value_length(features).to_numpy())
    columns = features.flatten().to_numpy().astype(np.int64)
    marks = found.column("toxic").to_numpy().astype(float)
    w, b = _fitted(rows, columns, values, marks)
    return Model(hashes, w * values, float(b))


def _sent(docs: DataFrame, model: Model) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast(
        (model.hashes.astype(np.int64), model.weights, model.intercept)
    )


def _marked(batches, sent, column):
    """Slices of the batches with the scores of their texts."""
    model = Model(*sent.value)
    table = model.table()
    for batch, _, _ in parts(batches, column):
        texts = [t or "" for t in batch.column(column).to_pylist()]
        yield batch, model.scores(texts, table)


def toxicity(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs``.

    The score depends on the whole text alone. It is between 0 and 1; from 0.5 on
    ``predicted`` is 1. Null and empty texts have the score of a text without features,
    and rows with a null doc_id are scored but not held out. Labels that are neither 0
    nor 1 are not used; of repeated rows each counts.
    """
    sent = _sent(docs, fit(docs, labels, most))

    def score(batches):
        for batch, scores in _marked(batches, sent, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = rows.mapInArrow(score, "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    sent = _sent(docs, fit(docs, labels, most))

    def keep(batches):
        for batch, scores in _marked(batches, sent, "text"):
            yield batch.filter(pa.array(scores < 0.5))

    return docs.mapInArrow(keep, T.StructType(docs.schema.fields))
