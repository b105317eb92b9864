"""Binary linear SVMs fitted in step: one pass over the rows serves a step of every fit.

A fit of Spark's ``LinearSVC`` starts a job for each evaluation of its objective. Here fits
are generators that ask for an objective and wait; one job answers all that are waiting, of
whatever label, penalty and training set. The steps are those of ``LinearSVC``: features
centered and scaled by their standard deviations, an intercept without penalty, and its
minimizer (``breeze.optimize.OWLQN``) with the same line search and rules to stop.
"""

from __future__ import annotations

import itertools
import math
import pickle
import sys
import uuid
from collections import deque
from collections.abc import Callable, Generator, Iterable, Iterator, Sequence
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.classification import LinearSVCModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What runs on executors carries its code along, as that of ``termscope.llm``.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that a task holds as a matrix at a time.
BLOCK_ROWS = 4096

# From this share of rows on, a column is multiplied as a dense one.
DENSE_SHARE = 0.03

# Entries per task while there are cores left, and beyond that.
LEAST_ENTRIES, MOST_ENTRIES = 250_000, 2_000_000

# Weights of all fits in step, 0.4 MB: neither a closure nor a result of a task is large.
WEIGHTS_IN_STEP = 50_000

# From so many tasks on, their sums are added by a tree.
COLLECTED = 32

# Passes after which the driver collects garbage: only then the broadcasts of ended jobs go,
# there and on the executors.
COLLECT_AFTER = 40

# Lengths of a line search that one pass tries at most.
MOST_AHEAD = 8

# What LinearSVC and its minimizer use.
TOLERANCE, PAIRS, RECENT_VALUES = 1e-6, 10, 20
LINE_SEARCH_STEPS, GROW, ARMIJO, WOLFE, LEAST_STEP, MOST_STEP = 20, 2.1, 1e-4, 0.9, 1e-10, 1e10

#: A fit: it yields ``(rows, label, list of weights)``, is sent ``(loss, gradient)`` of each.
Fit = Generator[
    tuple["HingeRows", int, list[np.ndarray]], list[tuple[float, np.ndarray]], object
]


class _NoStep(Exception):
    """No direction or no step along it: the history is dropped, the second time the fit ends."""


class Minimizer:
    """The way of one fit, which may be continued to a higher limit of iterations."""

    def __init__(self, rows: HingeRows, label: int, reg_param: float, standardization: bool):
        self.rows, self.label = rows, label
        own = np.ones_like(rows.scale) if standardization else rows.scale**2
        self.penalty = np.append(reg_param * own, 0.0)
        self.x = np.zeros(len(self.penalty))
        self.value: float | None = None
        self.iterations = 0
        self.pairs: deque = deque(maxlen=PAIRS)
        self.recent = deque([math.inf], maxlen=RECENT_VALUES)
        self.failed = self.given_up = False
        self.ahead = 1

    def until(self, limit: int) -> Fit:
        """Iterate until the fit stops by itself or has made ``limit`` iterations."""
        if self.value is None:
            ((self.x, self.value, self.gradient),) = yield from self._objectives([self.x])
            self.first = abs(self.value)
        while self.iterations < limit and not self.stopped():
            try:
                step = yield from self._step(self._direction())
            except _NoStep:
                self.given_up = self.failed
                self.failed = True
                self.pairs.clear()
                continue
            self.pairs.appendleft((step[0] - self.x, step[2] - self.gradient))
            self.x, self.value, self.gradient = step
            self.recent.append(self.value)
            self.iterations += 1
            self.failed = False

    def stopped(self) -> bool:
        """Whether the fit would end here under any limit."""
        worst = max(self.recent)
        return (
            self.given_up
            or (len(self.recent) > 1 and abs(self.value - worst) <= TOLERANCE * self.first)
            or np.linalg.norm(self.gradient) <= max(TOLERANCE * abs(self.value), 1e-8)
        )

    def model(self) -> LinearSVCModel:
        """As ``LinearSVC`` gives it, in terms of the features as they were."""
        context = self.rows.context
        weights = Vectors.dense(self.x[:-1] * self.rows.scale)
        intercept = float(self.x[-1] - self.rows.center @ self.x[:-1])
        return LinearSVCModel(
            context._jvm.org.apache.spark.ml.classification.LinearSVCModel(
                f"LinearSVC_{uuid.uuid4().hex[:12]}", _py2java(context, weights), intercept
            )
        )

    def _objectives(self, places: list[np.ndarray]) -> Generator:
        found = yield self.rows, self.label, places
        own = [self.penalty * x for x in places]
        return [
            (x, loss + 0.5 * float(o @ x), gradient + o)
            for x, o, (loss, gradient) in zip(places, own, found)
        ]

    def _direction(self) -> np.ndarray:
        """Down the gradient, shaped by the last steps; no component may go up."""
        found, shares = self.gradient.copy(), []
        with np.errstate(all="ignore"):
            for step, change in self.pairs:
                shares.append((step @ found) / (step @ change))
                if np.isnan(shares[-1]):
                    raise _NoStep
                found -= shares[-1] * change
            if self.pairs:
                step, change = self.pairs[0]
                if not step @ change >= 0:
                    raise _NoStep
                found *= (step @ change) / (change @ change)
            for (step, change), share in zip(reversed(self.pairs), reversed(shares)):
                found += (share - (change @ found) / (step @ change)) * step
        return np.where(-found * self.gradient < 0, -found, 0.0)

    def _step(self, direction: np.ndarray) -> Generator:
        """The step that the line search takes: ``(x, value, gradient)``.

        The minimizer compares the first length by the value before the step, so it is
        shortened unseen wherever the direction goes down. As many lengths are asked for at a
        time as the last search took, each a shorter one: most searches shorten only.
        """
        slope = float(self.gradient @ direction)
        side = np.sign(np.where(self.x != 0, self.x, -self.gradient))
        first = self.iterations < 1
        shrink = 0.1 if first else 0.5
        length = 0.5 / np.linalg.norm(self.gradient) if first else 1.0

        known: dict[float, tuple] = {}

        def at(length):
            if length not in known:
                lengths = [length * shrink**i for i in range(self.ahead)]
                places = [self.x + direction * n for n in lengths]
                places = [np.where(np.sign(x) == side, x, 0.0) for x in places]
                known.update(zip(lengths, (yield from self._objectives(places))))
            return known[length]

        value, found, taken = self.value, None, 0
        for _ in range(LINE_SEARCH_STEPS):
            if value > self.value + length * slope * ARMIJO:
                factor = shrink
            else:
                if found is None:
                    found = yield from at(length)
                along = float(found[2] @ direction)
                if along < WOLFE * slope:
                    factor = GROW
                elif along > -WOLFE * slope:
                    factor = shrink
                else:
                    break
            length *= factor
            if not LEAST_STEP <= length <= MOST_STEP:
                raise _NoStep
            before, found = found, (yield from at(length))
            value = found[1]
            taken += 1
        else:
            found = before
        self.ahead = max(1, min(taken, MOST_AHEAD))
        return found


class HingeRows:
    """Label and vector of a training set, and what fits to it have in common.

    Columns are numbered by how many rows have them: the first ones, of many rows, are
    multiplied as a dense matrix, the others entry by entry.
    """

    _numbers = itertools.count()

    def __init__(self, train: DataFrame, vector: str = "norm_features"):
        self.context = train.sparkSession.sparkContext
        self.number = next(self._numbers)
        metrics = Summarizer.metrics("mean", "std", "count", "numNonZeros").summary(F.col(vector))
        found = train.select(metrics.alias("s")).first().s
        spread, held = found.std.toArray(), found.numNonZeros.toArray()
        with np.errstate(divide="ignore"):
            self.scale = np.where(spread != 0, 1 / spread, 0.0)
        self.center = found.mean.toArray() * self.scale
        self.rows = found["count"]
        self.entries = int(held.sum()) + self.rows
        self.order = np.argsort(-held, kind="stable")
        self.place = np.empty(len(held), np.int32)
        self.place[self.order] = np.arange(len(held), dtype=np.int32)
        self.dense = int((held >= DENSE_SHARE * self.rows).sum())
        self.frame = train.select(
            F.lit(self.number).alias("number"), "label", F.unwrap_udt(F.col(vector)).alias("v")
        ).select("number", "label", "v.indices", "v.values")
        self.minimizers: dict[tuple, Minimizer] = {}

    @property
    def size(self) -> int:
        """Weights of a fit."""
        return len(self.scale) + 1

    def minimizer(self, label: int, reg_param: float, standardization: bool) -> Minimizer:
        """One per problem, so a fit goes on where one of a lower limit ended."""
        problem = label, reg_param, standardization
        if problem not in self.minimizers:
            self.minimizers[problem] = Minimizer(self, *problem)
        return self.minimizers[problem]

    def asked(self, requests: Sequence[tuple[int, np.ndarray]]) -> tuple:
        """Labels, weights and intercepts of the requests, by column as the blocks have them."""
        x = np.array([x for _, x in requests]).T
        weights = np.ascontiguousarray((x[:-1] * self.scale[:, None])[self.order])
        intercepts = x[-1] - self.center @ x[:-1]
        return np.array([float(label) for label, _ in requests]), weights, intercepts

    def answers(self, sums: np.ndarray) -> list[tuple[float, np.ndarray]]:
        gradients = np.empty((len(self.order) + 1, sums.shape[1]))
        gradients[self.order] = sums[:-2]
        gradients[:-1] *= self.scale[:, None]
        gradients[:-1] -= np.outer(self.center, sums[-2])
        gradients[-1] = sums[-2]
        gradients /= self.rows
        return [
            (float(loss) / self.rows, gradient)
            for loss, gradient in zip(sums[-1], np.ascontiguousarray(gradients.T))
        ]


def in_step(
    fits: Sequence[tuple[Fit, HingeRows]],
    most: int | None = None,
    after: Callable[[], None] = lambda: None,
) -> list:
    """What the fits return, in their order; each comes with the rows it is fitted to.

    ``most`` of them run at a time, and no more than whose weights fit into a job.
    ``after`` is called after every pass.
    """
    todo = deque(enumerate(fits))
    results: dict[int, object] = {}
    running: dict[int, tuple[Fit, int, tuple]] = {}
    passes = _Passes({rows.number: rows for _, rows in fits})

    def go_on(number, fit, size, answer=None):
        try:
            running[number] = fit, size, fit.send(answer)
        except StopIteration as end:
            running.pop(number, None)
            results[number] = end.value

    try:
        while todo or running:
            while todo and (
                not running
                or (most is None or len(running) < most)
                and sum(size for _, size, _ in running.values()) + todo[0][1][1].size
                <= WEIGHTS_IN_STEP
            ):
                number, (fit, rows) = todo.popleft()
                go_on(number, fit, rows.size)
            if running:
                asked = [(number, *running[number]) for number in sorted(running)]
                answers = passes.objectives([request for *_, request in asked])
                for (number, fit, size, _), answer in zip(asked, answers):
                    go_on(number, fit, size, answer)
            after()
    finally:
        passes.release()
    return [results[number] for number in sorted(results)]


class _Passes:
    """Jobs over the rows of some training sets, packed in blocks and kept in memory.

    Each part has rows of all sets, so that a job has one task a core if they are few.
    """

    def __init__(self, sets: dict[int, HingeRows]):
        self.sets, self.blocks, self.made = sets, None, 0
        if not sets:
            return
        entries = sum(rows.entries for rows in sets.values())
        cores = next(iter(sets.values())).context.defaultParallelism
        parts = max(1, min(cores, -(-entries // LEAST_ENTRIES)), -(-entries // MOST_ENTRIES))
        columns = {number: (rows.place, rows.dense) for number, rows in sets.items()}
        self.blocks = (
            reduce(DataFrame.unionByName, [rows.frame for rows in sets.values()])
            .repartition(parts)
            .mapInArrow(partial(_packed, columns), "number int, block binary")
            .rdd.map(_loaded)
            .persist(StorageLevel.MEMORY_AND_DISK)
        )

    def release(self) -> None:
        if self.blocks is not None:
            self.blocks.unpersist()

    def objectives(self, requests: Sequence[tuple]) -> list[list]:
        """Answers to the requests: to the first place of each, and to further ones as long
        as their weights fit into the job."""
        places = max(len(xs) for *_, xs in requests)
        flat, size = [], 0
        for ahead in range(places):
            for i, (rows, label, xs) in enumerate(requests):
                size += rows.size if ahead < len(xs) else 0
                if ahead < len(xs) and (not ahead or size <= WEIGHTS_IN_STEP):
                    flat.append((i, rows, label, xs[ahead]))
        answers: list[list] = [[] for _ in requests]
        for (i, *_), answer in zip(flat, self._pass([request[1:] for request in flat])):
            answers[i].append(answer)
        return answers

    def _pass(self, requests: Sequence[tuple[HingeRows, int, np.ndarray]]) -> list:
        if self.made % COLLECT_AFTER == 0:
            requests[0][0].context._jvm.System.gc()
        self.made += 1
        groups: dict[int, list[int]] = {}
        for i, (rows, _, _) in enumerate(requests):
            groups.setdefault(rows.number, []).append(i)
        asked = {
            number: self.sets[number].asked([requests[i][1:] for i in group])
            for number, group in groups.items()
        }
        sums = self.blocks.mapPartitions(partial(_pass, asked))
        if sums.getNumPartitions() > COLLECTED:
            total = sums.treeReduce(_added)
        else:
            total = reduce(_added, sums.collect())
        answers: list = [None] * len(requests)
        for number, group in groups.items():
            for i, answer in zip(group, self.sets[number].answers(total[number])):
                answers[i] = answer
        return answers


def _added(a: dict, b: dict) -> dict:
    return a | {number: a[number] + sums if number in a else sums for number, sums in b.items()}


def _loaded(row) -> tuple:
    return row.number, pickle.loads(row.block)


def _packed(
    columns: dict[int, tuple[np.ndarray, int]], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Blocks of the rows of each set, columns renamed to their places."""
    for batch in batches:
        numbers = batch.column("number").to_numpy()
        for number in np.unique(numbers).tolist():
            own = batch.filter(pa.array(numbers == number))
            for start in range(0, own.num_rows, BLOCK_ROWS):
                block = _block(*_entries(own.slice(start, BLOCK_ROWS), *columns[number]))
                packed = pickle.dumps(block, pickle.HIGHEST_PROTOCOL)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([packed], pa.binary())],
                    ["number", "block"],
                )


def _entries(rows: pa.RecordBatch, place: np.ndarray, dense: int) -> tuple:
    """Labels, entries per row, their columns by place, their values."""
    values, lists = rows.column("values"), rows.column("indices")
    lengths = np.diff(values.offsets.to_numpy())
    if lists.null_count:  # vectors with all their slots
        slots = [
            np.arange(n) if own is None else np.asarray(own, np.int64)
            for own, n in zip(lists.to_pylist(), lengths)
        ]
        slots = np.concatenate([np.empty(0, np.int64), *slots])
    else:
        slots = lists.flatten().to_numpy()
    labels = rows.column("label").to_numpy(zero_copy_only=False)
    return labels, lengths, place[slots], values.flatten().to_numpy(), dense


def _block(labels, lengths, columns, values, dense: int) -> tuple:
    """Labels, the dense columns' entries by place, the others by row and by column."""
    rows = np.repeat(np.arange(len(lengths)), lengths)
    often = columns < dense
    places = (rows[often] * dense + columns[often]).astype(np.int32)
    rare = rows[~often], columns[~often] - dense, values[~often]
    return (
        labels, dense, places, values[often],
        _layers(*rare), _layers(rare[1], rare[0], rare[2]),
    )


def _layers(groups, others, values) -> tuple:
    """Entries in layers: the first ones of all groups, the second ones, and so on.

    Groups of more entries come first, so a layer's groups are the first so many.
    """
    order = np.argsort(groups, kind="stable")
    keys, starts, counts = np.unique(groups[order], return_index=True, return_counts=True)
    by_size = np.argsort(-counts, kind="stable")
    place = np.empty(len(keys), np.int64)
    place[by_size] = np.arange(len(keys))
    rank = np.arange(len(order)) - np.repeat(starts, counts)
    order = order[np.lexsort((np.repeat(place, counts), rank))]
    return (
        keys[by_size], np.bincount(rank), others[order].astype(np.int32), np.ascontiguousarray(values[order]),
    )


def _add_rare(total: np.ndarray, layers: tuple, table: np.ndarray) -> None:
    """Add the products of the entries and their rows of ``table`` to the groups' rows."""
    keys, sizes, others, values = layers
    sums = np.zeros((len(keys), table.shape[1]))
    start = 0
    for size in sizes:
        end = start + size
        part = table[others[start:end]]
        part *= values[start:end, None]
        sums[:size] += part
        start = end
    total[keys] += sums


def _pass(asked: dict[int, tuple], blocks: Iterator[tuple[int, tuple]]) -> Iterator[dict]:
    """Sums over a part's rows: gradients by column, of the intercepts, losses."""
    sums: dict[int, np.ndarray] = {}
    for number, block in blocks:
        if number in asked:
            found = _hinge(block, *asked[number])
            sums[number] = sums[number] + found if number in sums else found
    yield sums


def _hinge(block: tuple, own: np.ndarray, weights: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    labels, dense, places, values, by_row, by_column = block
    matrix = np.zeros((len(labels), dense))
    matrix.ravel()[places] = values
    margins = matrix @ weights[:dense] + intercepts
    _add_rare(margins, by_row, weights[dense:])
    signs = np.where(labels[:, None] == own, 1.0, -1.0)
    margins *= signs
    losses = np.maximum(1.0 - margins, 0.0)
    signs[losses <= 0] = 0.0
    sums = np.zeros((len(weights) + 2, len(own)))
    sums[:dense] = matrix.T @ signs
    _add_rare(sums[dense:-2], by_column, signs)
    sums[-2] = signs.sum(axis=0)
    sums[:-1] *= -1.0
    sums[-1] = losses.sum(axis=0)
    return sums
