"""Embedding near-dedup by a forest of random-projection trees with spill overlap."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.llm.components import connected
from termscope.sources.storage import stored

TREES = 4
DEPTH = 24
SEED = 20260

#: Splits are placed by a sample of at most so many vectors, the ones with
#: the least hash of their id. Every vector is then indexed.
SAMPLE = 20_000

#: A node is split while it is expected to hold more vectors than this.
LEAF = 512

#: Least number of sampled vectors from which a cut is taken.
LEAST_SAMPLED = 16

#: Directions tried in a row before a node that no cut parts is left as a leaf.
MISSES = 3

#: Vectors this near to a split, along its direction, go to both sides. The projections
#: of two unit vectors of cosine 0.98 differ by 0.2 / sqrt(dimension) in the mean
#: square, 0.025 for 64 components; only pairs whose projections differ by twice the
#: margin can be parted, and then only if the split falls between them.
MARGIN_SIGMAS = 1.3

#: Leaves are compared in blocks of about so many vectors.
BLOCK = 1024

#: A leaf of more than so many times LEAF vectors is split again, by a sample of its own.
CROWDED = 4
LEAF_SAMPLE = 2000
MAX_ROUNDS = 12

_LEAF_BITS = 40


@dataclass
class Forest:
    """Split thresholds of all trees; one random direction for each level of a tree.

    ``roots`` maps (tree, label, dimension) to a node. A node has a threshold and two
    children, or children of -1 if it is a leaf.
    """

    roots: dict = field(default_factory=dict)
    cut: list = field(default_factory=list)
    low: list = field(default_factory=list)
    high: list = field(default_factory=list)
    level: list = field(default_factory=list)

    def node(self, level: int) -> int:
        self.cut.append(0.0)
        self.low.append(-1)
        self.high.append(-1)
        self.level.append(level)
        return len(self.cut) - 1


def directions(tree: int, dimension: int) -> np.ndarray:
    """The unit directions of a tree's levels, the same on every machine."""
    rng = np.random.default_rng([SEED, tree, dimension])
    found = rng.standard_normal((DEPTH, dimension))
    return found / np.linalg.norm(found, axis=1)[:, None]


def margin(dimension: int, cosine: float) -> float:
    return MARGIN_SIGMAS * np.sqrt(max(2 - 2 * cosine, 0.0) / dimension)


def _best_cut(at: np.ndarray, near: float) -> float | None:
    """The quantile of sorted projections that sends the fewest vectors both ways.

    None if each would send more than a third both ways, or all but a sixth one way:
    then a split multiplies vectors instead of parting them.
    """
    cuts = np.quantile(at, np.linspace(0.2, 0.8, 13))
    left = np.searchsorted(at, cuts + near, "right")
    right = len(at) - np.searchsorted(at, cuts - near, "right")
    useful = (left + right <= len(at) * 4 / 3) & (np.maximum(left, right) <= len(at) * 5 / 6)
    if not useful.any():
        return None
    return float(cuts[np.argmin(np.where(useful, left + right, 3 * len(at)))])


def _grow(forest: Forest, root: int, projected: np.ndarray, share: float, near: float) -> None:
    """Split a node and its children by the projections of the sampled vectors in it."""
    todo = [(root, np.arange(len(projected)), 0)]
    while todo:
        node, inside, missed = todo.pop()
        level = forest.level[node]
        if len(inside) < LEAST_SAMPLED or len(inside) <= LEAF * share or level >= DEPTH:
            continue
        at = np.sort(projected[inside, level])
        cut = _best_cut(at, near)
        if cut is None:
            # A dense cluster lies across each cut: try another direction.
            if missed < MISSES:
                only = forest.node(level + 1)
                forest.low[node] = forest.high[node] = only
                todo.append((only, inside, missed + 1))
            continue
        offset = projected[inside, level] - cut
        forest.cut[node] = cut
        forest.low[node], forest.high[node] = forest.node(level + 1), forest.node(level + 1)
        todo.append((forest.low[node], inside[offset <= near], 0))
        todo.append((forest.high[node], inside[offset > -near], 0))


def _fall(
    forest: dict, projected: np.ndarray, root: int, near: float
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the leaf nodes they reach from ``root``; a row may reach several."""
    rows, nodes = np.arange(len(projected)), np.full(len(projected), root)
    rows_out, nodes_out = [], []
    while len(rows):
        low, high = forest["low"][nodes], forest["high"][nodes]
        done = low < 0
        rows_out.append(rows[done])
        nodes_out.append(nodes[done])
        rows, nodes, low, high = rows[~done], nodes[~done], low[~done], high[~done]
        offset = projected[rows, forest["level"][nodes]] - forest["cut"][nodes]
        left = offset <= near
        right = (offset > -near) & (low != high)
        rows, nodes = (
            np.concatenate([rows[left | (low == high)], rows[right]]),
            np.concatenate([low[left | (low == high)], high[right]]),
        )
    return np.concatenate(rows_out), np.concatenate(nodes_out)


def fit_forest(labels: list, vectors: list[np.ndarray], share: float, cosine: float) -> Forest:
    """Split the sampled vectors of each label and dimension recursively.

    ``share`` is the part of all vectors that was sampled. Directions are random, cuts
    quantiles; both sides of a split keep the vectors within the margin, so a node's
    sample is what the node will hold.
    """
    forest = Forest()
    groups: dict = {}
    for i, (label, v) in enumerate(zip(labels, vectors)):
        groups.setdefault((label, len(v)), []).append(i)
    for (label, size), rows in groups.items():
        matrix = np.array([vectors[i] for i in rows])
        near = margin(size, cosine)
        for tree in range(TREES):
            projected = matrix @ directions(tree, size).T
            root = forest.node(0)
            forest.roots[(tree, label, size)] = root
            _grow(forest, root, projected, share, near)
    return forest


def leaves_of(forest: dict, label, matrix: np.ndarray, cosine: float) -> list[np.ndarray]:
    """The leaf ids, ascending, of each row of ``matrix``; all have one label."""
    count, size = matrix.shape
    near = margin(size, cosine)
    rows_out, ids_out = [], []
    for tree in range(TREES):
        root = forest["roots"].get((tree, label, size))
        if root is None:
            # A label without sampled vectors is a leaf of its own.
            rows_out.append(np.arange(count))
            ids_out.append(np.full(count, tree << _LEAF_BITS))
            continue
        projected = matrix @ directions(tree, size).T
        rows, nodes = _fall(forest, projected, root, near)
        rows_out.append(rows)
        ids_out.append((tree << _LEAF_BITS) + 1 + nodes)
    rows, ids = np.concatenate(rows_out), np.concatenate(ids_out)
    order = np.lexsort((ids, rows))
    rows, ids = rows[order], ids[order]
    return np.split(ids, np.searchsorted(rows, np.arange(1, count)))


def _usable(rows: DataFrame) -> DataFrame:
    """``(vec_id, label, v)`` of the rows whose vector can be compared."""
    values = F.col("embedding").cast("array<double>")
    clean = rows.select("vec_id", "label", values.alias("v")).where(
        "vec_id is not null and label is not null and v is not null"
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return clean.where(finite & F.exists("v", lambda x: x != 0))


def _with_units(distinct: DataFrame) -> DataFrame:
    """``(label, rep, copies, unit)`` of distinct vectors ``v``."""

    def scale(batches):
        for batch in batches:
            units = []
            for v in batch.column("v"):
                v = np.array(v.as_py())
                v = v / np.abs(v).max()
                units.append(v / np.linalg.norm(v))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("label", "rep", "copies")]
                + [pa.array(units, pa.list_(pa.float64()))],
                ["label", "rep", "copies", "unit"],
            )

    kind = distinct.schema["label"].dataType.simpleString()
    return distinct.mapInArrow(
        scale, f"label {kind}, rep bigint, copies bigint, unit array<double>"
    )


def _vectors(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    """The vectors of an Arrow column of lists, without a Python number for each component."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _refined(indexed: DataFrame, tried: DataFrame | None, cosine: float, turn: int):
    """``indexed`` with crowded leaves split again, and the leaves that were tried so far.

    None if no leaf that was not tried before holds more than ``CROWDED * LEAF`` vectors.
    Each such leaf grows a tree from a sample of its own on an executor, with directions
    no tree had before; its vectors fall through it in blocks. So leaves are bounded for
    any number of vectors, but for clusters that no cut parts.
    """
    keys = ["label", "d", "leaf"]
    member = indexed.select("label", F.size("unit").alias("d"), "rep", F.explode("leaves").alias("leaf"))
    crowded = member.groupBy(*keys).count().where(F.col("count") > CROWDED * LEAF)
    if tried is not None:
        crowded = crowded.join(tried, keys, "left_anti")
    crowded = stored(crowded, "crowded")
    if crowded.isEmpty():
        return None
    kind = indexed.schema["label"].dataType.simpleString()
    whole = indexed.select(
        "label", F.size("unit").alias("d"), "rep", "unit", F.explode("leaves").alias("leaf")
    ).join(crowded, keys)
    chance = F.pmod(F.xxhash64("rep", F.lit(turn)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = whole.where(chance < F.lit(float(LEAF_SAMPLE)) / F.col("count"))

    def fit(key, table):
        label, size, leaf = key
        matrix = np.array(_vectors(table.column("unit")))
        share = len(matrix) / table.column("count")[0].as_py()
        forest = Forest()
        own = directions(TREES * turn + (leaf.as_py() >> _LEAF_BITS) % TREES, size.as_py())
        _grow(forest, forest.node(0), matrix @ own.T, share, margin(size.as_py(), cosine))
        return pa.table(
            {
                "label": [label], "d": [size], "leaf": [leaf],
                "cut": pa.array([forest.cut], pa.list_(pa.float64())),
                **{n: pa.array([getattr(forest, n)], pa.list_(pa.int64())) for n in ("low", "high", "level")},
            }
        )

    node = "cut array<double>, low array<bigint>, high array<bigint>, level array<bigint>"
    grown = sample.groupBy(*keys).applyInArrow(fit, f"label {kind}, d int, leaf bigint, {node}")
    grown = stored(grown.where("size(cut) > 1"), "grown")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    rows = whole.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int")).drop("count")
    trees = grown.join(crowded, keys).withColumn(
        "block", F.explode(F.sequence(F.lit(0), blocks - 1))
    ).drop("count")

    def place(key, left, right):
        _, size, leaf, _ = (k.as_py() for k in key)
        shape = {"rep": pa.int64(), "leaf": pa.int64(), "own": pa.int64()}
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], t) for n, t in shape.items()})
        forest = {n: np.array(right.column(n)[0].as_py()) for n in ("cut", "low", "high", "level")}
        matrix = np.array(_vectors(left.column("unit")))
        own = directions(TREES * turn + (leaf >> _LEAF_BITS) % TREES, size)
        at, nodes = _fall(forest, matrix @ own.T, 0, margin(size, cosine))
        ids = left.column("rep").to_numpy()[at]
        return pa.table({"rep": ids, "leaf": np.full(len(at), leaf), "own": nodes})

    both = [*keys, "block"]
    placed = rows.groupBy(*both).cogroup(trees.groupBy(*both)).applyInArrow(
        place, "rep bigint, leaf bigint, own bigint"
    )
    # The tree's number stays in the upper bits, the rest tells leaves apart.
    low = F.xxhash64("leaf", "own").bitwiseAND(F.lit((1 << _LEAF_BITS) - 1))
    number = F.shiftleft(F.shiftright("leaf", _LEAF_BITS), _LEAF_BITS).bitwiseOR(low)
    moved = placed.groupBy("rep").agg(
        F.collect_set("leaf").alias("gone"), F.collect_set(number).alias("come")
    )
    again = F.array_sort(F.array_union(F.array_except("leaves", "gone"), "come"))
    leaves = F.when(F.col("gone").isNull(), F.col("leaves")).otherwise(again)
    found = indexed.join(moved, "rep", "left").withColumn("leaves", leaves).select(*indexed.columns)
    done = crowded.select(*keys)
    return stored(found, "indexed"), done if tried is None else tried.unionByName(done)


def _indexed(units: DataFrame, cosine: float) -> DataFrame:
    """``units`` with ``leaves``, the ascending ids of the leaves of each."""
    total = units.count()
    sample = units.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("label", "unit").toArrow()
    forest = fit_forest(
        sample.column("label").to_pylist(),
        _vectors(sample.column("unit")),
        sample.num_rows / max(total, 1),
        cosine,
    )
    sent = units.sparkSession.sparkContext.broadcast(
        {
            "roots": forest.roots,
            "cut": np.array(forest.cut),
            "low": np.array(forest.low, np.int64),
            "high": np.array(forest.high, np.int64),
            "level": np.array(forest.level, np.int64),
        }
    )

    def place(batches):
        for batch in batches:
            labels = batch.column("label").to_pylist()
            units = [np.array(u) for u in batch.column("unit").to_pylist()]
            groups: dict = {}
            for i, (label, u) in enumerate(zip(labels, units)):
                groups.setdefault((label, len(u)), []).append(i)
            leaves: list = [None] * len(labels)
            for (label, _), rows in groups.items():
                matrix = np.array([units[i] for i in rows])
                for i, own in zip(rows, leaves_of(sent.value, label, matrix, cosine)):
                    leaves[i] = own
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaves, pa.list_(pa.int64()))],
                [*batch.schema.names, "leaves"],
            )

    shape = ", ".join(f"{n} {t}" for n, t in units.dtypes)
    return units.mapInArrow(place, f"{shape}, leaves array<bigint>")


def _first_common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least id that both rows of padded lists hold, pair by pair."""
    out = np.empty(len(left), np.int64)
    for a in range(0, len(left), 4096):
        x, y = left[a : a + 4096], right[a : a + 4096]
        same = (x[:, :, None] == y[:, None, :]).any(axis=2) & (x >= 0)
        out[a : a + 4096] = x[np.arange(len(x)), same.argmax(axis=1)]
    return out


def _block_links(table: pa.Table, leaf: int, crossed: bool, cosine: float) -> pa.Table:
    """Links of one block with itself, or of two blocks with each other.

    Each vector gets the number of vectors linked here and nowhere before, and the
    least id among those it is connected with here.
    """
    ids = table.column("rep").to_numpy()
    copies = table.column("copies").to_numpy()
    unit = np.array(table.column("unit").to_pylist())
    lists = table.column("leaves").to_pylist()
    leaves = np.full((len(lists), max(map(len, lists))), -1, np.int64)
    for i, own in enumerate(lists):
        leaves[i, : len(own)] = own
    side = table.column("side").to_numpy()
    a = np.flatnonzero(side == 0)
    b = np.flatnonzero(side == 1) if crossed else a
    counts = np.zeros(len(ids), np.int64)
    froms, tos = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in range(0, len(a), 256):
        if not len(b):
            break
        x, y = np.nonzero(unit[a[start : start + 256]] @ unit[b].T >= cosine)
        i, j = a[start + x], b[y]
        if not crossed:
            i, j = i[i < j], j[i < j]
        froms.append(i)
        tos.append(j)
    i, j = np.concatenate(froms), np.concatenate(tos)
    new = _first_common(leaves[i], leaves[j]) == leaf
    np.add.at(counts, i[new], copies[j[new]])
    np.add.at(counts, j[new], copies[i[new]])
    root = ids.copy()
    while len(i):
        least = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        if (root == before).all():
            break
    met = (counts > 0) | (root != ids)
    return pa.table({"rep": ids[met], "n": counts[met], "root": root[met]})


def _links(indexed: DataFrame, cosine: float) -> DataFrame:
    """``(rep, n, root)`` of all blocks of all leaves."""
    rows = indexed.select(
        "label", F.size("unit").alias("d"), "rep", "copies", "unit", "leaves",
        F.explode("leaves").alias("leaf"),
    )
    sizes = (
        indexed.select("label", F.size("unit").alias("d"), F.explode("leaves").alias("leaf"))
        .groupBy("label", "d", "leaf")
        .count()
        .where("count > 1")
        .withColumn("blocks", F.ceil(F.col("count") / BLOCK))
        .drop("count")
    )
    rows = rows.join(sizes, ["label", "d", "leaf"]).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks"))
    )
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks").cast("int") - 1),
        lambda other: F.struct(
            F.least(F.col("block"), other).cast("int").alias("x"),
            F.greatest(F.col("block"), other).cast("int").alias("y"),
        ),
    )
    rows = rows.withColumn("pair", F.explode(pairs)).select(
        "label", "d", "leaf", F.col("pair.x").alias("x"), F.col("pair.y").alias("y"),
        "rep", "copies", "unit", "leaves",
        (F.col("block") != F.col("pair.x")).cast("int").alias("side"),
    )

    def compare(key, table):
        _, _, leaf, x, y = (k.as_py() for k in key)
        return _block_links(table, leaf, x != y, cosine)

    return rows.groupBy("label", "d", "leaf", "x", "y").applyInArrow(
        compare, "rep bigint, n bigint, root bigint"
    )


def near_vectors(rows: DataFrame, cosine: float = 0.98) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``rows``.

    Vectors of one label and one length are linked when their cosine, in double
    precision, is ``cosine`` or more. ``n_links`` counts the other vectors linked
    directly, ``component_id`` is the least vec_id reachable, ``kept`` whether that is
    the vector itself.

    Equal vectors of a label are one vector with copies. The others are put into the
    leaves of ``TREES`` trees of random splits; leaves are compared whole, in blocks, so
    each candidate pair is verified, and a pair that several leaves hold is counted in
    the first. Trees are grown from a sample of all vectors, and leaves that hold too many
    from samples of their own, round by round. No pairs leave a task, only counts and each vector's least connection.
    Blocks of a large leaf meet two by two in tasks of their own.

    Vectors that are null, zero, or have a null or non-finite component, and rows with
    a null label or vec_id, link with nothing and are components of their own. Rows
    that share a vec_id are counted as copies of one another if equal, so ids should be
    unique. Columns other than vec_id, embedding and label are not looked at.
    """
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", "label")
    usable = _usable(rows)
    distinct = stored(
        usable.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")),
        "vectors",
    )
    indexed, tried = stored(_indexed(_with_units(distinct), cosine), "indexed"), None
    for turn in range(1, MAX_ROUNDS):
        refined = _refined(indexed, tried, cosine, turn)
        if refined is None:
            break
        indexed, tried = refined
    links = stored(_links(indexed, cosine), "links")
    counts = links.groupBy("rep").agg(F.sum("n").alias("n"))
    edges = links.where("root <> rep").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    named = connected(edges.distinct())
    reps = (
        distinct.join(counts, "rep", "left")
        .join(named.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "label",
            "v",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component_id", "rep").alias("component"),
        )
    )
    found = usable.join(reps, ["label", "v"]).select(
        F.col("vec_id").alias("found_id"), "links", "component"
    ).distinct()
    return (
        rows.select("vec_id")
        .join(found, F.col("vec_id") == F.col("found_id"), "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
