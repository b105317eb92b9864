"""N-gram Jaccard join: a grouped prefix join over sets of word shingles."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.llm.arrays import FOLD, U64, mix, parts, shingle_hashes, signed
from termscope.llm.bits import hashed_ids, id_bits
from termscope.llm.components import connected
from termscope.sources.storage import scratch, stored

#: Shingles share so many buckets, whatever the size of the corpus: rarity only orders
#: the prefixes, so a coarse one costs time, never a pair.
RARITY_BITS = 24
_LOW_BITS = 12

#: Shingles that a task holds before it hands their counts on.
HELD = 1 << 20

#: 64-bit parts of a set's sketch.
SKETCH = 8

#: Steps of rarity per doubling of a shingle's documents; 255 is the last step.
STEPS = 8

_SHAPE = (
    "doc_id bigint, size int, digest binary, fp bigint, tokens array<bigint>, sketch array<bigint>"
)


_SKETCH_SEED = U64(0xC2B2AE3D27D4EB4F)


def _sets(batches, words):
    """``(batch, distinct shingles of each text, digest of each text's words)``."""
    for batch, data, offsets in parts(batches, "text"):
        hashes, first = shingle_hashes(data, offsets, words)
        digests = [
            blake2b(b" ".join(data[a:b].tobytes().translate(FOLD).split()), digest_size=32).digest()
            for a, b in zip(offsets[:-1], offsets[1:])
        ]
        yield batch, [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])], digests


def shingle_rarity(docs: DataFrame, words: int) -> np.ndarray:
    """Per bucket of shingles: how frequent its most frequent one is, in steps; 0 if all are unique.

    Each shingle is counted by itself. Sums over a bucket would grow with the corpus
    until no shingle of a few documents could be told from one that is unique. Shingles
    travel as sorted arrays, one per range of buckets, and a range is counted at a time.
    """
    low_bits = min(_LOW_BITS, RARITY_BITS)
    shift = U64(64 - RARITY_BITS)

    def block(held):
        tokens, n = np.unique(np.concatenate(held), return_counts=True)
        high = ((tokens >> shift) >> U64(low_bits)).astype(np.int64)
        at = np.flatnonzero(np.append(True, high[1:] != high[:-1]))
        ends = np.append(at, len(tokens)).astype(np.int32)
        columns = [
            pa.Array.from_buffers(
                pa.binary(),
                len(at),
                [None, pa.py_buffer(ends * values.itemsize), pa.py_buffer(values.tobytes())],
            )
            for values in (tokens, n.astype(np.uint32))
        ]
        return pa.RecordBatch.from_arrays([pa.array(high[at]), *columns], ["high", "tokens", "n"])

    def counts(batches):
        held, count = [], 0
        for _, sets, _ in _sets(batches, words):
            held += sets
            count += sum(map(len, sets))
            if count >= HELD:
                yield block(held)
                held, count = [], 0
        if count:
            yield block(held)

    def steps(high, tokens, n):
        each, place = np.unique(np.concatenate(tokens), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(n))
        step = np.minimum(np.rint(STEPS * np.log2(total)), 255).astype(np.uint8)
        table = np.zeros(1 << low_bits, np.uint8)
        np.maximum.at(table, ((each >> shift) & U64((1 << low_bits) - 1)).astype(np.int64), step)
        return pa.RecordBatch.from_arrays(
            [pa.array([high]), pa.array([table.tobytes()], pa.binary())], ["high", "steps"]
        )

    def counted(batches):
        own, tokens, n = None, [], []
        for batch in batches:
            for high, some, times in zip(*(c.to_pylist() for c in batch.columns)):
                if high != own and tokens:
                    yield steps(own, tokens, n)
                    tokens, n = [], []
                own = high
                tokens.append(np.frombuffer(some, U64))
                n.append(np.frombuffer(times, np.uint32))
        if tokens:
            yield steps(own, tokens, n)

    ranges = (
        docs.select("text")
        .mapInArrow(counts, "high bigint, tokens binary, n binary")
        .repartition("high")
        .sortWithinPartitions("high")
        .mapInArrow(counted, "high bigint, steps binary")
    )
    total = np.zeros((1 << (RARITY_BITS - low_bits), 1 << low_bits), np.uint8)
    with scratch(clean=True):
        for row in stored(ranges, "rarity").collect():
            total[row["high"]] = np.frombuffer(row["steps"], np.uint8)
    return total.reshape(-1)


def _sketch(tokens: np.ndarray) -> np.ndarray:
    """Bits that say of how many shingles, odd or even, a set has that fall on each.

    Two sketches differ in no more bits than their sets differ in shingles.
    """
    place = (mix(tokens ^ _SKETCH_SEED) % U64(64 * SKETCH)).astype(np.int64)
    odd = np.bincount(place, minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefixes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Per document: set size, digest of its words, fingerprint of the prefix, it, a sketch.

    The prefix holds the rarest ``n - ceil(t n) + 1`` shingles; two sets of Jaccard
    similarity t or more have one of them in common.
    """
    steps = docs.sparkSession.sparkContext.broadcast(shingle_rarity(docs, words))
    shift = U64(64 - RARITY_BITS)

    def shape(batches):
        rarity = steps.value
        for batch, sets, digests in _sets(batches, words):
            sizes = np.array([len(s) for s in sets], np.int32)
            prints = np.zeros(len(sets), U64)
            tokens = []
            for i, s in enumerate(sets):
                n = len(s)
                keep = n - (percent * n + 99) // 100 + 1 if n else 0
                order = np.lexsort((s, rarity[(s >> shift).astype(np.int64)]))
                rare = s[order[:keep]]
                prints[i] = mix(rare).sum(dtype=U64)
                tokens.append(rare)
            prints = mix(prints + sizes.astype(U64))
            lengths = np.array([0, *(len(t) for t in tokens)])
            joined = np.concatenate(tokens) if tokens else np.zeros(0, U64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum(lengths), pa.int32()), pa.array(signed(joined))
            )
            sketches = np.concatenate([np.zeros(0, np.int64), *map(_sketch, sets)])
            sketch = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sets) + 1) * SKETCH, pa.int32()), pa.array(sketches)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array(digests, pa.binary()),
                    pa.array(signed(prints)),
                    lists,
                    sketch,
                ],
                ["doc_id", "size", "digest", "fp", "tokens", "sketch"],
            )

    return docs.select("doc_id", "text").mapInArrow(shape, _SHAPE)


def _listed(rows: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """The rows whose id may be in ``listed``, as a bit map of fixed size tells."""
    bits = id_bits(listed, column)

    def near(batches):
        for batch in batches:
            yield batch.filter(pa.array(hashed_ids(batch.column(column), bits.value)))

    return rows.mapInArrow(near, rows.schema)


def _promising(shaped: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose prefixes have enough in common.

    What two sets share beyond their common prefix tokens lies in the rest of the one
    whose prefix ends earlier, so it is at most the larger rest.
    """

    def side(column: str) -> DataFrame:
        rows = shaped.select(
            F.col("doc_id").alias(column),
            F.col("size").alias(f"{column}_size"),
            F.col("tokens").alias(f"{column}_tokens"),
        )
        return _listed(rows, pairs, column).dropDuplicates([column])

    both = pairs.join(side("b"), "b").join(side("a"), "a")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    rest = F.greatest(*(F.col(f"{c}_size") - F.size(f"{c}_tokens") for c in "ab"))
    total = F.col("a_size") + F.col("b_size")
    return both.where((shared + rest) * (100 + percent) >= percent * total).select("a", "b")


def _text_shingles(text: bytes, size: int) -> set[tuple[bytes, ...]]:
    """The distinct shingles of a text, as tuples of its words."""
    words = text.translate(FOLD).split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size))))


def _verified(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets are similar enough, shingles compared as text.

    Only the texts of documents in some pair travel. Which these are is first told
    from a bit map of fixed size, then exactly by the joins. The last join sorts by a, so
    the set of an a that many pairs have is mostly made once.
    """

    def side(column: str) -> DataFrame:
        rows = docs.select(F.col("doc_id").alias(column), F.col("text").alias(f"{column}_text"))
        return _listed(rows, pairs, column)

    def similar(batches):
        known, items = None, set()
        for batch in batches:
            ids = batch.column("a").to_pylist()
            keep = []
            for i, first, second in zip(ids, batch.column("a_text"), batch.column("b_text")):
                first = first.as_buffer()
                if known is None or i != known[0] or not first.equals(known[1]):
                    known, items = (i, first), _text_shingles(first.to_pybytes(), words)
                others = _text_shingles(second.as_buffer().to_pybytes(), words)
                shared = len(items & others)
                keep.append(100 * shared >= percent * (len(items) + len(others) - shared))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    # No distinct here: it would hold the pairs of a hot id in one task.
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    rows = both.select("a", "b", "a_text", "b_text").where("a_text is not null and b_text is not null")
    return rows.mapInArrow(similar, "a bigint, b bigint")


def _may_link(percent: int):
    """Length and positional bounds on a pair of prefix entries l and r."""
    fewest = F.ceil(percent * (F.col("l.size") + F.col("r.size")) / F.lit(100.0 + percent))
    rest = F.least(F.col("l.size") - F.col("l.pos"), F.col("r.size") - F.col("r.pos"))
    return (
        (100 * F.col("l.size") >= percent * F.col("r.size"))
        & (100 * F.col("r.size") >= percent * F.col("l.size"))
        & (rest >= fewest)
    )


def _may_be_near(percent: int):
    """Whether the sketches of whole sets l and r differ in few enough bits."""
    differ = sum(
        (F.bit_count(F.get("l.sketch", F.lit(i)).bitwiseXOR(F.get("r.sketch", F.lit(i)))) for i in range(SKETCH)),
        F.lit(0),
    )
    return differ * (100 + percent) <= (100 - percent) * (F.col("l.size") + F.col("r.size"))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row for each row of ``docs``.

    Documents are linked when the Jaccard similarity of their sets of ``words``-word
    shingles is at least ``percent`` / 100; the component is the least doc_id
    reachable. Words are runs of anything but ASCII white space, with A-Z folded.

    1. Shingles are ordered by rarity over all documents; each document keeps its
       necessary prefix. Documents with equal prefix and size become one group, those
       with the same words one class of the group.
    2. Groups that share a prefix token meet, and the classes of a group at its first
       token. The token's first group is the one with
       the fewest rarer tokens. Each group is compared with one first group, the one
       it meets most often, so a group of near copies makes as many pairs as members.
    3. Members that are still in another component than that of their token's first
       group are compared with all the entries of the token which the length and
       positional bounds leave. Pairs within a component need no test: they change
       nothing. So every similar pair is verified or known to be connected.

    Null or empty texts and texts without words have size 0 and stand alone. Rows that
    share a doc_id are one document and should be equal; a null doc_id has a null
    component. Shingles are hashed to find and prune pairs, and a pair is linked by its
    shingles as text; a class is told by a cryptographic digest of its words. Columns
    other than doc_id and text are not looked at. Plans several jobs, which run when the
    function is called.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    shaped = stored(_prefixes(docs, words, percent), "prefixes")
    keyed = shaped.where("size > 0 and doc_id is not null")
    classes = stored(
        keyed.groupBy("digest", "size", "fp").agg(
            F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")
        ),
        "classes",
    )
    leads = classes.groupBy("fp", "size").agg(
        F.min("rep").alias("gid"), F.count("*").alias("classes")
    )
    member = stored(classes.join(leads, ["fp", "size"]).select("rep", "gid", "sketch"), "members")
    entries = (
        keyed.select("doc_id", "size", "tokens")
        .join(leads.select(F.col("gid").alias("doc_id"), "classes"), "doc_id")
        .dropDuplicates(["doc_id"])
        .select(
            F.col("doc_id").alias("gid"),
            "size",
            "classes",
            F.posexplode("tokens").alias("pos", "token"),
        )
    )
    # Members of one group meet at their first token, which other groups may not have.
    shared = (
        entries.groupBy("token")
        .agg(F.count("*").alias("n"), F.max(F.expr("pos = 0 and classes > 1")).alias("inside"))
        .where("n > 1 or inside")
    )
    entries = entries.drop("classes").join(shared.select("token"), "token")
    entries = stored(entries, "entries")
    firsts = entries.groupBy("token").agg(F.min(F.struct("pos", "gid", "size")).alias("f"))
    hubs = firsts.select("token", "f.pos", "f.gid", "f.size")
    met = entries.alias("l").join(hubs.alias("r"), "token").where(_may_link(percent))
    near = met.where("l.gid <> r.gid").select(F.col("r.gid").alias("a"), F.col("l.gid").alias("b"))
    best = near.groupBy("a", "b").count().groupBy("b").agg(F.max(F.struct("count", "a")).alias("m"))
    near = best.select("m.a", "b")
    within = member.where("rep <> gid").select(F.col("gid").alias("a"), F.col("rep").alias("b"))
    pairs = stored(near.union(within).distinct(), "met")
    pairs = stored(_promising(shaped, pairs, percent), "pairs")
    links = stored(_verified(docs, pairs, words, percent), "links")

    known = stored(connected(links), "components")
    placed = (
        entries.join(member, "gid")
        .join(known.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "token", "rep", "size", "pos", "sketch", F.coalesce("component_id", "rep").alias("c")
        )
    )
    mixed = (
        placed.groupBy("token")
        .agg(F.min(F.struct("pos", "rep", "c")).alias("f"), F.min("c").alias("p"), F.max("c").alias("q"))
        .where("p <> q")
        .select("token", F.col("f.c").alias("main"))
    )
    placed = stored(placed.join(mixed, "token"), "placed")
    others = placed.where("c <> main")
    found = (
        others.alias("l")
        .join(
            placed.alias("r"),
            (F.col("l.token") == F.col("r.token"))
            & (F.col("l.c") != F.col("r.c"))
            & _may_link(percent)
            & _may_be_near(percent),
        )
        .select(
            F.least("l.rep", "r.rep").alias("a"),
            F.greatest("l.rep", "r.rep").alias("b"),
        )
        .distinct()
    )
    tried = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = stored(found, "found")
    more = _promising(shaped, found, percent).join(tried, ["a", "b"], "left_anti")
    more = stored(more, "pairs")
    links = links.union(_verified(docs, more, words, percent))

    named = connected(links).withColumnRenamed("id", "rep")
    reps = classes.join(named, "rep", "left").select(
        "digest", "size", F.coalesce("component_id", "rep").alias("component_id")
    )
    return (
        shaped.select("doc_id", "size", "digest")
        .join(reps, ["digest", "size"], "left")
        .select(
            "doc_id",
            F.col("size").cast("bigint").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias(
                "component_id"
            ),
        )
    )


def near_duplicates_removed(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document has the least doc_id of its component.

    All columns stay. Rows with a null doc_id belong to no group and stay.
    """
    found = jaccard_components(docs, words, percent)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
