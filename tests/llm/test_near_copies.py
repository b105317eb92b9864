import random

import llm_definitions as brute
import numpy as np
import pyarrow as pa
import pytest

from llm_fixtures import documents  # noqa: F401
from termscope.llm import embeddings, jaccard
from termscope.llm.components import connected


def _near_copies(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = {}
    for _ in range(6):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice((6, 30, 90)))]
        for _ in range(25):
            words = list(base)
            for _ in range(rnd.choice((0, 0, 1, 1, 2, 5))):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary).upper()
            docs[len(docs)] = " \n".join(words)
    common = " ".join(vocabulary[:12])
    for _ in range(40):
        docs[len(docs)] = common + " " + " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 6)))
    for text in (None, "", "  ", "one", "One", "one two", "one two three four"):
        docs[len(docs)] = text
    return docs


@pytest.mark.parametrize("words, percent, seed", [(4, 85, 1), (5, 80, 2)])
def test_jaccard_components(documents, words, percent, seed):
    docs = _near_copies(seed)
    rows = jaccard.jaccard_components(documents(docs), words, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.jaccard(
        docs, words, percent
    )


@pytest.mark.parametrize("bits", [2, 3, 4])
def test_members_of_a_group_are_linked_without_their_lead(documents, monkeypatch, bits):
    """Chains of texts of equal size that share a prefix no other group has."""
    monkeypatch.setattr(jaccard, "RARITY_BITS", bits)
    rnd = random.Random(bits)
    docs = {}
    for chain in range(12):
        words = [f"c{chain}w{i}" for i in range(60)]
        texts = []
        for step in range(10):
            texts.append(" ".join(words))
            words[rnd.randrange(60)] = f"c{chain}s{step}"
        rnd.shuffle(texts)
        for text in texts:
            docs[len(docs)] = text
    rows = jaccard.jaccard_components(documents(docs), 1, 90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.jaccard(docs, 1, 90)


def test_shingles_of_few_documents_are_told_from_unique_ones(documents, monkeypatch):
    """However many unique ones share their bucket."""
    monkeypatch.setattr(jaccard, "RARITY_BITS", 6)
    monkeypatch.setattr(jaccard, "HELD", 300)
    docs = [(i, " ".join(["hot" if i < 40 else "cold", *(f"w{i}x{k}" for k in range(50))])) for i in range(60)]
    steps = jaccard.shingle_rarity(documents(docs), 1)
    (_, (hot, cold), _), = jaccard._sets([pa.RecordBatch.from_pydict({"text": ["hot", "cold"]})], 1)
    buckets = [int(t[0]) >> 58 for t in (hot, cold)]
    assert [int(steps[b]) for b in buckets] == [round(8 * np.log2(n)) for n in (40, 20)]
    assert np.count_nonzero(steps) == 2 and len(steps) == 64


def test_sketches_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(3)
    for size in (0, 1, 30, 700):
        for changed in (0, 1, 10, 200):
            a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            b = np.unique(np.append(a[changed:], rng.integers(0, 1 << 63, changed).astype(np.uint64)))
            differ = jaccard._sketch(a) ^ jaccard._sketch(b)
            bits = sum(bin(int(x) & (2**64 - 1)).count("1") for x in differ)
            assert bits <= len(np.setxor1d(a, b)) and (bits > 0) == (len(np.setxor1d(a, b)) > 0)


def test_one_document_of_each_group_stays_with_its_columns(documents):
    text = " ".join(f"t{i}" for i in range(30))
    df = documents([(3, text), (1, text + " end"), (2, "other"), (4, None), (None, text)])
    kept = jaccard.near_duplicates_removed(df)
    assert sorted(kept.columns) == sorted(df.columns)
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 2, 4]


def test_jaccard_of_repeated_rows_and_of_nothing(documents):
    rows = [(7, "a b c d e"), (7, "a b c d e"), (9, "A b c d e")]
    found = jaccard.jaccard_components(documents(rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(7, 7), (7, 7), (9, 7)]
    assert jaccard.jaccard_components(documents([])).collect() == []


def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)]
    edges += [(5, 5), (None, 3), (900, 700), (700, 800), (800, 900)]
    rnd.shuffle(edges)
    groups = brute.Groups({i for e in edges for i in e if None not in e})
    for a, b in edges:
        if a is not None:
            groups.link(a, b)
    found = connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.id: r.component_id for r in found} == {i: groups.root(i) for i in groups.up}


def _vectors(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        for _ in range(12):
            base = rng.normal(size=16)
            for _ in range(rng.integers(1, 30)):
                rows.append((base + rng.normal(size=16) * rng.choice([0, 0.02, 0.04, 0.08]), label))
    return [(i, [float(x) for x in np.float32(v)], label) for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("sample", [20_000, 60])
def test_vectors_equal_brute_force(spark, monkeypatch, sample):
    """Also with a sample so small that most leaves have to be split again."""
    for name, value in (
        ("LEAF", 40), ("LEAST_SAMPLED", 4), ("BLOCK", 30), ("SAMPLE", sample), ("CROWDED", 2), ("LEAF_SAMPLE", 60)
    ):
        monkeypatch.setattr(embeddings, name, value)
    rows = _vectors(1)
    matrix = np.array([v for _, v, _ in rows])
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    labels = np.array([label for _, _, label in rows])
    linked = (matrix @ matrix.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    groups = brute.Groups(range(len(rows)))
    for a, b in zip(*np.nonzero(linked)):
        groups.link(int(a), int(b))
    odd = [
        (1000, None, 0), (1001, [0.0] * 16, 0), (1002, [1.0, None] * 8, 0),
        (1003, [float("nan")] * 16, 0), (1004, rows[0][1], None), (1005, [1.0, 2.0], 0),
        (1006, [2.0, 4.0], 0), (None, rows[0][1], 0),
    ]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>, label int")
    found = {r.vec_id: r for r in embeddings.near_vectors(df.selectExpr("*", "1 rep")).collect()}
    assert len(found) == len(rows) + len(odd)
    exact = sum(found[i].n_links == linked[i].sum() for i in range(len(rows)))
    assert exact >= 0.99 * len(rows)
    assert sum(found[i].n_links for i in range(len(rows))) <= linked.sum()
    assert all(found[i].component_id == groups.root(i) for i in range(len(rows)))
    assert all(found[i].kept == (groups.root(i) == i) for i in range(len(rows)))
    assert (found[1005].n_links, found[1006].component_id) == (1, 1005)
    for i in (1000, 1001, 1002, 1003, 1004):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)


def test_vectors_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert embeddings.near_vectors(df).collect() == []


def test_leaves_stay_small_whatever_the_sample(spark, monkeypatch):
    """Comparisons per vector do not grow with the vectors that the first sample stands for."""
    for name, value in (("LEAF", 64), ("SAMPLE", 100), ("LEAF_SAMPLE", 300)):
        monkeypatch.setattr(embeddings, name, value)
    rng = np.random.default_rng(2)
    sizes, found = [], []
    for n in (600, 2400):
        base = rng.standard_normal((n, 32))
        near = base[: n // 10] + 0.02 * rng.standard_normal((n // 10, 32))
        rows = [(i, v.tolist(), 1) for i, v in enumerate(np.vstack([base, near]))]
        df = spark.createDataFrame(rows, "rep bigint, v array<double>, label int")
        units = embeddings._with_units(df.selectExpr("label", "v", "rep", "1L AS copies"))
        indexed, tried = embeddings._indexed(units, 0.98), None
        for turn in range(1, embeddings.MAX_ROUNDS):
            refined = embeddings._refined(indexed, tried, 0.98, turn)
            if refined is None:
                break
            indexed, tried = refined
        rows = {r.rep: set(r.leaves) for r in indexed.select("rep", "leaves").collect()}
        counts = {}
        for own in rows.values():
            for leaf in own:
                counts[leaf] = counts.get(leaf, 0) + 1
        sizes.append(max(counts.values()))
        found.append(np.mean([bool(rows[i] & rows[n + i]) for i in range(n // 10)]))
    assert max(sizes) <= embeddings.CROWDED * 64 and min(found) >= 0.95
