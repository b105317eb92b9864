import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from termscope.llm import exact, merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _texts(seed, n=300):
    rnd = random.Random(seed)
    base = [None, "", " \n", "a b", "ab", "a\tb\n", "é è", "x" * 200_000, "x y" * 50_000]
    return [
        (i, rnd.choice(base), rnd.choice((None, "en", "")), rnd.choice((None, "", "web", "web", "web", "bücher")), i % 3)
        for i in range(n)
    ]


def _copies(rows):
    """(keep_id, group size, kept, digest) per doc_id, for ids that are not repeated."""
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        bare = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        groups[bare].append((-len(text or ""), doc))
    out = {}
    for bare, members in groups.items():
        keep = min(members)[1]
        for _, doc in members:
            out[doc] = (keep, len(members), doc == keep, hashlib.sha256(bare.encode()).hexdigest())
    return out


@pytest.mark.parametrize("batches, hot", [(1, 1000), (3, 20)])
def test_copies_are_found_as_defined(spark, monkeypatch, batches, hot):
    """Also with groups that count as hot, and in batches that meet in the index."""
    monkeypatch.setattr(exact, "_HOT_ROWS", hot)
    rows = _texts(batches)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS digest", "2 AS copies", "3 AS kept")
    found = exact.exact_duplicates(df, batches=batches).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found} == _copies(rows)


def test_an_index_outlives_its_session_and_counts_what_came_before(spark, tmp_path):
    index = exact.DigestIndex.create(spark, str(tmp_path / "index"), buckets=3)
    first = spark.createDataFrame([(5, "a b"), (6, "c")], "doc_id bigint, text string")
    assert [r.kept for r in exact.exact_duplicates(first, index).collect()] == [True, True]
    again = exact.DigestIndex.open(spark.newSession(), str(tmp_path / "index"))
    assert again.buckets == 3 and again.groups().count() == 2
    second = again.spark.createDataFrame(
        [(1, "ab"), (2, "a  b"), (3, "d"), (None, "c"), (None, "e")], "doc_id bigint, text string"
    )
    found = {(r.doc_id, r.text_sha256[:4]): (r.keep_id, r.group_size, r.kept)
             for r in exact.exact_duplicates(second, again).collect()}
    short = {t: hashlib.sha256(t.encode()).hexdigest()[:4] for t in ("ab", "c", "d", "e")}
    assert found == {
        (1, short["ab"]): (2, 3, False), (2, short["ab"]): (2, 3, True), (3, short["d"]): (3, 1, True),
        (None, short["c"]): (6, 2, False), (None, short["e"]): (None, 1, True),
    }


def test_new_rows_meet_the_index_without_a_shuffle_of_it(spark):
    index = exact.DigestIndex.create(spark, buckets=4)
    rows = spark.range(50).selectExpr("id AS doc_id", "1L AS n_chars", "unhex(sha2(cast(id % 40 AS string), 256)) AS digest")
    assert index.add(rows, "one") and not index.add(rows, "one")
    assert index.add(rows, "two") and index.batches() == ["one", "two"]
    assert index.unseen(rows).count() == 0 and index.groups().count() == 40
    assert index.groups().agg({"copies": "sum"}).first()[0] == 100
    plan = index.unseen(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Exchange" not in index.groups()._jdf.queryExecution().executedPlan().toString()


def test_repeated_rows_nothing_and_what_stays(spark):
    rows = [(7, "a"), (7, "a"), (8, "a"), (None, "a"), (9, None), (10, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "5 AS keep_id")
    found = sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in exact.exact_duplicates(df).collect())
    assert found == [(0, 7, 4, False), (7, 7, 4, True), (7, 7, 4, True), (8, 7, 4, False), (9, 9, 2, True), (10, 9, 2, False)]
    left = exact.without_copies(df)
    assert left.columns == df.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 7, 7, 9]
    assert exact.exact_duplicates(df.limit(0)).collect() == []


def _hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    doc, _, lang, source, n = row
    return _hash(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def _levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([_hash(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def _manifest(rows):
    sources = defaultdict(list)
    for row in rows:
        sources[row[3]].append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for key in order:
        sources[key].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r, r[1])))
    trees = {key: _levels([_leaf(r, r[1]) for r in sources[key]]) for key in order}
    top = _levels([trees[key][-1][0] for key in order])
    out = []
    for k, key in enumerate(order):
        for i, row in enumerate(sources[key]):
            text = row[1]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded, siblings = _leaf(row, text), []
            for levels, at in ((trees[key], i), (top, k)):
                for level in levels[:-1]:
                    run, own = level[at // 3 * 3 : at // 3 * 3 + 3], at % 3
                    siblings += run[:own] + run[own + 1 :]
                    folded = _hash(*run[:own], folded, *run[own + 1 :])
                    at //= 3
            root = top[-1][0]
            out.append((row[0], trees[key][0][i], trees[key][-1][0], root, _hash(*siblings), folded, folded == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in merkle.manifest(df).collect()), key=repr)


@pytest.mark.parametrize("n, band", [(300, 4), (300, 1), (27, 2), (1, 4)])
def test_manifest_is_as_defined(spark, monkeypatch, n, band):
    """Trees of many levels in bands of one, two and four; sources of one row and of none."""
    monkeypatch.setattr(merkle, "BAND", band)
    rows = _texts(n, n)
    if n > 100:
        rows += [(n + i, "lines\nof text", None, f"s{i}", None) for i in range(11)]
        rows += [(None, "a\nb", "en", "web", 1), rows[3], rows[3], (rows[4][0], "other\ntext", None, "web", 9)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rank", "2 AS tree", "'x' AS leaf", "3 AS key")
    assert _found(df) == _manifest(rows)


def test_manifest_of_nothing(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []
