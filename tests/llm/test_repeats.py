import hashlib
import random

import llm_definitions as brute
import numpy as np
import pytest

from llm_fixtures import documents  # noqa: F401
from termscope.llm import lines, recompression, suffix
from termscope.llm.decontamination import contamination, decontaminated


def _texts(seed):
    """Periodic, random and shared texts over few words and letters."""
    rnd = random.Random(seed)
    docs = {}
    for i in range(150):
        kind = rnd.random()
        if kind < 0.25:
            period = [rnd.choice("ab cé") for _ in range(rnd.randint(1, 40))]
            docs[i] = ("".join(period) * 60)[: rnd.randint(0, 300)]
        elif kind < 0.5:
            docs[i] = " ".join([rnd.choice("abc")] * rnd.randint(0, 70))
        elif kind < 0.75:
            docs[i] = "  ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 90)))
        else:
            docs[i] = "\n".join(rnd.choice(("x", "yy", "zzz", "é")) for _ in range(rnd.randint(0, 60)))
    passage = [str(rnd.randint(0, 999)) for _ in range(150)]
    for i in range(150, 220):
        a = rnd.randrange(120)
        docs[i] = " ".join(
            [str(i)] * rnd.randint(0, 9) + passage[a : a + rnd.randint(0, 60)] + [str(rnd.random())]
        )
    docs |= {300: None, 301: "", 302: docs[170], 303: " ".join(passage)}
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_words_are_kept_as_defined(documents, seed):
    docs = _texts(seed)
    rows = recompression.kept_words(documents(docs)).collect()
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rows}
    assert found == brute.kept_words(docs)


@pytest.mark.parametrize("seed, most", [(1, 150_000), (2, 50)])
def test_bytes_are_kept_as_defined(documents, monkeypatch, seed, most):
    monkeypatch.setattr(suffix, "SEGMENTS", most)
    docs = _texts(seed)
    rows = suffix.kept_bytes(documents(docs)).collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows}
    assert found == brute.kept_bytes(docs)


def test_no_task_holds_all_segments_of_a_common_anchor(spark, documents, monkeypatch):
    """Copies of a passage, and ends of it that differ in each document."""
    rnd = random.Random(3)
    passage = "".join(rnd.choices("abcdefgh ", k=160))
    docs = {i: passage for i in range(200)}
    docs |= {i: f"{rnd.random()} {passage[30:90]} {rnd.random()}" for i in range(200, 400)}
    inner = suffix._resolved

    def bounded(table, *sizes):
        assert table.num_rows <= 90
        return inner(table, *sizes)

    monkeypatch.setattr(suffix, "SEGMENTS", 40)
    monkeypatch.setattr(suffix, "_resolved", bounded)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10")
    try:
        rows = suffix.kept_bytes(documents(docs)).collect()
    finally:
        spark.conf.set(name, before)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows}
    assert found == brute.kept_bytes(docs)


def test_repeats_with_null_ids_repeated_rows_and_nothing(documents):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(None, text), (2, text), (2, text), (5, text)]
    words = recompression.kept_words(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in words)[0] == (0, 0)
    assert [(r.n_removed, r.kept) for r in words if r.doc_id == 5] == [(40, "")]
    parts = suffix.kept_bytes(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in parts) == [
        (0, 0), (2, 0), (2, 0), (5, len(text)),
    ]
    assert recompression.kept_words(documents([])).collect() == []
    assert suffix.kept_bytes(documents([])).collect() == []


def test_chunks_put_together_are_the_text():
    rnd = random.Random(3)
    for _ in range(50):
        text = "\n".join(str(rnd.randint(0, 9)) for _ in range(rnd.randint(1, 60)))
        found = lines.chunks(text)
        assert "\n".join(body for _, body in found) == text
        assert all(count > 1 for count, _ in found) or "\n" not in text
    inner = "\n".join(str(rnd.random()) for _ in range(40))
    a, b = ({x for _, x in lines.chunks(f"{p}\n{inner}\n{p}")} for p in ("one\ntwo", "three"))
    assert len(a & b) >= len(a) - 5


def test_lines_are_cut_where_an_earlier_document_has_them(documents):
    body = "\n".join(f"line {i}" for i in range(12))
    rows = [(4, body), (2, body), (9, "alone"), (8, "alone"), (5, None), (6, ""), (None, body), (2, body)]
    df = documents(rows)
    found = lines.dedup_lines(df)
    assert found.columns == [*df.columns, "n_lines", "n_removed"]
    got = sorted((r.doc_id or 0, r.text, r.n_lines, r.n_removed) for r in found.collect() if r.text is not None)
    assert got == [
        (0, body, 12, 0), (2, body, 12, 0), (2, body, 12, 0), (4, "", 12, 12),
        (6, "", 1, 0), (8, "alone", 1, 0), (9, "alone", 1, 0),
    ]
    assert lines.dedup_lines(documents([])).collect() == []


@pytest.mark.parametrize("bound", [1 << 25, 0])
def test_windows_are_found_as_defined(documents, spark, monkeypatch, bound):
    monkeypatch.setattr("termscope.llm.decontamination.BROADCAST_BYTES", bound)
    rnd = random.Random(6)
    items = [
        (1, " ".join(f"q{rnd.randint(0, 30)}" for _ in range(14))),
        (2, "Short, ITEM of five words"), (3, None), (4, "--"), (10, "short item OF five words"),
        (None, "null item here"), (5, "É é x x x x x x x x x x x"),
    ]
    docs = {i: " ".join(f"q{rnd.randint(0, 30)}" for _ in range(60)) for i in range(20)}
    docs[3] += ". " + items[0][1].upper()
    docs |= {
        50: "-- a short-item: OF;five words", 51: None, 52: "", 53: "...", 54: items[0][1][3:],
        55: "É é" + " x" * 30, 56: "é é" + " x" * 9, 57: "short item of five",
    }
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = contamination(documents(docs), benchmark).collect()
    expected = brute.contaminated(docs, items)
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows} == {
        i: (n, hit, len(own), hit > 0) for i, (n, hit, own) in expected.items()
    }
    clean = decontaminated(documents([*docs.items(), (None, items[0][1])]), benchmark)
    assert sorted(clean.columns) == sorted(documents(docs).columns)
    left = {r.doc_id for r in clean.collect()}
    assert left == {i for i, (_, hit, _) in expected.items() if not hit} | {None}


def test_items_without_an_id_are_searched_for(documents, spark):
    items = spark.createDataFrame(
        [(None, "one two three"), (7, "four five")], "item_id bigint, text string"
    )
    docs = documents([(1, "x One two three"), (2, "four five one two three"), (3, "two three")])
    rows = {r.doc_id: r for r in contamination(docs, items).collect()}
    found = {i: (r.n_hit, r.n_items, r.contaminated) for i, r in rows.items()}
    assert found == {1: (3, 0, True), 2: (5, 1, True), 3: (0, 0, False)}
    assert rows[1].items_sha256 == rows[3].items_sha256 == hashlib.sha256(b"").hexdigest()
    assert rows[2].items_sha256 == hashlib.sha256(b"7").hexdigest()
    assert [r.doc_id for r in decontaminated(docs, items).collect()] == [3]


def test_contamination_without_items_or_documents(documents, spark):
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    rows = contamination(documents([(1, "a b"), (1, "a b")]), nothing).collect()
    assert [(r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in rows] == [(1, 2, 0, False)] * 2
    one = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert contamination(documents([]), one).collect() == []
    assert [r.n_hit for r in contamination(documents([(1, "b A a")]), one).collect()] == [2]


@pytest.mark.parametrize(
    "module, kept", [(recompression, recompression.kept_words), (suffix, suffix.kept_bytes)]
)
def test_keys_are_counted_without_windows(documents, monkeypatch, module, kept):
    plans = []

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return inner(df, label)

    inner = module.stored
    monkeypatch.setattr(module, "stored", noted)
    kept(documents([(1, "a b " * 40), (2, "a b " * 40)])).collect()
    assert plans and not any("Window" in plan for plan in plans)


def test_keys_are_those_of_the_best_symbol_within_each_window():
    """By the definition: every symbol is tried for every window."""
    rng = np.random.default_rng(5)
    for size, kinds in ((1, 3), (3, 2), (20, 2), (20, 1000)):
        words = recompression.mix(rng.integers(0, kinds, 150).astype(np.uint64))
        first = np.array([0, 60, 60, 150])
        own, keys, _ = recompression.window_keys(words, first, size)
        text = np.repeat(np.arange(3), np.diff(first))
        best = [0] * len(words)
        for symbols in recompression.recompressed(words, text):
            for name, low, high, held in zip(symbols.name, symbols.low, symbols.high, symbols.words):
                rank = int(recompression.mix(np.array([name]) + np.uint64(0x2545F491))[0]) >> 6
                for at in range(max(high - size, 0), low + 1) if 0 <= low and high < 1 << 61 else ():
                    best[at] = max(best[at], min(int(held), 63) << 58 | rank)
        alone = recompression.mix(own ^ recompression._RUN) >> np.uint64(6)
        assert [int(k) for k in keys] == [b or int(a) for b, a in zip(best, alone)]
