"""Words that any polynomial hash modulo a power of two takes for one another."""

import llm_definitions as brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_fixtures import documents  # noqa: F401
from termscope.llm import jaccard, recompression, suffix
from termscope.llm.tokens import WordEncoder


def _twins(length):
    """The Thue-Morse word of two letters and the one with the letters exchanged."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(length))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("length", [1024, 4096])
def test_different_long_words_are_not_linked(documents, length):
    x, y = _twins(length)
    docs = {1: x, 2: y, 3: x.upper(), 4: f"{x} {y}", 5: f"{y} {x}"}
    rows = jaccard.jaccard_components(documents(docs), 4, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.jaccard(docs, 4, 85)


@pytest.mark.parametrize("length", [1024, 4096])
def test_windows_with_different_long_words_stay(documents, length):
    x, y = _twins(length)
    common = " ".join(f"c{i}" for i in range(19))
    docs = {1: f"{common} {x}", 2: f"{common} {y}", 3: f"{common} {y} end"}
    rows = recompression.kept_words(documents(docs)).collect()
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rows}
    assert found == brute.kept_words(docs)
    rows = suffix.kept_bytes(documents(docs)).collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows}
    assert found == brute.kept_bytes(docs)


@pytest.mark.parametrize("length", [1024, 4096])
def test_long_words_have_their_own_ids(length):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = list(_twins(length))
    library = Tokenizer.from_file(path)
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [list(map(int, ids)) for ids in WordEncoder(path).encode(texts)] == expected
    assert expected[0] != expected[1] and all(np.array(expected[0]) >= 0)


def test_windows_proposed_for_nothing_are_told_apart(documents, monkeypatch):
    """Every window of a document is a candidate, so digests of the words alone decide."""

    def all_windows(batches, size):
        for batch, data, offsets in recompression.parts(batches, "text", 200):
            starts, ends, first = recompression.word_spans(data, offsets, recompression.WHITE)
            last = np.repeat(first[1:], np.diff(first))
            at = np.flatnonzero(np.arange(len(starts)) + size <= last)
            digests = recompression.window_digests(data, starts, ends, at, size)
            yield batch, data, (starts, ends, first), at, digests

    monkeypatch.setattr(recompression, "_candidates", all_windows)
    passage = [f"p{i}" for i in range(30)]
    docs = {
        1: " ".join(passage), 2: " ".join(f"q{i}" for i in range(40)),
        3: "a\n " + "\t ".join(passage[3:27]) + " b", 4: " ".join(passage[:19] + ["other"]),
        5: " ".join([*passage[:25], *passage[:25]]), 6: "é " * 50, 7: "", 8: None,
    }
    rows = recompression.kept_words(documents(docs)).collect()
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rows}
    assert found == brute.kept_words(docs)
