import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from llm_fixtures import documents  # noqa: F401
from tokenizers import Tokenizer

from termscope.llm import packing, secrets, toxicity
from termscope.llm.html_text import Lines, content_blocks, extract_text, main_text, smoothed
from termscope.llm.tokens import WordEncoder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(VOCABULARY)


def test_words_are_encoded_as_the_library_does(encoder):
    rnd = random.Random(3)
    signs = [chr(c) for c in range(1, 0x320)] + list("'''strevmld  <|ab0") * 30
    texts = ["".join(rnd.choices(signs, k=rnd.randint(0, 60))) for _ in range(800)]
    texts += ["", "'s", "'re've'll'm'd't's", "İx Σς", "<|endoftext|> a", "<|x", " ", "''s", "日本 語", "é"]
    library = Tokenizer.from_file(VOCABULARY)
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts)):
            assert list(ids) == library.encode(text, add_special_tokens=False).ids


def test_a_full_word_store_is_started_anew(monkeypatch):
    monkeypatch.setattr("termscope.llm.tokens._STORE", 64)
    small = WordEncoder(VOCABULARY)
    library = Tokenizer.from_file(VOCABULARY)
    for i in range(5):
        text = " ".join(f"wörd{i}x{j}" for j in range(40))
        assert list(small.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_packing_places_every_piece_once_and_without_gaps(documents):
    rnd = random.Random(1)
    docs = {i: " ".join(rnd.choices("red green blue 42 é !".split(), k=rnd.randint(0, 90))) for i in range(120)}
    docs |= {200: None, 201: "", 202: "long " * 500}
    capacity = 64
    df = documents([*docs.items(), (5, docs[5]), (None, "no id")])
    rows = packing.pack_documents(df, VOCABULARY, capacity).collect()
    library = Tokenizer.from_file(VOCABULARY)
    for i, text in docs.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        own = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == i})
        assert own == [
            (k, a, len(ids[a : a + capacity]), zlib.crc32(np.array(ids[a : a + capacity], "<u4").tobytes()))
            for k, a in enumerate(range(0, len(ids), capacity))
        ]
    assert sum(r.doc_id == 5 for r in rows) == 2 * sum(r.doc_id == 6 for r in rows) or docs[5] != docs[6]
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    least = math.ceil(sum(r.length for r in rows) / capacity)
    assert len(sequences) <= 1.05 * least + 1
    assert packing.pack_documents(documents([]), VOCABULARY).collect() == []


def test_tokens_come_with_the_pieces(documents):
    row = packing.token_pieces(documents([(1, "a b")]), VOCABULARY, with_tokens=True).first()
    assert row.tokens[-1] == 1 and zlib.crc32(np.array(row.tokens, "<u4").tobytes()) == row.ids_crc32


def test_sum_of_squares_chooses_the_least_sum():
    rnd = random.Random(2)
    lengths = np.array([rnd.randint(1, 12) for _ in range(60)])
    bins, offsets = packing.sum_of_squares(lengths, 12)
    gaps = {}
    for size, chosen, offset in zip(lengths, bins, offsets):
        def total(after):
            counts = {}
            for gap in after.values():
                if gap:
                    counts[gap] = counts.get(gap, 0) + 1
            return sum(n * n for n in counts.values())

        options = [b for b, gap in gaps.items() if gap >= size] + [len(gaps)]
        best = min(total(gaps | {b: gaps.get(b, 12) - size}) for b in options)
        after = gaps | {chosen: gaps.get(chosen, 12) - size}
        assert total(after) == best and offset == 12 - gaps.get(chosen, 12)
        gaps = after


def _base_spans(text):
    assign = re.compile(
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        re.IGNORECASE | re.ASCII,
    )
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) > 5]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) > 19]
    return found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) > 23]


def _hot_spans(text):
    """Every window counted afresh."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]+", text):
        body = m[0]
        if len(body) < 20 or any(re.search(p, body) for p in secrets.ALLOWED):
            continue
        hot = []
        for i in range(len(body) - 19):
            part = body[i : i + 20]
            bits = -sum(part.count(c) / 20 * math.log2(part.count(c) / 20) for c in set(part))
            least = secrets.HEX_BITS if re.fullmatch("[0-9A-Fa-f]+", part) else secrets.MIXED_BITS
            if re.search("[0-9]", part) and re.search("[A-Za-z]", part) and bits >= least - 1e-9:
                hot.append(i)
        if hot:
            found.append((m.start() + hot[0], 3, m.start() + hot[-1] + 20))
    return found


def test_secrets_are_found_as_defined(documents):
    rnd = random.Random(8)
    key = "".join(rnd.choices("ABCDEFGHabcdefghijkxyz0123456789+/", k=48))
    docs = {
        1: f"é password = '{key}' and TOKEN:abc token=token:abcdefgh secret==abcd12",
        2: "AKIA" + "Z9" * 8 + " AKIASHORT " + "AKIA" + "B" * 15,
        3: f"𝒳𝒳 {key} tail", 4: "0123456789abcdef" * 2 + " x" + "deadbeef" * 3,
        5: "5f2b1c3d-1111-2222-3333-444455556666 some-long-slug-with-number-2023-01-02", 6: None, 7: "",
        8: "api_key: x api-key: yyyyyyy apikey:\"zzzzzz", 9: "thisisaverylongwordwithoutanydigits12",
    }
    for i in range(20, 60):
        docs[i] = "".join(rnd.choices("ab1=: \"'/AKIZ9ftokenpasswd", k=300)) + " token" + rnd.choice("=: ") + key[i % 40 :]
    rows = secrets.secrets(documents([*docs.items(), (None, docs[1]), (1, docs[1])])).collect()
    assert len(rows) == len(docs) + 2
    for r in rows:
        text = docs[r.doc_id if r.doc_id is not None else 1] or ""
        base = sorted(_base_spans(text))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in base) for k in range(3))
        written = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        more = [
            s for s in _hot_spans(text) if not any(a <= s[0] and s[2] <= b for a, _, b in base)
        ]
        assert r.spans == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(base + more))
    assert any("entropy" in r.spans for r in rows)
    assert secrets.secrets(documents([])).collect() == []


def test_keys_with_a_prefix_or_next_to_a_word_of_manuals_are_found(documents):
    key = "k3j9x0q2m7v5b8n1z4c6t0w2r9y7u5p3q1aa"
    docs = {
        1: "key-3ax6xnjp29jd6fds4gc373sgvjxteol0", 2: f"ghp_{key}", 3: f"see example/{key} there",
        4: f"{key}_0123456789",
        10: "how-to-install-version-2023-01-02", 11: "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
        12: "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    }
    found = {r.doc_id: r.spans for r in secrets.secrets(documents(docs)).collect()}
    assert all(found[i] == "" for i in (10, 11, 12))
    for i in (1, 2, 3, 4):
        kind, start, end = found[i].split(":")
        own = docs[1][4:] if i == 1 else key
        at = docs[i].index(own)
        assert kind == "entropy" and int(start) <= at + 4 and int(end) >= at + len(own) - 4


def _toxic_corpus(n):
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abehlnort", k=rnd.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = rnd.choices(words, k=rnd.randint(5, 60))
        bad = rnd.random() < 0.2
        if bad:
            text[rnd.randrange(len(text))] = rnd.choice(("Vrexl", "zwump", "quigg")) + rnd.choice(("", "s", "ed"))
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_is_learned_and_held_out_rows_are_not(documents, spark):
    rows, labels = _toxic_corpus(600)
    wrong = [
        (i, 1 - y) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, y) for i, y in labels
    ]
    marks = spark.createDataFrame(wrong + [(None, 1), (0, None), (1, 7)], "doc_id bigint, toxic int")
    extra = [(9000, None), (9001, ""), (None, "zwump"), (3, rows[3][1])]
    found = toxicity.toxicity(documents(rows + extra), marks).collect()
    assert len(found) == len(rows) + len(extra)
    truth = dict(labels)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert {r.score for r in found if r.doc_id in (9000, 9001)} == {
        next(r.score for r in found if r.doc_id == 9001)
    }


def test_toxic_documents_go_with_all_columns_of_the_rest(documents, spark):
    rows, labels = _toxic_corpus(400)
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    df = documents(rows)
    left = toxicity.without_toxic(df, marks)
    assert left.schema == df.schema
    truth = dict(labels)
    kept = {r.doc_id for r in left.collect()}
    assert sum(truth[i] for i in kept) <= 3 and len(kept) >= 0.97 * (400 - sum(truth.values()))
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.without_toxic(df, none).count() == 400
    assert toxicity.toxicity(documents([]), marks).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{x}</style></head>
<body class="with-sidebar"><header><h1>Site</h1></header><nav><ul><li>Menu</ul></nav>
<div class="page sidebar-left"><div id="cookie-notice">Cookies!</div>
<article class="post"><h1>A &amp; B</h1><p>First   para<b>graph</b> &eacute;<br><p>Second
line<!-- not this --><script>var a = "</p>";</script><ul><li>one<li>two</ul>
<aside>aside</aside><div class="advert">buy</div><form>mail <input></form><p>x</article>
<section id="comments"><article>Nice post</article></section></div>
<footer>foot</footer></body></html>"""


def test_article_of_a_page():
    assert main_text(PAGE) == "A & B\nFirst paragraph é\nSecond line\none\ntwo\nx"


def test_content_region_without_an_article():
    long = "Many words of prose in a row, " * 5
    page = (
        "<body><div><a href=a>x</a><a href=b>y</a><a href=c>z</a></div>"
        f"<div><h2>Head</h2><p>{long}</p><p>Short.</p><p>{long}</p></div>"
    )
    assert main_text(page).split("\n")[-4:] == ["Head", long.strip(), "Short.", long.strip()]


@pytest.mark.parametrize(
    "start, end",
    [
        ('<div class="content no-sidebar">', "</div>"),
        ('<div class="left-sidebar">', "</div>"),
        ('<div class="has-comments">', "</div>"),
        ('<main class="with-sidebar">', "</main>"),
        ('<main class="widget">', "</main>"),
        ('<article class="post has-related">', "</article>"),
        ('<main><div class="widget">', "</div></main>"),
    ],
)
def test_marks_of_layout_do_not_drop_the_text(start, end):
    long = "Many words of prose in a row, " * 5
    body = f"<h2>Head</h2><p>{long}</p><p>{long}</p>"
    rest = f'<div id="comments"><p>{long * 4}</p></div><div class="ad">buy</div>'
    found = main_text(f"<body>{start}{body}{end}{rest}</body>").split("\n")
    assert found == ["Head", long.strip(), long.strip()]


def test_texts_in_several_marked_parts_are_kept():
    long = "Many words of prose in a row, " * 5
    parts = f'<div class="elementor-widget"><p>{long}</p></div>' * 3
    more = f'<div class="elementor-widget-text"><p>{long}</p></div>'
    assert main_text(f"<body>{parts}{more}<div class='social'>like</div></body>") == "\n".join(
        [long.strip()] * 4
    )


def test_smoothed_ratios_choose_the_region(monkeypatch):
    """One long line among links is no region; lines next to each other are one.

    Both lie in plain elements, so nothing but the ratios can tell them apart.
    """
    line = "A line of some words of prose in the text. "
    text = "".join(f"<p>{line * 2}</p>" for _ in range(20))
    links = "".join(f"<p><a href=x>{i}</a></p>" for i in range(9))
    page = f"<body><div>{text}</div><div>{links}<p>{line * 18}</p>{links}</div></body>"
    assert main_text(page) == "\n".join([(line * 2).strip()] * 20)
    monkeypatch.setattr("termscope.llm.html_text.smoothed", lambda values: values)
    assert main_text(page) == "\n".join([(line * 2).strip()] * 19)
    monkeypatch.setattr("termscope.llm.html_text.smoothed", lambda values: [1.0] * len(values))
    assert main_text(page).count("\n") == 38


def test_an_article_without_much_text_is_not_the_region():
    """The name of an element counts for something, not for everything."""
    line = "Many words of prose in a row and some more of them. "
    text = "".join(f"<p>{line * 3}</p>" for _ in range(30))
    page = f"<body><div><h2>Title</h2>{text}</div><article><a href=x>More</a></article></body>"
    assert main_text(page) == "\n".join(["Title"] + [(line * 3).strip()] * 30)


def _region_by_definition(blocks):
    """Texts of the region, with every sum written out."""
    ratios = [len(t) / max(n, 1) * (8 if any(a for _, a in path) else 1) for t, n, path, _ in blocks]
    soft = []
    for i in range(len(ratios)):
        near = [j for j in range(len(ratios)) if abs(i - j) <= 3]
        weights = [math.exp(-((i - j) ** 2) / 2) for j in near]
        soft.append(sum(w * ratios[j] for w, j in zip(weights, near)) / sum(weights))
    high = [i for i, v in enumerate(soft) if v >= 0.5 * np.std(soft)]
    if not high:
        return []
    numbers = {number for _, _, path, _ in blocks for number, _ in path}
    lines = {k: [i for i, b in enumerate(blocks) if k in dict(b[2])] for k in numbers}
    enough = [
        k for k in numbers
        if sum(soft[i] for i in lines[k] if i in high) >= 0.6 * sum(soft[i] for i in high)
    ]
    own = list(range(len(blocks)))
    if enough:
        # Elements are numbered as they open, so the innermost one has the largest number.
        inner = max(enough)
        path = blocks[lines[inner][0]][2]
        articles = [k for k, article in path if article and k <= inner]
        if articles:
            return [blocks[i][0] for i in lines[articles[0]]]
        own = lines[inner]
    kept = [i for i in own if min(h for h in high if h in own) <= i <= max(h for h in high if h in own)]
    while kept[0] - 1 in own and blocks[kept[0] - 1][3]:
        kept.insert(0, kept[0] - 1)
    return [blocks[i][0] for i in kept]


def test_regions_are_as_defined():
    """Random pages of nested elements, and the given ones."""
    rnd = random.Random(5)

    def element(depth):
        if depth == 0 or rnd.random() < 0.4:
            kind = rnd.choice(("p", "p", "p", "h2", "li"))
            text = "word " * rnd.choice((1, 2, 30, 60)) if rnd.random() < 0.8 else "<a href=x>link</a> " * 4
            return f"<{kind}>{text}</{kind}>"
        kind = rnd.choice(("div", "div", "section", "article"))
        return f"<{kind}>{''.join(element(depth - 1) for _ in range(rnd.randint(1, 5)))}</{kind}>"

    pages = [f"<body>{''.join(element(4) for _ in range(rnd.randint(1, 4)))}</body>" for _ in range(200)]
    pages += pq.read_table("/root/testdata/sf0.001/pages.parquet").column("html").to_pylist()
    for html in pages:
        parser = Lines()
        parser.feed(html)
        parser.close()
        assert content_blocks(parser.blocks) == _region_by_definition(parser.blocks)


def test_smoothing_keeps_constants_and_spreads_peaks():
    assert smoothed([2.0] * 9) == pytest.approx([2.0] * 9)
    peak = smoothed([0.0] * 5 + [10.0] + [0.0] * 5)
    assert peak[5] == max(peak) and peak[4] == pytest.approx(peak[6]) and peak[4] > peak[3] > 0


def test_pages_with_nulls_repeats_and_nothing(spark):
    schema = "page_id bigint, url string, html string, text int"
    rows = [(1, "u", PAGE, 1), (1, "u", PAGE, 1), (2, None, None, 2), (None, "v", "", 3), (3, "w", "<p>a <", 4)]
    found = extract_text(spark.createDataFrame(rows, schema)).collect()
    assert [(r.page_id, r.n_chars == len(r.text)) for r in found] == [
        (1, True), (1, True), (2, True), (None, True), (3, True),
    ]
    assert [r.text for r in found][2:4] == ["", ""]
    assert extract_text(spark.createDataFrame([], schema)).collect() == []
