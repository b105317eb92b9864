"""HTML extraction: parser events, text-to-tag ratio per line, smoothing, clustering."""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.llm.arrays import parts

#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li "
    "main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title "
    "tr ul".split()
)
#: Elements that never have content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never main text.
DROPPED = frozenset(
    "nav header footer aside form script style noscript template iframe object svg math canvas "
    "audio video select option textarea button label menu dialog head title map datalist".split()
)
#: Elements that an opening tag of the key closes when it is open.
CLOSES = {
    "p": frozenset({"p"}),
    "li": frozenset({"li", "p"}),
    "dt": frozenset({"dt", "dd", "p"}),
    "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}),
    "th": frozenset({"td", "th"}),
    "option": frozenset({"option"}),
}
#: Words in class, id or role that mark what is not main text.
_MARKS = re.compile(
    r"(?:^|(?<=[\s_-]))(ads?|advert\w*|adsense|banner|breadcrumbs?|comments?|commentlist|consent|"
    r"cookies?|disqus|footer|header|masthead|menu|nav|navbar|navigation|newsletter|notices?|"
    r"notification|popup|modal|overlay|promo\w*|related|share|sharing|sidebar|social|sponsor\w*|"
    r"subscribe|subscription|toolbar|widgets?|alert|complementary|contentinfo|search|login|"
    r"signup|replies|responses|recommended|outbrain|taboola|pagination|pager|skip|"
    r"respond|reply|discussion|disclaimer|copyright|teaser|site-?header|page-?header)(?=$|[\s_-])",
    re.IGNORECASE,
)
#: Names that say how a page is laid out or built, not what an element is.
_LAYOUT = re.compile(
    r"(?:^|(?<=\s))(?:no|has|with|without)[_-]\S*"
    r"|(?<![^\s_-])widgets?[_-](?:text|content|body|editor|heading|image)(?=$|[\s_-])",
    re.IGNORECASE,
)
#: Marks that hold however much text they have: readers may write more than the author.
_READERS = re.compile("comment|disqus|repl|respon|discussion")
#: Elements that hold an article by name, and all that may be a region.
ARTICLES = frozenset({"article", "main"})
REGIONS = ARTICLES | {"section", "div", "td", "body", "center", "blockquote"}

#: Standard deviation of the smoothing, in lines, and how far it reaches.
SIGMA = 1.0
REACH = 3
#: Lines count as content from this share of the standard deviation of all on.
THRESHOLD = 0.5
#: Share of the content lines' smoothed ratios that a region has to hold.
SHARE = 0.6
#: What the ratio of a line in an article element counts for.
ARTICLE_WEIGHT = 8.0


def mark_words(marks: str) -> frozenset[str]:
    """The words in class, id and role that mark an element."""
    return frozenset(word.lower() for word in _MARKS.findall(_LAYOUT.sub(" ", marks)))


class Lines(HTMLParser):
    """Blocks of text with their tags, as the parser's events come.

    A block is ``(text, tags, path, heading)``: white space is one blank, ``tags`` are
    those met in the block, ``path`` are the open elements that may be regions, each with
    a number and whether it is an article. Text in marked elements is kept with its marks until the
    page is over: a mark whose elements hold most of the page's text does not count.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, tuple, bool]] = []
        self.read: list[tuple[list, int, tuple, bool]] = []
        self.open: list[tuple[str, bool, frozenset[str]]] = []
        self.path: list[tuple[int, bool]] = []
        self.dropped = 0
        self.regions = 0
        self.seen = False
        self.pieces: list[tuple[str, frozenset[str]]] = []
        self.tags = 0

    def _end_block(self) -> None:
        heading = any(re.fullmatch("h[1-6]", name) for name, _, _ in self.open[-3:])
        self.read.append((self.pieces, self.tags, tuple(self.path), heading))
        self.pieces, self.tags = [], 0

    def _lifted(self) -> set[str]:
        """Marks that do not count, as most of the page's text is in their elements.

        Where an article element has text without marks, they all count.
        """
        sizes: dict[str, int] = {}
        total = 0
        for pieces, _, path, _ in self.read:
            in_article = any(article for _, article in path)
            for text, marks in pieces:
                if in_article and not marks and text.strip():
                    return set()
                if not any(map(_READERS.match, marks)):
                    size = len("".join(text.split()))
                    total += size
                    for word in marks:
                        sizes[word] = sizes.get(word, 0) + size
        return {word for word, size in sizes.items() if 2 * size > total}

    def _pop(self) -> None:
        name, drops, _ = self.open.pop()
        self.dropped -= drops
        if name in REGIONS:
            self.path.pop()

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._end_block()
        self.tags += 1
        if tag in CLOSES:
            shut = CLOSES[tag]
            for depth in range(len(self.open) - 1, -1, -1):
                name = self.open[depth][0]
                if name in shut:
                    while len(self.open) > depth:
                        self._pop()
                    break
                if name in BLOCKS and name not in ("p",):
                    break
        if tag in VOID:
            return
        named = dict(attrs)
        marks = " ".join(named.get(k) or "" for k in ("class", "id", "role"))
        marked = mark_words(marks) if marks and tag not in ("html", "body") else frozenset()
        drops = tag in DROPPED or "hidden" in named or named.get("aria-hidden") == "true"
        if tag in ARTICLES and not (drops or self.seen):
            # The first article is what the page is about, whatever its class says.
            marked = frozenset(w for w in marked if _READERS.match(w))
            if not marked:
                self._unmark()
        self.seen = self.seen or (tag in ARTICLES and not (drops or marked))
        self.open.append((tag, drops, frozenset() if drops else marked))
        self.dropped += drops
        if tag in REGIONS:
            self.regions += 1
            self.path.append((self.regions, tag in ARTICLES))

    def _unmark(self) -> None:
        """Take back marks of what the first article lies in, a wrapper of the page."""
        for depth, (name, drops, _) in enumerate(self.open):
            self.open[depth] = (name, drops, frozenset())

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._end_block()
        self.tags += 1
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                while len(self.open) > depth:
                    self._pop()
                break

    def handle_data(self, data):
        if not self.dropped:
            self.pieces.append((data, frozenset().union(*(m for _, _, m in self.open))))

    def close(self):
        super().close()
        self._end_block()
        lifted, met = self._lifted(), 0
        for pieces, tags, path, heading in self.read:
            met += tags
            text = " ".join("".join(t for t, marks in pieces if marks <= lifted).split())
            if text:
                self.blocks.append((text, met, path, heading))
                met = 0


def smoothed(values: list[float]) -> list[float]:
    """Gaussian means over neighbouring lines; at the ends over those there are."""
    kernel = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(REACH + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for j in range(max(0, i - REACH), min(len(values), i + REACH + 1)):
            k = kernel[abs(i - j)]
            total += k * values[j]
            weight += k
        out.append(total / weight)
    return out


def content_blocks(blocks: list[tuple[str, int, tuple, bool]]) -> list[str]:
    """The texts of the content region among a page's lines.

    Each line has the ratio of its signs to its tags; lines in an article element count
    for more. Smoothed ratios above a share of their standard deviation are content. The
    region is the innermost element that holds most of what the content lines add up to;
    an article around it is the region as a whole, its short lines and heading too. Of
    other regions the lines from the first to the last content line stay, and headings
    right before them.
    """
    ratios = [
        len(text) / max(tags, 1) * (ARTICLE_WEIGHT if any(a for _, a in path) else 1.0)
        for text, tags, path, _ in blocks
    ]
    soft = smoothed(ratios)
    if not soft:
        return []
    mean = sum(soft) / len(soft)
    spread = math.sqrt(sum((v - mean) ** 2 for v in soft) / len(soft))
    high = [i for i, v in enumerate(soft) if v >= THRESHOLD * spread]
    # A line outside all region elements has none; then all lines are the region.
    held: dict[int, float] = {}
    for i in high:
        for number, _ in blocks[i][2]:
            held[number] = held.get(number, 0.0) + soft[i]
    least = SHARE * sum(soft[i] for i in high)
    region, whole, deepest = None, False, -1
    for i in high:
        path = blocks[i][2]
        deep = [depth for depth, (number, _) in enumerate(path) if held[number] >= least]
        if deep and deep[-1] > deepest:
            deepest = deep[-1]
            above = [number for number, article in path[: deepest + 1] if article]
            region, whole = (above[0], True) if above else (path[deepest][0], False)
    if region is not None:
        inside = [any(number == region for number, _ in path) for _, _, path, _ in blocks]
    else:
        inside = [True] * len(blocks)
    if whole:
        return [block[0] for block, own in zip(blocks, inside) if own]
    high = [i for i in high if inside[i]]
    first = high[0]
    while first > 0 and blocks[first - 1][3] and inside[first - 1]:
        first -= 1
    return [blocks[i][0] for i in range(first, high[-1] + 1) if inside[i]]


def main_text(html: str | None) -> str:
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    return "\n".join(content_blocks(parser.blocks))


def extract_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages``.

    The text is that of the region that the ratios choose: headings and paragraphs, in
    page order, one line per block. Menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    styles and comments are left out, by the element or by a word in its class, id or
    role. Such words do not count when they say how the page is laid out, on the first
    article element, or when most of the page's text is in elements that have them;
    those of readers' comments count on all other elements. Character references are decoded, white space within a block is one blank.

    Null, empty and textless pages have an empty text. Every row is a page of its own;
    repeated rows and null ids are kept as they are, other columns are not looked at.
    """

    def read(batches):
        for batch, _, _ in parts(batches, "html"):
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return rows.mapInArrow(read, "page_id bigint, url string, text string, n_chars bigint")
