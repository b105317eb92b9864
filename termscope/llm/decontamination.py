"""Benchmark decontamination: a prefix-filtered join of documents with item windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from termscope.sources.storage import stored

#: What lies between words, and the letters that are folded.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

WINDOW_WORDS = 10
SHINGLE_WORDS = 3

#: Keys of shingles are broadcast when, as counted, they need no more than this.
BROADCAST_BYTES = 32 << 20


def _fold(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _words(text: str) -> Column:
    """The words of a text; the first and the last may be empty."""
    return F.split(text, BETWEEN, -1)


def item_windows(items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """``(item_id, words)``: each run of ``size`` words, or all of a shorter item."""
    split = items.select(
        "item_id", F.array_remove(_words("text"), "").alias("all")
    ).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - size + 1, F.lit(1)))
    return split.select("item_id", "all", F.explode(starts).alias("at")).select(
        "item_id",
        F.transform(F.slice("all", F.col("at"), F.lit(size)), _fold).alias("words"),
    )


def _key(words: str, at: Column, size: int) -> Column:
    """A hash of the words at ``at`` and after it; of fewer at the end of a text.

    Lower case is taken word by word here: it merges more letters than folding A-Z
    does, so no shingle is missed, and those that differ are told apart by their text.
    """
    return F.xxhash64(*(F.lower(F.get(F.col(words), at + j)) for j in range(size)))


def _shingle(words: str, at: Column, size: int) -> Column:
    return _fold(F.array_join(F.slice(F.col(words), at + 1, F.lit(size)), " "))


def window_shingles(windows: DataFrame, size: int) -> DataFrame:
    """``(window_id, length, parts, place, shingle, key)`` of all windows."""
    last = F.size("words") - size
    places = windows.select(
        "window_id", "words", F.explode(F.sequence(F.lit(0), last)).alias("place")
    )
    return places.select(
        "window_id",
        F.size("words").alias("length"),
        (F.size("words") - size + 1).alias("parts"),
        "place",
        _shingle("words", F.col("place"), size).alias("shingle"),
        _key("words", F.col("place"), size).alias("key"),
    )


def _occurrences(docs: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """``(doc_id, at, shingle, n_words)``: places of the shingles that have a key.

    The texts are read and split once. Each row also yields its place 0, with the
    number of its words, whether a shingle is there or not. Keys are broadcast if they
    are counted as few; then what does not match never leaves the loop that splits.
    Otherwise places and shingles are shuffled.
    """
    words = docs.select("doc_id", _words("text").alias("words"))
    edges = (F.get("words", F.lit(0)) == "").cast("int") + (
        F.element_at("words", -1) == ""
    ).cast("int")
    count = F.greatest(F.coalesce(F.size("words") - edges, F.lit(0)), F.lit(0))
    spots = words.select("doc_id", "words", F.posexplode_outer("words").alias("at", "word"))
    spots = spots.withColumn("key", _key("words", F.col("at"), size))
    text = _shingle("words", F.col("at"), size)
    first = F.coalesce(F.col("at") == 0, F.lit(True))
    keys = keys.withColumn("hit", F.lit(True))
    n_words = F.when(first, count).alias("n_words")
    if keys.count() * 64 <= BROADCAST_BYTES:
        met = spots.join(F.broadcast(keys), "key", "left").where(F.col("hit") | first)
        return met.select("doc_id", "at", F.when(F.col("hit"), text).alias("shingle"), n_words)
    wide = spots.select("doc_id", "at", "key", text.alias("text"), n_words)
    met = wide.join(keys, "key", "left").where(F.col("hit") | F.col("n_words").isNotNull())
    return met.select("doc_id", "at", F.when(F.col("hit"), F.col("text")).alias("shingle"), "n_words")


def window_hits(
    docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS
) -> tuple[DataFrame, DataFrame]:
    """Occurrences of item windows, ``(doc_id, start, length, item_id)``, and word counts.

    Equal windows of several items are searched once.

    1. A window is a set of word shingles with their places. One pass over the
       documents finds all places of all these shingles.
    2. Shingles are ordered by rarity, their count in all documents. A text that holds a
       window holds all of its shingles, so the rarest one is a sufficient prefix, and
       windows with a shingle that never occurs are out.
    3. Each place of a prefix gives a candidate: the window's start, if that lies within
       the document.
    4. A candidate is an occurrence if each of the window's shingles, compared as text,
       is at its place.
    """
    named = item_windows(items, size).withColumn(
        "window_id", F.sha2(F.array_join("words", " "), 256)
    )
    owners = stored(named.select("window_id", "item_id").distinct(), "owners")
    windows = stored(named.select("window_id", "words").distinct(), "windows")
    least = windows.agg(F.min(F.size("words"))).first()[0]
    shingle = min(SHINGLE_WORDS, least or 1)
    places = stored(window_shingles(windows, shingle), "shingles")
    keys = stored(places.select("key").distinct(), "keys")
    seen = stored(_occurrences(docs, keys, shingle), "occurrences")
    found = seen.where("shingle is not null").select("doc_id", "at", "shingle").distinct()
    counts = found.groupBy("shingle").agg(F.count("*").alias("n"))
    ranked = places.join(counts, "shingle").select(
        "window_id", "length", "parts", F.struct("n", "place", "shingle").alias("s")
    )
    prefixes = (
        ranked.groupBy("window_id", "length", "parts")
        .agg(F.min("s").alias("s"), F.count("*").alias("there"))
        .where("there = parts")
        .select("window_id", "length", "parts", "s.place", "s.shingle")
    )
    candidates = (
        found.join(prefixes, "shingle")
        .select(
            "doc_id", (F.col("at") - F.col("place")).alias("start"), "window_id", "length", "parts"
        )
        .where("start >= 0")
    )
    wanted = candidates.join(places.select("window_id", "place", "shingle"), "window_id").withColumn(
        "at", F.col("start") + F.col("place")
    )
    whole = (
        wanted.join(found, ["doc_id", "at", "shingle"])
        .groupBy("doc_id", "start", "window_id", "length", "parts")
        .agg(F.count("*").alias("there"))
        .where("there = parts")
    )
    hits = whole.join(owners, "window_id").select("doc_id", "start", "length", "item_id")
    return hits, seen.where("n_words is not null").select("doc_id", "n_words")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Words are runs of ASCII digits, letters and any non-ASCII signs, with A-Z folded. A
    word is hit when it lies in an occurrence of a window of ``size`` consecutive words
    of an item, or of all words of a shorter item. ``items_sha256`` is over the sorted,
    comma-joined ids of the items with an occurrence.

    Null and empty texts have no words; items without words have no window, and items
    with a null item_id are hit but not listed or counted; a row with a null doc_id is never hit.
    Rows that share a doc_id are one document and should be equal. Other columns are
    not looked at. Counts of a document's windows are bounded by its own length.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    hits, counted = window_hits(docs, items, size)
    hits = stored(hits.where("doc_id is not null"), "hits")
    end = F.col("start") + F.col("length")
    spans = hits.select("doc_id", "start", end.alias("end")).groupBy("doc_id", "start").agg(
        F.max("end").alias("end")
    )
    earlier = (
        Window.partitionBy("doc_id")
        .orderBy("start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    covered = F.greatest(
        F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(earlier), F.lit(0))),
        F.lit(0),
    )
    words = spans.select("doc_id", covered.alias("n")).groupBy("doc_id").agg(
        F.sum("n").cast("bigint").alias("n_hit")
    )
    owners = (
        hits.select("doc_id", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    items_or_none = F.coalesce("items", F.array().cast("array<string>"))
    return (
        counted.join(words.join(owners, "doc_id"), "doc_id", "left")
        .select(
            "doc_id",
            F.col("n_words").cast("bigint").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.size(items_or_none).cast("bigint").alias("n_items"),
            F.sha2(F.array_join(items_or_none, ","), 256).alias("items_sha256"),
        )
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def decontaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item. All columns stay.

    Rows with a null doc_id cannot be told apart and stay.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    hits, _ = window_hits(rows, items, size)
    hit = hits.where("doc_id is not null").select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti")


#: The same in DuckDB: ``hits`` has the covered words, ``owners`` the items.
CONTAMINATION_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k,
         array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS key
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT doc_id, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS key
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM words, sizes WHERE len(w) >= k)),
found AS (SELECT DISTINCT doc_id, i, p.k, item_id FROM places p JOIN windows USING (key, k)),
hits AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id),
owners AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM found GROUP BY doc_id)
"""
