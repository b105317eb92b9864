"""Line dedup by content-defined chunks of lines."""

from __future__ import annotations

from hashlib import blake2b, md5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termscope.sources.storage import stored

#: Multiplier of the rolling hash, which covers two lines and is kept modulo 2**32.
STEP = 31
_MODULUS = 1 << 32

#: Copies of a chunk that one task compares with the first one.
COPIES_PER_TASK = 1000


def chunk_bounds(lines: list[str]) -> list[int]:
    """Line numbers at which chunks start, and the number of lines at the end.

    A line's hash is the first 32 bits of its MD5. A hash rolls over the hashes of a
    line and the one before; a chunk starts at each line where it is smaller than at
    both neighbours. So a boundary depends on four lines only, and lines put in or
    taken out elsewhere do not move it. No chunk of a text of several lines has only
    one: minima are never adjacent, and the first and last line start none.
    """
    rolled, out = [], [0]
    value = before = older = 0
    for line in lines:
        own = int.from_bytes(md5(line.encode("utf-8", "surrogatepass")).digest()[:4], "big")
        value = (value * STEP + own - older * STEP * STEP) % _MODULUS
        rolled.append(value)
        older, before = before, own
    for i in range(2, len(lines) - 1):
        if rolled[i - 1] > rolled[i] < rolled[i + 1]:
            out.append(i)
    return [*out, len(lines)]


def chunks(text: str | None) -> list[tuple[int, str]]:
    """``(number of lines, text)`` of each chunk of a text; none of a null."""
    if text is None:
        return []
    lines = text.split("\n")
    bounds = chunk_bounds(lines)
    return [(b - a, "\n".join(lines[a:b])) for a, b in zip(bounds[:-1], bounds[1:])]


def _chunk_rows(docs: DataFrame) -> DataFrame:
    """``(h, doc_id, chunk)`` of every multi-line chunk."""

    def cut(batches):
        for batch in batches:
            hashes, ids, places = [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                for i, (count, body) in enumerate(chunks(text.as_py()) if doc is not None else ()):
                    if count > 1:
                        digest = blake2b(body.encode("utf-8", "surrogatepass"), digest_size=8)
                        hashes.append(int.from_bytes(digest.digest(), "big", signed=True))
                        ids.append(doc)
                        places.append(i)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes, pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(places, pa.int32()),
                ],
                ["h", "doc_id", "chunk"],
            )

    return docs.select("doc_id", "text").mapInArrow(cut, "h bigint, doc_id bigint, chunk int")


def _repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, drop)``: the chunks of each document that an earlier place holds too.

    Hashes only propose. The texts of proposed chunks are grouped as they are, so two
    chunks are the same when their bytes are.
    """
    rows = stored(_chunk_rows(docs), "chunks")
    # Stored, so that a hot hash is split in the join instead of kept with its count.
    counts = rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    salts = F.ceil(F.col("n") / COPIES_PER_TASK).cast("int")
    often = stored(counts.select("h", salts.alias("salts")), "often")
    wanted = F.collect_set(F.struct("chunk", "salts"))
    proposed = rows.join(often, "h").groupBy("doc_id").agg(wanted.alias("wanted"))

    def bodies(batches):
        for batch in batches:
            texts, ids, places, salts = [], [], [], []
            for doc, text, wanted in zip(*(batch.column(c) for c in ("doc_id", "text", "wanted"))):
                own = chunks(text.as_py())
                for row in wanted.as_py():
                    texts.append(own[row["chunk"]][1])
                    ids.append(doc.as_py())
                    places.append(row["chunk"])
                    salts.append(row["salts"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(texts, pa.string()),
                    pa.array(ids, pa.int64()),
                    pa.array(places, pa.int32()),
                    pa.array(salts, pa.int32()),
                ],
                ["body", "doc_id", "chunk", "salts"],
            )

    joined = docs.join(proposed, "doc_id").select("doc_id", "text", "wanted")
    shape = "body string, doc_id bigint, chunk int, salts int"
    texts = stored(joined.mapInArrow(bodies, shape), "bodies")
    first = (
        texts.groupBy("body")
        .agg(
            F.min(F.struct("doc_id", "chunk")).alias("kept"),
            F.count("*").alias("n"),
            F.max("salts").alias("salts"),
        )
        .where("n > 1")
        .select("body", "kept", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    )
    # Copies of a hot chunk are dealt to several tasks, each of which gets its first place.
    salted = texts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "chunk"), F.col("salts")).cast("int"))
    later = salted.join(first, ["body", "salt"]).where(F.struct("doc_id", "chunk") > F.col("kept"))
    return later.groupBy("doc_id").agg(F.collect_set("chunk").alias("drop"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated chunks cut from ``text``, and ``n_lines``, ``n_removed``.

    Texts are split at newlines, lines grouped into chunks by ``chunk_bounds``. A chunk
    of two lines or more whose bytes also occur at an earlier place, by doc_id and then
    by position, is taken out; the first occurrence stays. Single lines stay.

    All rows and columns stay; columns called n_lines or n_removed are replaced. A null
    text stays null and has 0 lines, an empty one has 1. Rows with a null doc_id are
    left alone. Rows that share a doc_id are one document and should be equal; all are
    cut alike. Text columns travel twice by doc_id, proposed chunks once by their text;
    the occurrences of a chunk meet only in a partial aggregate and a join.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    drops = _repeats(plain)
    mark = "drop"
    while mark in kept:
        mark += "_"
    drops = drops.withColumnRenamed("drop", mark)
    joined = docs.select(*kept).join(drops, "doc_id", "left").select(*kept, mark)

    def cut(batches):
        for batch in batches:
            texts, lines, removed = [], [], []
            for text, drop in zip(batch.column("text"), batch.column(mark)):
                text, drop = text.as_py(), drop.as_py()
                count = 0 if text is None else text.count("\n") + 1
                gone = 0
                if drop:
                    own, drop = chunks(text), set(drop)
                    gone = sum(own[i][0] for i in drop)
                    text = "\n".join(body for i, (_, body) in enumerate(own) if i not in drop)
                texts.append(text)
                lines.append(count)
                removed.append(gone)
            columns = [
                pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in kept
            ]
            columns += [pa.array(lines, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_lines", "n_removed"])

    shape = T.StructType(
        [docs.schema[c] for c in kept]
        + [T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())]
    )
    return joined.mapInArrow(cut, shape)


#: The same in DuckDB.
LINES_SQL = """
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i,
         len(string_split(text, chr(10))) AS n
  FROM documents),
hashed AS (SELECT *, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM lines),
rolled AS (
  SELECT *, (31 * coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0) + h) % 4294967296 AS r
  FROM hashed),
cuts AS (
  SELECT *, CASE WHEN i > 2 AND i < n AND r < lag(r) OVER (PARTITION BY doc_id ORDER BY i)
                  AND r < lead(r) OVER (PARTITION BY doc_id ORDER BY i) THEN 1 ELSE 0 END AS cut
  FROM rolled),
numbered AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id ORDER BY i) AS chunk FROM cuts),
chunks AS (
  SELECT doc_id, chunk, count(*) AS k, string_agg(line, chr(10) ORDER BY i) AS body
  FROM numbered GROUP BY doc_id, chunk),
marked AS (
  SELECT *, k > 1 AND row_number() OVER (PARTITION BY body, k > 1 ORDER BY doc_id, chunk) > 1 AS gone
  FROM chunks),
cleaned AS (
  SELECT doc_id, CAST(sum(k) AS BIGINT) AS n_lines,
         CAST(coalesce(sum(k) FILTER (WHERE gone), 0) AS BIGINT) AS n_removed,
         coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (WHERE NOT gone), '') AS text
  FROM marked GROUP BY doc_id)
"""
