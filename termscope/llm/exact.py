"""Exact dedup against a persistent index of text digests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termscope.sources.storage import new_path, stored

#: Fixed value: the characters that make no difference between texts.
_WHITE = "\x20\x09\x0a\x0b\x0c\x0d"

#: A digest with so many rows, and more than one in ten thousand of all, is hot. There
#: are never more than 10,000 hot ones, whatever the table.
_HOT_ROWS = 1000
_HOT_SHARE = 10_000

_ENTRY = (
    "digest binary, n_chars bigint, doc_id bigint, copies bigint, batch string, fresh boolean"
)


def text_digest(text: Column) -> Column:
    """SHA-256 in lowercase hex of a text without its white space; null is empty."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), _WHITE, "").cast("binary"), 256)


def _best() -> Column:
    """The row that stays: most code points, then least doc_id, a null one last.

    ``max`` of it is associative, so batches and partial aggregates may be merged.
    """
    return F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("reversed")))


def _merged(rows: DataFrame, copies: Column) -> DataFrame:
    """``(digest, n_chars, doc_id, copies)``, one row per digest."""
    found = rows.groupBy("digest").agg(_best().alias("_best"), copies.alias("copies"))
    return found.select(
        "digest",
        F.col("_best.n_chars").alias("n_chars"),
        F.bitwise_not("_best.reversed").alias("doc_id"),
        "copies",
    )


class DigestIndex:
    """A table of digests that outlives the session, bucketed and sorted by digest.

    An entry says what one batch knew of one digest: its best row and its number of
    rows. Entries are only appended, so a digest may have one of each batch; they merge
    by maximum and sum. A batch is written by one job, and a batch that is there already
    is not added again, so a job that was lost may simply be started once more.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} ({_ENTRY}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
            f"LOCATION '{path}/entries'"
        )

    @classmethod
    def create(
        cls, spark: SparkSession, path: str | None = None, buckets: int | None = None
    ) -> DigestIndex:
        """An empty index at ``path``, by default in the shared folder for this process.

        It has as many buckets as shuffles have partitions, unless told otherwise.
        """
        path = path or new_path(spark, "digest-index")
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        shape = spark.createDataFrame([(buckets,)], "buckets int")
        shape.coalesce(1).write.json(f"{path}/shape")
        return cls(spark, path, buckets)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> DigestIndex:
        """The index that an earlier session left at ``path``."""
        shape = spark.read.schema("buckets int").json(f"{path}/shape").first()
        return cls(spark, path, shape.buckets)

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def batches(self) -> list[str]:
        rows = self.entries().select("batch").distinct().collect()
        return sorted(row.batch for row in rows)

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` whose digest no batch brought before.

        A sort-merge anti-join: the index is read bucket by bucket as it lies, only the
        new rows are shuffled. Both sides have few rows a digest, so none is hot.
        """
        known = self.entries().select("digest").hint("merge")
        return batch.join(known, "digest", "left_anti")

    def add(self, digests: DataFrame, batch: str) -> bool:
        """Append what ``digests (digest, n_chars, doc_id)`` tells; False if it is there.

        Copies within the batch are merged before they are shuffled for the join.
        """
        if batch in self.batches():
            return False
        own = stored(_merged(digests, F.count("*")), "batch")
        fresh = self.unseen(own).withColumn("fresh", F.lit(True))
        again = own.join(
            self.entries().where("fresh").select("digest").hint("merge"), "digest", "left_semi"
        ).withColumn("fresh", F.lit(False))
        entries = fresh.unionByName(again).withColumn("batch", F.lit(batch))
        entries = stored(entries.select("digest", "n_chars", "doc_id", "copies", "batch", "fresh"), "new")
        (
            entries.repartition(self.buckets, "digest")
            .sortWithinPartitions("digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", f"{self.path}/entries")
            .saveAsTable(self.table)
        )
        return True

    def groups(self) -> DataFrame:
        """``(digest, n_chars, doc_id, copies)`` of all batches; no shuffle is needed."""
        return _merged(self.entries(), F.sum("copies"))


def _with_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with their group's columns; hot groups meet their rows without a shuffle."""
    groups = stored(
        groups.select(
            "digest",
            F.col("n_chars").alias("keep_chars"),
            F.col("doc_id").alias("keep_id"),
            F.col("copies").alias("group_size"),
        ),
        "groups",
    )
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    is_hot = F.col("group_size") >= max(_HOT_ROWS, -(-total // _HOT_SHARE))
    # At most 10,000 rows by its definition, so this broadcast has a bound.
    hot = F.broadcast(groups.where(is_hot))
    cold = rows.join(hot.select("digest"), "digest", "left_anti").join(
        groups.where(~is_hot), "digest"
    )
    return rows.join(hot, "digest").unionByName(cold)


def exact_duplicates(
    docs: DataFrame, index: DigestIndex | None = None, batches: int = 2
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``.

    Texts are equal when they are the same without white space. Of equal texts the row
    with the most code points stays, then the one of least doc_id. ``index`` holds what
    came before, which counts too; without one, a new index is made. The rows come in
    ``batches`` by hash of doc_id: each is deduplicated against the index by an anti-join
    and appended, so none has to be larger than a batch can be.

    A null text counts as empty. Rows with a null doc_id lose ties; a group of these alone
    has a null keep_id. Rows that share doc_id and length are the same document: all of
    them count in group_size, and all or none are kept. Other columns are not looked at.
    Runs jobs when it is called.
    """
    spark = docs.sparkSession
    index = index or DigestIndex.create(spark)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.length(text).cast("bigint").alias("n_chars"),
        F.unhex(text_digest(text)).alias("digest"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(batches)).alias("_batch"),
    )
    rows = stored(rows, "digests")
    name = uuid.uuid4().hex
    for i in range(batches):
        index.add(rows.where(F.col("_batch") == i), f"{name}-{i}")
    found = _with_groups(rows.drop("_batch"), index.groups())
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows without an id stay."""
    found = exact_duplicates(docs, index)
    gone = found.where("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


#: The same in DuckDB.
EXACT_SQL = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS digest
  FROM documents),
placed AS (
  SELECT doc_id, digest, count(*) OVER (PARTITION BY digest) AS group_size,
         first_value(doc_id) OVER (PARTITION BY digest ORDER BY n DESC, doc_id) AS keep_id
  FROM texts)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, digest AS text_sha256 FROM placed"""
