"""Exact de-duplication against a persistent digest index.

The index is a table bucketed and sorted by digest. New rows are grouped by digest first (a
partial ``min``, so a text with many copies is one row per task), sort-merge anti-joined with the
index bucket by bucket, and what is new is appended. Texts themselves are never shuffled: a
row's digest is SHA-256 over the normalised text, and equal digests count as equal texts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, materialize, shuffle_width


def text_digest(text: Column) -> Column:
    """SHA-256 (hex) of the text with each run of blanks as one space; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS + "+", " ").cast("binary"), 256)


class DigestIndex:
    """A catalog table (digest, keep_id, row_key), bucketed and sorted by digest.

    ``keep_id`` is the id of the first row that came with the text: the smallest id of the batch
    that brought it (null only if all had none). ``row_key`` tells repeated rows with that id apart.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark = spark
        self.table = table
        self.buckets = buckets or shuffle_width(spark)
        self._version = 0

    @property
    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def fresh(self, digests: DataFrame) -> DataFrame:
        """The rows of ``digests`` (digest, keep_id, row_key; one per digest) that the index lacks."""
        if not self.exists:
            return digests
        return digests.hint("merge").join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, fresh: DataFrame) -> None:
        writer = (
            fresh.select("digest", "keep_id", "row_key").repartition(self.buckets, "digest").write
            .bucketBy(self.buckets, "digest").sortBy("digest").format("parquet")
        )
        writer.mode("append").saveAsTable(self.table)

    def ingest(self, rows: DataFrame) -> None:
        """Add the texts of a batch (doc_id, row_key, digest) that the index has not seen.

        A batch is one job: lost executors re-run tasks, and a failed append leaves no files, so
        the same batch may be given again. Ingesting a batch twice adds nothing.
        """
        first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("first")
        digests = rows.groupBy("digest").agg(first).select(
            "digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row_key").alias("row_key"))
        # the index is read and appended to: the difference is written out in between
        self.append(materialize(self.fresh(digests)) if self.exists else digests)


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, row_key) of every row, as a table: one pass over the texts.

    ``row_key`` numbers rows; it is fixed once written and only separates repeated rows.
    """
    return materialize(docs.select(
        F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest"),
        F.monotonically_increasing_id().alias("row_key")))


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id",
                text_col: str = "text", cuts: list[int] | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows go into the index in batches split at the ids of ``cuts`` (rising), smallest ids first
    and rows without an id last, so of equal texts the smallest id stays. Nulls count as empty
    texts; a repeated row (same id and text) stays once; an empty table gives an empty result.
    Other columns of ``docs`` are not looked at, whatever their names.
    """
    spark = docs.sparkSession
    index = index or DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")
    rows = digest_rows(docs, id_col, text_col)
    edges = [None, *(cuts or []), None]
    for low, high in zip(edges, edges[1:]):
        part = rows
        if low is not None:
            part = part.filter(F.col("doc_id").isNull() | (F.col("doc_id") >= low))
        if high is not None:
            part = part.filter(F.col("doc_id") < high)
        index.ingest(part)
    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    # written out, so that the join below stands alone in its stage and Spark can split a hot digest
    known = materialize(index.read().select("digest", "keep_id", F.col("row_key").alias("keep_row")).join(sizes, "digest"))
    return rows.join(known, "digest").select(
        "doc_id", "keep_id", "group_size",
        (F.col("row_key") == F.col("keep_row")).alias("kept"), F.col("digest").alias("text_sha256"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    span = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    # two batches, so that the second meets a filled index
    cuts = [(span[0] + span[1]) // 2 + 1] if span[0] is not None and span[0] < span[1] else None
    return deduplicate(docs, cuts=cuts)


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       min(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept,
       text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
