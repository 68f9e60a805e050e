"""Exact dedup against a persistent digest index.

The index is a Parquet table in ``buckets`` buckets by digest, sorted by digest within each, with
a row per text ever accepted, and one more where a longer document took its place. A batch of documents is reduced to one row per digest and
merged against the index by a sort-merge anti-join that does not move the index; what the index
lacks is appended to it in the same layout. A whole table is taken in a few batches in the order of its ids;
there a later, longer document of a text that the index holds is appended too, and the best row of a digest counts.

Texts are equal when they are identical after deleting every space and control character of
``[\\x20\\x09-\\x0D]``. Of equal texts in a batch the one with the most code points stays, then the
one with the smallest id; a text that the index holds already loses to the indexed document.

Defined cases: a null text is empty; rows whose ``doc_id`` is null take no part; a row that is
repeated under one id counts in ``group_size`` but is one document; an empty table gives an
empty result; columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import as_rows, shared_path, stored, whole_text
from wayfare.sources.files import Files

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
# Digest rows a bucket should hold at most; about 128 MB of them.
ROWS_PER_BUCKET = 2_000_000
# Hidden from Spark's readers.
LAYOUT = "_layout.json"
# Batches that a whole table is taken in.
BATCHES = 4


class DigestIndex:
    """Digests of the accepted texts in a folder; opening an existing folder finds what it holds, in the buckets it has.

    The number of buckets is kept beside the data: ``buckets`` counts for a new index only.
    """

    SCHEMA = "digest string, keep_id long, keep_chars long"

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        files = Files(spark, path)
        files.create(LAYOUT, json.dumps({"buckets": buckets, "by": "digest"}))
        buckets = json.loads(files.text(LAYOUT))["buckets"]
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} ({self.SCHEMA}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def best(self) -> DataFrame:
        """One row per digest: the document that stays. Buckets hold whole digests, so no row moves."""
        return winners(self.rows().withColumnsRenamed({"keep_id": "doc_id", "keep_chars": "n_chars"})).drop("group_size")

    def missing(self, winners: DataFrame) -> DataFrame:
        """Rows of ``winners`` (one per digest) whose digest the index lacks."""
        return winners.hint("merge").join(self.rows().select("digest"), "digest", "left_anti")

    def append(self, new: DataFrame) -> None:
        """Add rows, one file per bucket and append."""
        (new.select("digest", "keep_id", "keep_chars")
         .repartition(self.buckets, "digest")
         .write.mode("append").format("parquet").option("compression", "zstd")
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))
        self.spark.catalog.refreshTable(self.name)


def new_index(spark: SparkSession, expected_rows: int) -> DigestIndex:
    """An empty index in the shared folder, with buckets for the rows it will have to hold."""
    return DigestIndex(spark, shared_path(spark, "digest-index"), max(8, -(-expected_rows // ROWS_PER_BUCKET)))


def digests(docs: DataFrame) -> DataFrame:
    text = whole_text()
    return docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(F.translate(text, BLANKS, ""), 256).alias("digest"),
        F.length(text).cast("long").alias("n_chars"))


def winners(rows: DataFrame) -> DataFrame:
    """``digest, keep_id, keep_chars, group_size``: per digest the longest row, then the one of the smallest id."""
    return rows.groupBy("digest").agg(
        F.max(F.struct("n_chars", (-F.col("doc_id")).alias("minus_id"))).alias("best"),
        F.count("*").alias("group_size")).select(
            "digest", (-F.col("best.minus_id")).alias("keep_id"),
            F.col("best.n_chars").alias("keep_chars"), "group_size")


def dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``, and add the new texts to the index.

    ``keep_id`` is the document that stays for this text: from this batch, or from the index if
    it has the text. ``group_size`` counts the rows of this batch with the text. A document that
    occurs more than once with the same text gives one row. A batch that is taken again, after a failure say, finds its own
    documents in the index, and they stay.
    """
    rows = stored(digests(docs), "digests")
    if index is None:
        index = new_index(docs.sparkSession, rows.count())
    # Partial aggregation leaves one row per task and digest, so a digest of many rows moves as few.
    groups = stored(winners(rows), "digest-groups")
    known = groups.select("digest", "group_size").hint("merge").join(index.best().select("digest", "keep_id"), "digest")
    fresh = stored(index.missing(groups), "fresh-digests")
    decided = stored(known.select("digest", "keep_id", "group_size").unionByName(
        fresh.select("digest", "keep_id", "group_size")), "decided-digests")
    index.append(fresh)
    # One decided row per digest, and documents of a large group on the other side: adaptive
    # execution splits that side's partition and repeats the single row.
    one = rows.select("doc_id", "digest", "n_chars").join(decided, "digest")
    return one.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def dedup_in_batches(docs: DataFrame, index: DigestIndex | None = None, batches: int = BATCHES) -> DataFrame:
    """As ``dedup`` of a whole table into an empty index, taken in ``batches`` ranges of ids one after the other.

    The anti-join finds the texts that a batch adds. Of those that the index holds, a batch's document
    is added where it is the better one, so that the last state decides as one batch would.
    """
    rows = stored(digests(docs), "digests")
    n, low, high = rows.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    if index is None:
        index = new_index(docs.sparkSession, n)
    edges = [low + (high - low + 1) * i // batches for i in range(batches)] + [high + 1] if n else []
    for start, end in zip(edges, edges[1:], strict=False):
        batch = stored(winners(rows.where(F.col("doc_id").between(start, end - 1))), "digest-groups")
        held = index.best().select("digest", F.col("keep_id").alias("held_id"), F.col("keep_chars").alias("held_chars"))
        better = batch.hint("merge").join(held, "digest").where(
            "keep_chars > held_chars OR keep_chars = held_chars AND keep_id < held_id").select(*batch.columns)
        index.append(stored(index.missing(batch).select(*batch.columns).unionByName(better), "fresh-digests"))
    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    decided = stored(index.best().select("digest", "keep_id").join(sizes, "digest"), "decided-digests")
    return rows.select("doc_id", "digest").join(decided, "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def kept_documents(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, with the columns of ``docs``; each text once.

    Rows of one id with equal text are one document: which of them stays makes no difference to
    the text. Ids under which the table repeats rows are rare; only those rows are compared.
    """
    labels = dedup(docs, index)
    kept = stored(labels.where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("times")), "kept-ids")
    own = F.sha2(F.translate(F.coalesce("row.text", F.lit("")), BLANKS, ""), 256)
    out = as_rows(docs).join(kept, (F.col("row.doc_id") == F.col("doc_id")) & (own == F.col("text_sha256")))
    if kept.where("times > 1").isEmpty():
        return out.select("row.*")
    # Of the rows of one id and text, the one with the most code points.
    more = out.where("times > 1").groupBy("doc_id", "text_sha256").agg(
        F.max_by("row", F.length(F.coalesce("row.text", F.lit("")))).alias("row"))
    return out.where("times = 1").select("row.*").unionByName(more.select("row.*"))
