"""Exact deduplication against a stored index of text digests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairsift.llm.common import kept, whole_text
from pairsift.manifests import files_of, read_note, write_note
from pairsift.stages import new_folder

NOTE = "_index"


class DigestIndex:
    """Digests of all texts seen so far: ``digest, keep_id, batch``, one row per text.

    The table is bucketed and sorted by digest in a folder that all machines
    share. Digests of new data are summed up per text first, so a bucket gets one
    row per text; they meet the index in a sort-merge anti-join that shuffles the
    new rows only, and what is new is appended in the same buckets. Their number is noted
    in the folder, as a digest is only met in its own bucket.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, buckets: int | None = None):
        """Opens the index of a folder, or begins one there.

        ``buckets`` is for a new index; the default is the session's number of shuffle
        partitions, so that a sum by digest lands in buckets. An index that exists keeps
        the number it was begun with, and another one given here is an error; so is an
        index whose folder has rows and no note, unless ``buckets`` says what it has.
        """
        self.spark = spark
        self.folder = folder or new_folder(spark, "digest_index")
        noted = read_note(spark, self.folder, NOTE)
        if noted is None:
            if buckets is None and files_of(spark, [self.folder]):
                raise ValueError(f"{self.folder} holds an index without a note of its buckets: name their number")
            noted = {"buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))}
            write_note(spark, self.folder, noted, NOTE)
        self.buckets = noted["buckets"]
        if buckets not in (None, self.buckets):
            raise ValueError(f"{self.folder} has {self.buckets} buckets, not {buckets}")
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
            f" LOCATION '{self.folder}'"
        )

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Adds the texts of ``groups`` (``digest, keep_id``) that are not in the index."""
        fresh = groups.hint("merge").join(self.rows().hint("merge"), "digest", "left_anti")
        fresh.select("digest", "keep_id", F.lit(batch).alias("batch")).write.insertInto(self.name)

    def close(self) -> None:
        """Forgets the table's name; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def dedup(
    docs: DataFrame,
    index: DigestIndex | None = None,
    batch: str = "1",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    Texts are equal if they are identical, a null text counting as empty. Of equal
    texts in one batch the largest ``doc_id`` stays (a null id only if the group has
    no other); a text that an earlier batch brought stays with that batch, and all
    rows here go. Rows that repeat both text and id are one document: all are marked
    alike (:func:`survivors` keeps one of them). ``group_size`` counts the batch's
    rows with the text. Adding a batch again under its own name changes nothing.
    Without an ``index`` the batch is compared with itself, in an index of its own.
    An empty table gives an empty result; other columns are not read.
    """
    own_index = index is None
    index = index or DigestIndex(docs.sparkSession)
    digest = F.unhex(F.sha2(F.encode(whole_text(text), "UTF-8"), 256))
    rows = kept(
        docs.select(digest.alias("digest"), F.col(doc_id).cast("long").alias("doc_id")), "digests"
    )
    groups = rows.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    index.append(groups.select("digest", "keep_id"), batch)
    stays = index.rows().select(
        "digest", "keep_id", (F.col("batch") == batch).alias("own")
    )
    decided = kept(groups.drop("keep_id").join(stays, "digest"), "texts")
    if own_index:
        index.close()
    # A text may own a third of the rows; over a stored table this is a plain join,
    # whose large partitions adaptive execution splits.
    return rows.join(decided, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("own") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def survivors(
    docs: DataFrame, index: DigestIndex | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; one of rows repeated in id and text.

    A null text counts as empty; of equal texts the row with the largest id stays, one
    without an id only if there is no other. An empty table gives an empty result; columns
    of any other name are carried along.
    """
    stays = dedup(docs, index, doc_id=doc_id, text=text).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_digest")
    ).distinct()
    digest = F.sha2(F.encode(whole_text(text), "UTF-8"), 256)
    marked = docs.select(
        digest.alias("_digest"), F.col(doc_id).cast("long").alias("_id"), F.struct("*").alias("_row")
    )
    same = F.col("d._digest").eqNullSafe(F.col("s._digest")) & F.col("d._id").eqNullSafe(F.col("s._id"))
    found = marked.alias("d").join(stays.alias("s"), same, "left_semi")
    # Partitioned by digest and id already: no text travels twice.
    return found.dropDuplicates(["_digest", "_id"]).select("_row.*")
