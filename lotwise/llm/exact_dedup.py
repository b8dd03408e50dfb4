"""Exact deduplication of documents.

Rows group by a 128-bit content hash; only groups of more than one row are looked at
again, by their bytes, so that two texts with one hash stay apart. Null text counts as
empty, rows that repeat id and text are copies of each other, an empty table gives an
empty result, other columns are carried untouched. A null id is smaller than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import ROW, carried, hash128, restored, text_or_empty
from lotwise.sources.scratch import stored


def classes(docs: DataFrame, id_col: str = "doc_id", text: Column | None = None) -> DataFrame:
    """``(h1, h2, text_sha256, keep_id, group_size)`` of the texts that occur more than once.

    Counting by hash moves no text. The texts of repeated hashes then group by hash and
    bytes; copies combine in the map tasks, so a text of a third of the rows is one row a task.
    """
    text = text_or_empty() if text is None else text
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    hashed = rows.select("_id", "_text", *hash128(F.col("_text")))
    # Stored, both sides of each join are plain shuffles, which adaptive execution can split.
    repeated = stored(
        hashed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    # New names for the hashes, else the copies would be grouped where the join left them.
    found = hashed.join(repeated, ["h1", "h2"], "left_semi").select(
        "_id", "_text", (F.col("h1") + F.lit(0)).alias("g1"), (F.col("h2") + F.lit(0)).alias("g2")
    )
    return stored(
        found.groupBy("g1", "g2", "_text")
        .agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
        .select(
            F.col("g1").alias("h1"),
            F.col("g2").alias("h2"),
            F.sha2("_text", 256).alias("_sha"),
            "keep_id",
            "group_size",
        )
    )


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text: Column | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    The largest id of equal texts stays. Rows that repeat the kept id are all marked kept.
    """
    text = text_or_empty() if text is None else text
    hashed = docs.select(
        F.col(id_col).alias("_id"), F.sha2(text, 256).alias("_sha"), *hash128(text)
    )
    found = hashed.join(classes(docs, id_col, text), ["h1", "h2", "_sha"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("_id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents with one row left of each text, with the columns of ``docs``.

    Rows that tie in id and text keep one of them. Other columns come back as they are.
    """
    text = text_or_empty()
    found = classes(docs, id_col).select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "_sha", "keep_id"
    ).withColumn("_found", F.lit(True))
    h1, h2 = hash128(text)
    marked = carried(docs, id_col).withColumns({"_h1": h1, "_h2": h2, "_sha": F.sha2(text, 256)}).join(
        found, ["_h1", "_h2", "_sha"], "left"
    )
    own = ["doc_id", "text", ROW]
    alone = marked.filter(F.col("_found").isNull()).select(*own)
    firsts = (
        marked.filter(F.col("_found") & F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .dropDuplicates(["_h1", "_h2", "_sha"])
        .select(*own)
    )
    return restored(alone.unionByName(firsts), docs.columns, id_col=id_col)
