r"""Removal of lines that many documents share, with built-in functions only.

A text is split at ``\n``; a line's key is the line without ASCII white space at its ends
and with A-Z in lower case. Keys of ``min_chars`` code points or more that occur in
``min_docs`` documents or more lose all their lines everywhere; other lines stay, joined
by ``\n``. Rows that repeat an id count as one document; rows without an id count as none,
as in ``count(DISTINCT doc_id)``. Every row is in the result. Null or empty text is one
empty line; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import hash128, text_or_empty
from lotwise.sources.scratch import stored

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def frequent_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id"
) -> DataFrame:
    """``(h1, h2)``: 128-bit hashes of the keys found in ``min_docs`` documents or more.

    Ids are made distinct under hash and id, which spreads a common line over all tasks; the
    count by hash then combines in the map tasks.
    """
    keys = F.array_distinct(F.transform(lines_of(text_or_empty()), line_key))
    return (
        docs.filter(F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("_id"), F.explode(keys).alias("key"))
        .filter(F.length("key") >= min_chars)
        .select("_id", *hash128(F.col("key")))
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
        .drop("n_docs")
    )


def drop_frequent_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id"
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_dropped``.

    Only line hashes and positions are shuffled to find the lines to drop; a line of a
    third of the documents is one row per map task in the count and a skewed join key that
    adaptive execution splits. Texts are shuffled once, by document, to be reassembled.
    Rows are told apart by id and hash of the text: equal rows lose the same lines.
    """
    # Stored, so that the join's sides are plain shuffles, which adaptive execution can split.
    frequent = stored(frequent_lines(docs, min_docs, min_chars, id_col))
    rows = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text_or_empty()).alias("_th"),
        F.posexplode(lines_of(text_or_empty())).alias("_pos", "_line"),
    )
    lines = (
        rows.select("_id", "_th", "_pos", line_key(F.col("_line")).alias("_key"))
        .filter(F.length("_key") >= min_chars)
        .select("_id", "_th", "_pos", *hash128(F.col("_key")))
    )
    dropped = (
        lines.join(frequent, ["h1", "h2"], "left_semi")
        .groupBy("_id", "_th")
        .agg(F.collect_set("_pos").alias("_dropped"))
    )
    left = docs.withColumn("_th2", F.xxhash64(text_or_empty()))
    joined = left.join(
        dropped, left[id_col].eqNullSafe(dropped["_id"]) & (F.col("_th2") == F.col("_th")), "left"
    )
    lines_now = lines_of(text_or_empty())
    kept = F.when(F.col("_dropped").isNull(), text_or_empty()).otherwise(
        F.array_join(_without(lines_now, F.col("_dropped")), "\n")
    )
    return joined.withColumns(
        {
            "kept_text": kept,
            "n_lines": F.size(lines_now).cast("long"),
            "n_dropped": F.coalesce(F.size("_dropped"), F.lit(0)).cast("long"),
        }
    ).drop("_id", "_th", "_th2", "_dropped")


def _without(lines: Column, dropped: Column) -> Column:
    """Lines between the sorted dropped positions, in linear time."""
    ends = F.concat(F.sort_array(dropped), F.array(F.size(lines)))
    starts = F.concat(F.array(F.lit(0)), F.transform(F.sort_array(dropped), lambda p: p + 1))
    return F.flatten(
        F.zip_with(starts, ends, lambda s, e: F.slice(lines, s + 1, e - s))
    )


def digest(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    return drop_frequent_lines(docs.select("doc_id", "text"), min_docs, min_chars).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )
