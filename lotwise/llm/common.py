"""What the text operators share: text defaults, hashes, Python stages, link components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.sources.scratch import stored

ROOT = str(Path(__file__).resolve().parents[2])
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def hash128(value: Column) -> tuple[Column, Column]:
    """Two differently seeded 64-bit hashes, as two long columns."""
    return F.xxhash64(value).alias("h1"), F.xxhash64(F.lit("2nd"), value).alias("h2")


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with this library importable by the workers."""
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return df.mapInArrow(function, schema)


def map_groups(df: DataFrame, key: str, function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``function`` on the rows of each ``key``, a long that is never null.

    As ``applyInArrow`` does it, but that loads pandas, which every worker would keep in memory.
    """
    at = df.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = batch.column(at).to_numpy()
            bounds = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for first, end in zip(bounds, bounds[1:]):
                if first == end:
                    continue
                if held and keys[first] != last:
                    yield from function(pa.Table.from_batches(held)).to_batches()
                    held = []
                held.append(batch.slice(first, end - first))
                last = keys[first]
        if held:
            yield from function(pa.Table.from_batches(held)).to_batches()

    return map_arrow(df.repartition(key).sortWithinPartitions(key), run, schema)


def small_batches(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes at most, one row at least: long texts come few at a time."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        step = max(1, batch.num_rows * limit // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return [t or "" for t in column.to_pylist()]


ROW = "_row"


def carried(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text`` and all other columns in one struct, where no name can clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text)]
    row = F.struct(*others) if others else F.struct(F.lit(None).cast("string").alias("nothing"))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), row.alias(ROW))


def restored(
    found: DataFrame,
    names: list[str],
    changed: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The columns ``names`` out of rows of ``carried``; ``changed`` replaces some by name."""
    own = {id_col: F.col("doc_id"), text: F.col("text"), **(changed or {})}
    return found.select(*(own.get(n, F.col(ROW).getField(n)).alias(n) for n in names))


def checksum(df: DataFrame) -> tuple[int, int]:
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("s"),
    ).first()
    return row.n, row.s


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of a link, component the smallest node reachable.

    Alternates pointing larger neighbours, then smaller ones, to the smallest neighbour
    until nothing changes, in a number of rounds that grows with the logarithm of the
    longest path. Minima combine before the shuffle, so a node with very many links costs
    a row per task; joins on a node are split by adaptive execution.
    """
    edges = stored(
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    before = checksum(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        edges = stored(
            joined.filter("v > m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(joined.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = checksum(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def uint64_rows(values: np.ndarray) -> pa.Array:
    """Unsigned hashes as Spark's signed longs."""
    return pa.array(values.view(np.int64))

