"""Near-duplicate links of vectors: iterative quantisation and multi-index Hamming tables.

A rotation learned on a bounded sample turns a vector into balanced bits. The bits are cut
into substrings, one per table; vectors that agree in a substring meet in a bucket and are
compared by their original components in double precision. Substrings lengthen with the
number of vectors, so that buckets stay small, and the number of tables follows from the
recall wanted at the threshold itself; closer pairs are found more surely.

Equal vectors collapse to one with a weight. A bucket is compared by matrix products, in
blocks where it is large; a pair counts only in the first table that it shares, and only
link counts and components leave a block, never pairs.

Vectors that are null, zero or hold null or non-finite components, and rows without an id,
link with nothing. Shorter vectors are padded with zeros. Rows that repeat an id and its
vector are one vector; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import ROOT, components, hash128, map_arrow, small_batches
from lotwise.sources.scratch import stored

THRESHOLD = 0.95
RECALL = 0.995
SAMPLE = 20_000
BUCKET = 512
BLOCK = 1024
ROUNDS = 30


def learn_rotation(sample: np.ndarray, seed: int) -> np.ndarray:
    """An orthogonal matrix whose signs split the sample evenly with little loss."""
    _, _, axes = np.linalg.svd(sample, full_matrices=False)
    axes = np.vstack([axes, np.eye(sample.shape[1])])[: sample.shape[1]] if len(axes) < sample.shape[1] else axes
    start, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(sample.shape[1],) * 2))
    projected, rotation = sample @ axes.T, start
    for _ in range(ROUNDS):
        bits = np.where(projected @ rotation >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(projected.T @ bits)
        rotation = u @ v
    return axes.T @ rotation


def table_plan(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits per substring and number of tables for ``n`` vectors."""
    bits = max(4, math.ceil(math.log2(max(1, n / BUCKET))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def _unit(vectors: np.ndarray) -> np.ndarray:
    # The largest component first: squares of very large or small ones stay finite.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def distinct_vectors(
    embeddings: DataFrame, id_col: str = "vec_id", vector: str = "embedding"
) -> tuple[DataFrame, DataFrame]:
    """``(vec_id, h1, h2, valid)`` of all rows; ``(rep, weight, vector)`` of distinct valid vectors."""
    value = F.col(vector)
    finite = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    nonzero = F.exists(value, lambda x: x != 0)
    valid = F.coalesce(F.col(id_col).isNotNull() & finite & nonzero, F.lit(False))
    rows = embeddings.select(
        F.col(id_col).alias("vec_id"), value.alias("vector"), valid.alias("valid"), *hash128(value)
    )
    signed = stored(rows.drop("vector"))
    groups = (
        signed.filter("valid")
        .select("vec_id", "h1", "h2")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    )
    reps = rows.filter("valid").join(
        groups.select(F.col("rep").alias("vec_id"), "h1", "h2", "weight"), ["vec_id", "h1", "h2"]
    )
    # An id with several vectors stands for each of them: nodes are told apart by hash.
    reps = reps.dropDuplicates(["vec_id", "h1", "h2"])
    return signed, stored(
        reps.select(F.col("vec_id").alias("rep"), "h1", "h2", "weight", "vector")
    )


def _coded(reps: DataFrame, width: int, rotations: np.ndarray, bits: int, tables: int) -> DataFrame:
    """``reps`` with packed vector and the substring of each table."""
    shared = reps.sparkSession.sparkContext.broadcast(rotations)
    powers = 1 << np.arange(bits, dtype=np.int64)
    names = ["rep", "weight", "vec", "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            vectors = _matrix(batch.column(2).to_pylist(), width)
            signs = _unit(vectors) @ shared.value >= 0
            keys = signs[:, : bits * tables].reshape(-1, tables, bits) @ powers
            offsets = np.arange(0, keys.size + 1, tables, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                ],
                names=names,
            )

    return map_arrow(
        reps.select("rep", "weight", "vector"), run, "rep long, weight long, vec binary, keys array<long>"
    )


def _compare(frame: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Weighted link counts and in-block component of each vector of a bucket or block pair."""
    table = int(frame["t"].iloc[0])
    two = frame["side"].nunique() > 1
    keys = np.stack(frame["keys"].to_numpy())
    unit = _unit(np.stack([np.frombuffer(v, "<f8") for v in frame["vec"]]))
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    for earlier in range(table):
        linked &= keys[:, earlier, None] != keys[None, :, earlier]
    if two:
        side = frame["side"].to_numpy()
        linked &= side[:, None] != side[None, :]
    weight, label = frame["weight"].to_numpy(), np.arange(len(frame))
    has = linked.any(axis=1)
    while True:
        low = np.where(linked, label[None, :], len(frame)).min(axis=1, initial=len(frame))
        low = np.minimum(label, low)
        low = low[low]
        if (low == label).all():
            break
        label = low
    rep = frame["rep"].to_numpy()
    out = pd.DataFrame({"rep": rep, "n": linked @ weight, "peer": rep[label]})
    return out[has]


def link_vectors(
    embeddings: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row."""
    spark = embeddings.sparkSession
    signed, reps = distinct_vectors(embeddings, id_col, vector)
    # A node is an id; where one id has several distinct vectors each keeps its own weight.
    size = reps.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not size.n:
        return signed.select(
            "vec_id",
            F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    bits, tables = table_plan(size.n, threshold, recall)
    sample = reps.orderBy(F.xxhash64("rep", F.lit("fit"))).limit(SAMPLE).select("vector").collect()
    unit = _unit(_matrix([r.vector for r in sample], size.width))
    count = -(-bits * tables // size.width)
    rotations = np.hstack([learn_rotation(unit, seed) for seed in range(count)])
    coded = stored(_coded(reps, size.width, rotations, bits, tables))
    posted = coded.select("*", F.posexplode("keys").alias("t", "key"))
    large = (
        posted.groupBy("t", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > BLOCK)
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("long"))
        .drop("n")
    )
    blocks = F.coalesce("blocks", F.lit(1))
    placed = posted.join(large, ["t", "key"], "left").withColumn(
        "own", F.pmod(F.xxhash64("rep"), blocks)
    )
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), blocks - 1),
        lambda o: F.struct(
            F.least(F.col("own"), o).alias("i"),
            F.greatest(F.col("own"), o).alias("j"),
            F.when(F.col("own") == o, F.lit(0)).when(F.col("own") < o, F.lit(1)).otherwise(F.lit(2)).alias("side"),
        ),
    )
    dealt = placed.withColumn("b", F.explode(pairs)).select(
        "t", "key", "b.i", "b.j", "b.side", "rep", "weight", "vec", "keys"
    )
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    found = stored(
        dealt.groupBy("t", "key", "i", "j").applyInPandas(
            lambda frame: _compare(frame, threshold), "rep long, n long, peer long"
        )
    )
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    linked = components(found, "rep", "peer")
    by_vector = (
        reps.select("rep", "h1", "h2", "weight")
        .join(counts, "rep", "left")
        .join(linked.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "h1",
            "h2",
            F.lit(True).alias("valid"),
            (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    joined = signed.join(by_vector, ["h1", "h2", "valid"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
