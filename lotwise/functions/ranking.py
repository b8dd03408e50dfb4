"""Global ranks and quantile buckets without a single-partition window."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.sources.scratch import stored

_ROW_BITS = 33  # monotonically_increasing_id keeps the row within its partition there


def with_position(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``position`` (from 1) and ``n_rows``: rank in the order, and row count.

    Rows are range-partitioned and sorted, so equal leading values are split over
    tasks by the columns that follow; ``order`` must end in a unique column for the
    ranks to be reproducible. The sorted rows are stored once, because a second
    evaluation could sample other range boundaries. What remains is to add the
    size of the earlier partitions to the row number within each one. Spark may merge
    neighbouring small partitions, which keeps their order.
    """
    placed = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_spot", F.monotonically_increasing_id())
    ).withColumn("_slice", F.shiftright("_spot", _ROW_BITS))
    in_slice = F.col("_spot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))

    # One row per range partition, at most spark.sql.shuffle.partitions: safe to sort
    # in one task and to broadcast.
    everything = Window.partitionBy()
    sizes = (
        placed.groupBy(F.col("_slice").alias("_of"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_of",
            F.sum("_n").over(everything).alias("n_rows"),
            F.coalesce(
                F.sum("_n").over(
                    everything.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("_before"),
        )
    )
    return (
        placed.join(F.broadcast(sizes), F.col("_slice") == F.col("_of"))
        .withColumn("position", F.col("_before") + in_slice + 1)
        .drop("_spot", "_slice", "_of", "_before")
    )


def with_ntile(df: DataFrame, tiles: int, order: Sequence[str], name: str) -> DataFrame:
    """``ntile(tiles)`` over the whole frame: the first tiles take the remainder."""
    size = F.floor(F.col("n_rows") / tiles)
    longer = F.col("n_rows") % tiles
    in_longer = longer * (size + 1)
    tile = F.when(
        F.col("position") <= in_longer, F.ceil(F.col("position") / (size + 1))
    ).otherwise(longer + F.ceil(F.try_divide(F.col("position") - in_longer, size)))
    return (
        with_position(df, order)
        .withColumn(name, tile.cast("int"))
        .drop("position", "n_rows")
    )
