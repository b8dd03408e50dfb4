"""Quantile sketches as columns, merged in two levels.

A sketch of the first level is that of a group in one of ``SALTS`` sets of map tasks; the
second level merges the at most ``SALTS`` sketches of a group. So no reducer reads a sketch
of every map task, however many there are, and every sketch has a bounded size.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Entries that a sketch holds before it starts to round: groups up to this size are exact.
SIZE = 32_768
SALTS = 64


def rank_error(size: int = SIZE) -> float:
    """Rank error as a share of the group that a sketch keeps to in 99 of 100 cases."""
    return 2.296 / size**0.9723


def sketched(
    df: DataFrame,
    by: Sequence[str],
    values: Mapping[str, Column],
    sums: Mapping[str, Column] | None = None,
    size: int = SIZE,
    salts: int = SALTS,
) -> DataFrame:
    """``by``, a sketch of each of ``values`` and the sum of each of ``sums`` by group.

    Null and NaN do not enter a sketch. Without ``by`` the result is one row, even for no
    rows.
    """
    sums = dict(sums or {})
    salted = df.select(
        *by,
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("_salt"),
        *(value.cast("double").alias(name) for name, value in values.items()),
        *(value.alias(name) for name, value in sums.items()),
    )
    parts = salted.groupBy(*by, "_salt").agg(
        *(F.kll_sketch_agg_double(name, F.lit(size)).alias(name) for name in values),
        *(F.sum(name).alias(name) for name in sums),
    )
    return parts.groupBy(*by).agg(
        *(F.kll_merge_agg_double(name, F.lit(size)).alias(name) for name in values),
        *(F.sum(name).alias(name) for name in sums),
    )


def sketch_size(sketch: str) -> Column:
    """Values in the sketch."""
    return F.kll_sketch_get_n_double(sketch)


def sketch_quantiles(sketch: str, ranks: Sequence[float]) -> Column:
    """Array of values of the column, one for each rank from 0 to 1; null for an empty sketch."""
    asked = F.array(*(F.lit(float(rank)) for rank in ranks))
    return F.when(sketch_size(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, asked))


def sketch_median(sketch: str) -> Column:
    """The lower median, a value of the column; null for an empty sketch."""
    return sketch_quantiles(sketch, [0.5])[0]
