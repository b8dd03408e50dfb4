"""Exact medians and other quantiles, interpolated between the two values around the position.

Not to be mixed with those of ``sketches``, which return a value of the column.
"""

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.sketches import rank_error, sketch_size, sketched
from lotwise.sources.scratch import stored

SIZE = 4096
# Rank errors of a sketch between a bracket and the value it is for.
MARGIN = 6
# Rows of one bracket that one task may sort; wider ones are narrowed first.
BRACKET_ROWS = 2_000_000


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Interpolated quantiles per group, as ``by`` columns plus the array ``quantiles``.

    Nulls and NaN do not count; a group without values has no row; both zeros are 0.0.
    ``df`` is read twice and should be a stored table.
    """
    return exact_quantiles_of(df, [value], probs, by).drop("column")


def exact_quantiles_of(
    df: DataFrame,
    values: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    size: int = SIZE,
    bracket_rows: int = BRACKET_ROWS,
) -> DataFrame:
    """``by``, ``column`` and ``quantiles``: those of several columns in the same passes.

    The way is the same at every size, and no group is ever brought together:

    1. a sketch of each group and column brackets the values at the wanted ranks,
    2. where a bracket may hold more than ``bracket_rows`` rows, sketches of what lies in it
       narrow it, with the rows below counted, until none does,
    3. rows in the brackets are counted by value, rows between them by the bracket that
       follows, which combines before the shuffle; running counts over these few rows give
       the exact ranks.

    The last step sees whether a bracket missed its value, and then fails the job: margins are
    of several standard errors, so that no quantile is wrong and failure is not to be expected.
    """
    by, keys = list(by), ["column", *by]
    cells = F.array(*(F.struct(F.lit(v).alias("column"), F.col(v).cast("double").alias("_value")) for v in values))
    # Adding zero makes both zeros one.
    base = (
        df.select(*by, F.inline(cells))
        .filter(F.col("_value").isNotNull() & ~F.isnan("_value"))
        .withColumn("_value", F.col("_value") + F.lit(0.0))
    )
    asked = sorted(set(probs))
    brackets = _brackets(base, keys, asked, size, bracket_rows)
    return _picked(base, keys, brackets, asked).select(
        *keys, F.array(*(F.col("_picked")[asked.index(p)] for p in probs)).alias("quantiles")
    )


def _position(prob: float) -> Column:
    return (F.col("_rows") - 1) * F.lit(prob)


def _small(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` held for reuse: a row a column on the driver, a row a group in a stored table,
    whose true size lets Spark decide whether to broadcast it."""
    if keys == ["column"]:
        return F.broadcast(df.sparkSession.createDataFrame(df.collect(), df.schema))
    return stored(df)


def _joined(base: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    condition = reduce(
        Column.__and__, (F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys)
    )
    found = [F.col(f"r.{c}") for c in brackets.columns if c not in keys]
    return base.alias("l").join(brackets.alias("r"), condition).select(
        *(F.col(f"l.{k}") for k in keys), "l._value", *found
    )


def _brackets(base: DataFrame, keys: list[str], probs: list[float], size: int, most: int) -> DataFrame:
    """``keys, _rows``, and for each probability i the bracket ``_low{i}, _high{i}``."""
    first = sketched(base, keys, {"_all": F.col("_value")}, size=size)
    first = first.withColumn("_rows", sketch_size("_all")).withColumns(
        {f"_below{i}": F.lit(0).cast("long") for i in range(len(probs))}
    )
    everything = {f"_sketch{i}": F.col("_all") for i in range(len(probs))}
    limits = {f"_{side}{i}": F.lit(v) for i in range(len(probs)) for side, v in (("low", -math.inf), ("high", math.inf))}
    found = _small(_narrowed(first.withColumns(everything | limits), keys, probs, size), keys)
    widest = math.inf
    while True:
        still = found.agg(F.max(F.greatest("_widest", F.lit(0)))).first()[0] or 0
        if still <= most or still >= widest:  # ties alone may keep a bracket as it is
            return found.drop("_widest")
        widest = still
        rows = _joined(base, found.drop("_widest"), keys)
        value = F.col("_value")
        inside = {
            f"_sketch{i}": F.when(value.between(F.col(f"_low{i}"), F.col(f"_high{i}")), value)
            for i in range(len(probs))
        }
        below = {f"_below{i}": (value < F.col(f"_low{i}")).cast("long") for i in range(len(probs))}
        again = sketched(rows, keys, inside, below, size=size)
        found = _small(_narrowed(_rejoined(again, found.drop("_widest"), keys), keys, probs, size), keys)


def _rejoined(sketches: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    condition = reduce(
        Column.__and__, (F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys)
    )
    kept = [F.col(f"r.{c}") for c in brackets.columns if c not in keys and c not in sketches.columns]
    return sketches.alias("l").join(brackets.alias("r"), condition).select("l.*", *kept)


def _narrowed(sketches: DataFrame, keys: list[str], probs: list[float], size: int) -> DataFrame:
    """Brackets by the sketches of what lies in the brackets so far.

    Ranks asked of a sketch must be constant, so it gives its values on a grid of ranks, and a
    bracket goes from one grid line below the value's rank to one above.
    """
    step = MARGIN * rank_error(size)
    lines = math.ceil(1 / step)
    grid = F.array(*(F.lit(min(1.0, line * step)) for line in range(lines + 1)))
    made, widest = [], [F.lit(0.0), F.lit(0.0)]
    for i, prob in enumerate(probs):
        n, values = sketch_size(f"_sketch{i}"), F.col(f"_grid{i}")

        def line(place: Column, i=i, n=n) -> Column:
            return (place - F.col(f"_below{i}") + 0.5) / n / step

        lower = F.floor(line(F.floor(_position(prob)))).cast("int") - 1
        upper = F.ceil(line(F.ceil(_position(prob)))).cast("int") + 1
        low = F.when(lower < 0, F.col(f"_low{i}")).otherwise(F.get(values, lower))
        high = F.when(upper > lines, F.col(f"_high{i}")).otherwise(F.get(values, upper))
        made += [low.alias(f"_low{i}"), high.alias(f"_high{i}")]
        share = F.least((upper - lower) * F.lit(step), F.lit(1.0))
        widest.append(F.when(low == high, F.lit(1.0)).otherwise(n * share))
    grids = {
        f"_grid{i}": F.kll_sketch_get_quantile_double(f"_sketch{i}", grid) for i in range(len(probs))
    }
    return (
        sketches.filter("_rows > 0")
        .withColumns(grids)
        .select(*keys, "_rows", *made, F.greatest(*widest).alias("_widest"))
    )


def _picked(base: DataFrame, keys: list[str], brackets: DataFrame, probs: list[float]) -> DataFrame:
    """``keys`` and ``_picked``, the quantile of each probability."""
    value = F.col("_value")
    sides = range(len(probs))
    inside = reduce(Column.__or__, (value.between(F.col(f"_low{i}"), F.col(f"_high{i}")) for i in sides))
    following = [F.when(F.col(f"_low{i}") > value, F.col(f"_low{i}")) for i in sides]
    place = F.when(inside, value).otherwise(F.least(*following, F.lit(None).cast("double")))
    counts = (
        _joined(base, brackets, keys)
        .select(*keys, "_rows", place.alias("_place"), inside.alias("_known"))
        .filter(F.col("_place").isNotNull())
        .groupBy(*keys, "_rows", "_place", "_known")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # Rows between brackets come before the equal value that starts the next bracket.
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_place", "_known"))
    ranked = counts.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_n"))

    def at(rank: Column) -> Column:
        hit = F.col("_known") & (F.col("_before") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(hit, F.col("_place")))

    picks = [
        column
        for i, p in enumerate(probs)
        for column in (
            at(F.floor(_position(p))).alias(f"_l{i}"),
            at(F.ceil(_position(p))).alias(f"_h{i}"),
        )
    ]
    found = ranked.groupBy(*keys, "_rows").agg(*picks)

    def mixed(i: int, p: float) -> Column:
        low, high = F.col(f"_l{i}"), F.col(f"_h{i}")
        weight = _position(p) - F.floor(_position(p))
        # Equal sides are not mixed: the mean of two infinities would be no number.
        return (
            F.when(low.isNull() | high.isNull(), F.raise_error(F.lit("A bracket missed its rank")).cast("double"))
            .when((low == high) | (weight == 0), low)
            .otherwise(low * (1 - weight) + high * weight)
        )

    return found.select(*keys, F.array(*(mixed(i, p) for i, p in enumerate(probs))).alias("_picked"))


def with_group_median(df: DataFrame, value: str, by: str, name: str) -> DataFrame:
    """Every row of ``df`` with the exact median of its group.

    A window over the group would bring each group to one task. Here the medians
    are a small stored table joined back: broadcast when its size allows it,
    otherwise a sort-merge join whose hot partitions Spark splits.
    """
    medians = exact_quantiles(df, value, [0.5], [by])
    medians = stored(medians.select(F.col(by).alias("_group"), F.col("quantiles")[0].alias(name)))
    return df.join(medians, F.col(by).eqNullSafe(F.col("_group")), "left").drop("_group")
