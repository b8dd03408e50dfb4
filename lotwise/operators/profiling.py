"""Exploration of raw lots and of sales before the dwelling filter."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.columns import is_dwelling
from lotwise.functions.quantiles import exact_quantiles


def value_counts(df: DataFrame, column: str, *, keep_null: bool = False) -> DataFrame:
    """Frequency of each value, most frequent first; null counts only on demand."""
    rows = df if keep_null else df.filter(F.col(column).isNotNull())
    return (
        rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
    )


def dwelling_histogram(sales: DataFrame, n: int = 8) -> DataFrame:
    """How many sales have 0, 1, 2, ... dwellings: the first ``n`` numbers."""
    return (
        sales.groupBy("nb_logements")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("nb_logements")
        .limit(n)
    )


def dwelling_scope(sales: DataFrame) -> DataFrame:
    """Sales with no, one and several dwellings, and their share of all sales."""
    scope = (
        F.when(F.col("nb_logements") == 0, "0").when(F.col("nb_logements") == 1, "1").otherwise(">=2")
    )
    counts = sales.groupBy(scope.alias("logements")).agg(F.count(F.lit(1)).alias("mutations"))
    total = counts.agg(F.sum("mutations")).scalar()
    return counts.withColumn("part", F.try_divide(F.col("mutations"), total))


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns")
    )


def distinct_count(df: DataFrame, column: str, *, approximate: bool = False) -> DataFrame:
    """Distinct non-null values, exactly or by a sketch of fixed size."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(column).alias("n_distinct"))


def null_rate(df: DataFrame, column: str) -> DataFrame:
    """Share of nulls, to three digits."""
    return df.agg(F.round(F.avg(F.col(column).isNull().cast("double")), 3).alias("null_rate"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum.

    ``df`` is read more than once and should be a stored table.
    """
    value = F.col(column)
    quartiles = exact_quantiles(df, column, [0.25, 0.5, 0.75]).select("quantiles").scalar()
    return (
        df.agg(
            F.count(value).alias("n"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )
        .withColumn("_quartiles", quartiles)
        .select(
            "n",
            "mean",
            "std",
            "min",
            *(F.col("_quartiles")[i].alias(f"p{p}") for i, p in enumerate((25, 50, 75))),
            "max",
        )
    )


def no_dwelling_lots(lots: DataFrame) -> DataFrame:
    """The lots of sales without any dwelling.

    The ids stay a distributed semi join, never a set on the driver.
    """
    without = (
        lots.groupBy("id_mutation")
        .agg(F.count_if(is_dwelling()).alias("_dwellings"))
        .filter("_dwellings = 0")
        .select("id_mutation")
    )
    return lots.join(without, "id_mutation", "left_semi")


DRILL_DOWN = (
    "id_mutation",
    "date_mutation",
    "valeur_fonciere",
    "type_local",
    "surface_reelle_bati",
    "nombre_pieces_principales",
    "adresse_nom_voie",
)


def largest_sale_lots(lots: DataFrame, columns: Sequence[str] = DRILL_DOWN) -> DataFrame:
    """All lots of the sale with the most lots, provided it has several.

    Of ``columns`` those that the lots have; the street name needs a full-width read.
    """
    largest = (
        lots.filter(F.col("id_mutation").isNotNull())
        .groupBy("id_mutation")
        .agg(F.count(F.lit(1)).alias("_lots"))
        .filter("_lots > 1")
        .orderBy(F.desc("_lots"), "id_mutation")
        .limit(1)
        .select("id_mutation")
    )
    return lots.join(F.broadcast(largest), "id_mutation", "left_semi").select(
        *(c for c in columns if c in lots.columns)
    )
