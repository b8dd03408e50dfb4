"""Parquet and catalog tables: clean sales in, staging view and marts out."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

YEAR = "annee"


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A named warehouse table or view, e.g. ``raw.sales``."""
    return spark.table(name)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Register a lazy relation under ``name``."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def publish_table(df: DataFrame, name: str) -> DataFrame:
    """Rebuild the managed table ``name``, creating its schema when needed."""
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return spark.table(name)


def publish_years(sales: DataFrame, path: str, date: str = "date_mutation") -> None:
    """Write ``sales`` in one folder a year; years that ``sales`` does not have stay as they are.

    Rows meet by year before they are written, so a year gets files of the advisory size, not
    one of every task; adaptive execution splits a year that is larger.
    """
    dated = sales.withColumn(YEAR, F.year(F.to_date(date)))
    (
        dated.hint("rebalance", YEAR)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(YEAR)
        .parquet(path)
    )


def read_years(spark: SparkSession, path: str) -> DataFrame:
    """The table of ``publish_years``; a filter on ``annee`` reads those folders only."""
    return spark.read.parquet(path)
