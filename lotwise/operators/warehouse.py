"""Staging relation, two dimensions and the sales fact."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.columns import (
    french_month,
    iso_date,
    nearest_long,
    padded_postcode,
    price_per_sqm,
    surrogate_key,
)
from lotwise.operators.quality import deduplicate
from lotwise.schemas import STAGED_SALE


def stage_sales(sales: DataFrame) -> DataFrame:
    """Deduplicated clean sales with a real date, a textual postcode and whole rooms."""
    return (
        deduplicate(sales)
        .withColumns(
            {
                "date_mutation": iso_date(),
                "code_postal": padded_postcode(),
                "nb_pieces": nearest_long("nb_pieces"),
            }
        )
        .select(*STAGED_SALE.fieldNames())
    )


def dim_commune(staged: DataFrame) -> DataFrame:
    """One row per commune name, with its smallest postcode.

    Communes of the same name merge, and sales without commune get a row of their
    own. Staged postcodes are five digits, so the smallest number is the smallest
    text; a number aggregates by hash, whereas text would make Spark sort all sales.
    """
    smallest = F.lpad(F.min(F.col("code_postal").cast("int")).cast("string"), 5, "0")
    return staged.groupBy("nom_commune").agg(smallest.alias("code_postal")).select(
        surrogate_key("nom_commune").alias("commune_id"), "nom_commune", "code_postal"
    )


def dim_date(staged: DataFrame) -> DataFrame:
    """Every day of the calendar years touched by the sales; none without sales."""
    bounds = staged.agg(
        F.trunc(F.min("date_mutation"), "year").alias("first_day"),
        F.make_date(F.year(F.max("date_mutation")), F.lit(12), F.lit(31)).alias("last_day"),
    )
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_id"))
    return days.select(
        "date_id",
        F.year("date_id").alias("annee"),
        F.quarter("date_id").alias("trimestre"),
        F.month("date_id").alias("mois"),
        french_month("date_id").alias("nom_mois"),
        F.dayofweek("date_id").alias("jour_semaine"),
    )


def fact_sales(staged: DataFrame, communes: DataFrame) -> DataFrame:
    """Sales with their commune key and price per square metre.

    A sale without commune keeps a null key. No hint: given a stored dimension
    Spark knows its size, broadcasts it below the threshold, and else splits the
    partition of a hot commune.
    """
    keys = communes.select("commune_id", "nom_commune")
    return staged.join(keys, "nom_commune", "left").select(
        "id_mutation",
        F.col("date_mutation").alias("date_id"),
        "commune_id",
        "prix",
        "surface_bati",
        "surface_terrain",
        "nb_pieces",
        "nb_lots",
        "type_bien",
        price_per_sqm().alias("prix_m2"),
    )
