"""The order tables of the test data, seen as raw lots.

A line item is a lot, an order is a sale, a nation is a commune. The lots of a sale differ
in price, date, place and commune, and some lots and sales lack a commune, so that it shows
which lot of a sale a value was taken from.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.schemas import LOT_ORDER, RAW_LOT


def raw_lots(spark: SparkSession, folder: str) -> DataFrame:
    """Raw lots of all orders.

    Orders meet customers and nations before the line items, and both sides join on the
    text id that sales are grouped by later, so the largest table is shuffled once. Spark broadcasts customers and nations when their files
    are small. Line items are never broadcast, however small the estimate after
    pruning: the merge join also lets Spark split an order with very many of them.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    orders = table("orders")
    located = F.col("o_orderkey") % 31 != 0
    sales = (
        orders.join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("id_mutation"),
            F.col("o_orderdate").cast("date").alias("_sold"),
            F.when(
                (F.col("o_orderstatus") == "P") & (F.col("o_custkey") % 4 == 0), "Adjudication"
            ).otherwise("Vente").alias("nature_mutation"),
            F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice")).alias("valeur_fonciere"),
            F.col("n_name").alias("nom_commune"),
            F.when(
                F.col("n_nationkey") % 7 != 3,
                (F.lit(1000) + F.col("n_nationkey") * 970).cast("double")
                + F.when(F.col("n_nationkey") % 5 == 2, 0.5).otherwise(0.0),
            ).alias("code_postal"),
            F.when(located, (-(F.col("o_custkey") % 100)).cast("double") / 100)
            .alias("longitude"),
            F.when(located, F.lit(44) + (F.col("o_custkey") % 60).cast("double") / 100)
            .alias("latitude"),
        )
    )
    lots = table("lineitem").select(
        F.col("l_orderkey").cast("string").alias("id_mutation"),
        F.when(F.col("l_returnflag") == "A", "Appartement")
        .when(F.col("l_returnflag") == "R", "Dependance")
        .when((F.col("l_returnflag") == "N") & (F.col("l_linenumber") % 2 == 0), "Maison")
        .alias("type_local"),
        F.when(
            ~((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)),
            F.col("l_quantity") * 2,
        ).alias("surface_reelle_bati"),
        F.col("l_linenumber").cast("double").alias("nombre_pieces_principales"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity") * 10).alias("surface_terrain"),
        (F.col("l_linenumber") - 1).alias("_later"),
        ((F.col("l_orderkey") % 41 == 0) | ((F.col("l_orderkey") % 9 == 0) & (F.col("l_linenumber") == 1)))
        .alias("_nowhere"),
        F.concat(F.lit("RUE "), (F.col("l_suppkey") % 100).cast("string")).alias("adresse_nom_voie"),
        # Lots of one sale that tie on this order have the same type.
        (F.col("l_linenumber") * 256 + F.ascii("l_returnflag")).cast("long").alias(LOT_ORDER),
    )
    of_lot = {
        "date_mutation": F.date_add("_sold", F.col("_later")).cast("string"),
        "valeur_fonciere": F.col("valeur_fonciere") + F.col("_later"),
        "nom_commune": F.when(~F.col("_nowhere"), F.col("nom_commune")),
        "longitude": F.col("longitude") + F.col("_later"),
    }
    return (
        lots.hint("merge")
        .join(sales, "id_mutation")
        .withColumns(of_lot)
        .select(*RAW_LOT.fieldNames(), LOT_ORDER, "adresse_nom_voie")
    )
