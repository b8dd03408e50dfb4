"""Named analyses of the clean sales: medians, rankings, change over time, quintiles."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.columns import percent_change, price_per_sqm
from lotwise.functions.quantiles import with_group_median
from lotwise.functions.ranking import with_ntile, with_position
from lotwise.functions.sketches import (
    SALTS,
    SIZE,
    rank_error,
    sketch_median,
    sketch_quantiles,
    sketch_size,
    sketched,
)
from lotwise.sources.scratch import stored


def _sale_count() -> Column:
    return F.count(F.lit(1)).alias("nb_ventes")


def _sales_sum() -> dict[str, Column]:
    return {"nb_ventes": F.lit(1).cast("long")}


def _median_per_sqm(sketch: str = "_m2") -> Column:
    """Median of the ratios, not the ratio of the medians."""
    return F.round(sketch_median(sketch), 0).alias("prix_m2_median")


def _year(date: str = "date_mutation") -> Column:
    """Year of a date, or of its ISO text as the clean layer holds it."""
    return F.year(F.to_date(F.col(date)))


def price_boundaries(sales: DataFrame, parts: int) -> DataFrame:
    """``rang, prix``: minimum, ``parts - 1`` inner boundaries and maximum of the price."""
    found = sketched(sales, [], {"_prix": F.col("prix")})
    ranks = [i / parts for i in range(parts + 1)]
    return found.select(F.posexplode(sketch_quantiles("_prix", ranks)).alias("rang", "prix"))


def global_medians(sales: DataFrame) -> DataFrame:
    """Median price and area, read off the middle of three quantile boundaries."""
    found = sketched(sales, [], {"_prix": F.col("prix"), "_surface": F.col("surface_bati")})
    halves = [0.0, 0.5, 1.0]
    return found.select(
        sketch_quantiles("_prix", halves)[1].alias("prix_median"),
        sketch_quantiles("_surface", halves)[1].alias("surface_mediane"),
    )


def stats_by_type(sales: DataFrame) -> DataFrame:
    """Sales, median price and median price per square metre of each property type.

    The plain division fails the job on a zero area, which the cleaning rules out.
    """
    per_sqm = F.col("prix") / F.col("surface_bati")
    found = sketched(sales, ["type_bien"], {"_prix": F.col("prix"), "_m2": per_sqm}, _sales_sum())
    return found.select(
        "type_bien", "nb_ventes", sketch_median("_prix").alias("prix_median"), _median_per_sqm()
    )


def stats_by_commune(sales: DataFrame) -> DataFrame:
    found = sketched(sales, ["nom_commune"], {"_m2": price_per_sqm()}, _sales_sum())
    return found.select("nom_commune", "nb_ventes", _median_per_sqm())


def top_communes(sales: DataFrame, n: int = 10) -> DataFrame:
    """The busiest communes; the name settles equal counts."""
    return stats_by_commune(sales).orderBy(F.desc("nb_ventes"), "nom_commune").limit(n)


def yearly_evolution(sales: DataFrame) -> DataFrame:
    dated = sales.withColumn("annee", _year())
    return (
        sketched(dated, ["annee"], {"_m2": price_per_sqm()}, _sales_sum())
        .select("annee", "nb_ventes", _median_per_sqm())
        .orderBy("annee")
    )


def commune_ranking(sales: DataFrame, min_sales: int = 100) -> DataFrame:
    """Communes with enough sales to have a median worth ranking."""
    return (
        stats_by_commune(sales)
        .filter(F.col("nb_ventes") >= min_sales)
        .orderBy(F.desc("prix_m2_median"), "nom_commune")
    )


def commune_ranking_sql(sales: DataFrame, min_sales: int = 100) -> DataFrame:
    """``commune_ranking`` as SQL: a complete table per commune, then a plain filter."""
    return sales.sparkSession.sql(
        """
        WITH salted AS (
            SELECT nom_commune,
                   spark_partition_id() % :salts AS salt,
                   try_divide(prix, surface_bati) AS m2
            FROM {sales}
        ),
        parts AS (
            SELECT nom_commune, salt, count(*) AS n, kll_sketch_agg_double(m2, :size) AS sketch
            FROM salted
            GROUP BY nom_commune, salt
        ),
        merged AS (
            SELECT nom_commune, sum(n) AS nb_ventes, kll_merge_agg_double(sketch, :size) AS sketch
            FROM parts
            GROUP BY nom_commune
        ),
        per_commune AS (
            SELECT nom_commune,
                   nb_ventes,
                   CASE WHEN kll_sketch_get_n_double(sketch) > 0
                        THEN round(kll_sketch_get_quantile_double(sketch, 0.5D), 0) END
                       AS prix_m2_median
            FROM merged
        )
        SELECT * FROM per_commune
        WHERE nb_ventes >= :min_sales
        ORDER BY prix_m2_median DESC, nom_commune
        """,
        args={"min_sales": min_sales, "salts": SALTS, "size": SIZE},
        sales=sales,
    )


def sale_vs_commune(sales: DataFrame) -> DataFrame:
    """Each sale's price per square metre against the median of its commune.

    ``sales`` is read twice and should be a stored table.
    """
    ratios = sales.select("nom_commune", price_per_sqm().alias("prix_m2"))
    compared = with_group_median(ratios, "prix_m2", "nom_commune", "prix_m2_commune")
    return compared.select(
        "nom_commune",
        "prix_m2",
        "prix_m2_commune",
        F.try_divide("prix_m2", "prix_m2_commune").alias("rapport"),
    )


def busiest(sales: DataFrame, n: int) -> DataFrame:
    """Names of the ``n`` communes with most sales."""
    return (
        sales.groupBy("nom_commune")
        .agg(_sale_count())
        .orderBy(F.desc("nb_ventes"), "nom_commune")
        .limit(n)
        .select("nom_commune")
    )


def top_sales_per_commune(sales: DataFrame, communes: int = 5, n: int = 3) -> DataFrame:
    """The ``n`` dearest sales of each of the busiest communes.

    The list of communes has at most ``communes`` rows, hence the broadcast. The
    rank filter runs before the shuffle as well, so a map task sends at most ``n``
    sales per commune.
    """
    dearest = Window.partitionBy("nom_commune").orderBy(F.desc("prix"), "id_mutation")
    return (
        sales.join(F.broadcast(busiest(sales, communes)), "nom_commune", "left_semi")
        .withColumn("rang", F.row_number().over(dearest))
        .filter(F.col("rang") <= n)
        .select("nom_commune", "prix", "surface_bati", "rang")
    )


def rank_family(sales: DataFrame, value: str = "prix") -> DataFrame:
    """The three ways of ranking all sales of each commune by ``value``, largest first.

    ``rang`` never ties (the sale id decides), ``rang_saut`` leaves a gap after ties,
    ``rang_dense`` does not. A window would sort each commune in one task. Here the sales
    take positions in one global order, range-partitioned, less where their commune
    starts; the distinct values take theirs in the same way. ``sales`` is read twice and
    should be a stored table.
    """
    narrow = sales.select("nom_commune", "id_mutation", value)
    largest_first = ["nom_commune", F.desc(value)]
    placed = with_position(narrow, [*largest_first, "id_mutation"]).drop("n_rows")
    tied = placed.groupBy("nom_commune", value).agg(F.min("position").alias("_first"))
    tied = with_position(tied, largest_first).drop("n_rows")
    starts = tied.groupBy("nom_commune").agg(
        (F.min("_first") - 1).alias("_sales_before"), (F.min("position") - 1).alias("_values_before")
    )
    tied = (
        tied.alias("t")
        .join(starts.alias("s"), F.col("t.nom_commune").eqNullSafe(F.col("s.nom_commune")))
        .select(
            F.col("t.nom_commune").alias("_commune"),
            F.col(f"t.{value}").alias("_tied"),
            "_sales_before",
            (F.col("_first") - F.col("_sales_before")).alias("rang_saut"),
            (F.col("position") - F.col("_values_before")).alias("rang_dense"),
        )
    )
    same = F.col("nom_commune").eqNullSafe(F.col("_commune")) & F.col(value).eqNullSafe(F.col("_tied"))
    return placed.join(tied, same).select(
        "nom_commune",
        "id_mutation",
        value,
        (F.col("position") - F.col("_sales_before")).alias("rang"),
        "rang_saut",
        "rang_dense",
    )


def commune_yoy(sales: DataFrame, communes: int = 10) -> DataFrame:
    """Median price per square metre by year of the busiest communes, and its change.

    One pass over the sales: the yearly rows of a commune are packed into its row,
    so that the busiest communes are picked after the only large aggregation. The
    previous row is the previous year with sales. A commune without name counts
    among the busiest but is not shown.
    """
    dated = sales.withColumn("annee", _year())
    yearly = sketched(dated, ["nom_commune", "annee"], {"_m2": price_per_sqm()}, _sales_sum()).select(
        "nom_commune", "annee", "nb_ventes", _median_per_sqm()
    )
    by_year = Window.partitionBy("nom_commune").orderBy("annee")
    return (
        yearly.groupBy("nom_commune")
        .agg(
            F.sum("nb_ventes").alias("total"),
            F.collect_list(F.struct("annee", "prix_m2_median")).alias("years"),
        )
        .orderBy(F.desc("total"), "nom_commune")
        .limit(communes)
        .filter(F.col("nom_commune").isNotNull())
        .select("nom_commune", F.inline("years"))
        .withColumn("prix_m2_precedent", F.lag("prix_m2_median").over(by_year))
        .withColumn("variation_pct", percent_change("prix_m2_median", "prix_m2_precedent"))
        .orderBy("nom_commune", "annee")
    )


def price_quintiles(sales: DataFrame, tiles: int = 5) -> DataFrame:
    """Equal-sized price buckets: count, price range and median area of each."""
    # Stored, since the sampling of the range partitioning reads them as well.
    narrow = stored(sales.select("prix", "id_mutation", "surface_bati"))
    bucketed = with_ntile(narrow, tiles, ["prix", "id_mutation"], "quintile")
    return (
        bucketed.groupBy("quintile", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt"))
        .agg(
            _sale_count(),
            F.min("prix").alias("prix_min"),
            F.max("prix").alias("prix_max"),
            F.kll_sketch_agg_double("surface_bati", F.lit(SIZE)).alias("_surface"),
        )
        .groupBy("quintile")
        .agg(
            F.sum("nb_ventes").alias("nb_ventes"),
            F.min("prix_min").alias("prix_min"),
            F.max("prix_max").alias("prix_max"),
            F.kll_merge_agg_double("_surface", F.lit(SIZE)).alias("_surface"),
        )
        .withColumn("_surface", sketch_median("_surface"))
        .withColumnRenamed("_surface", "surface_mediane")
        .orderBy("quintile")
    )


def median_audit(
    sales: DataFrame, by: str, value: Column, size: int = SIZE, salts: int = SALTS
) -> DataFrame:
    """How far the approximate median of each group truly is from its middle.

    ``by, n, mediane, erreur_rang, tenue``: values in the group, the approximate median, the
    distance of its true rank from the middle as a share of the group (0 where the middle lies
    among its equals), and whether that keeps within three rank errors of the sketch. The true
    ranks are counted in a second pass, in which rows join the medians of their groups, so
    ``sales`` should be a stored table.
    """
    rows = sales.select(by, value.cast("double").alias("_value")).filter(
        F.col("_value").isNotNull() & ~F.isnan("_value")
    )
    medians = stored(
        sketched(rows, [by], {"_sketch": F.col("_value")}, size=size, salts=salts)
        .filter(sketch_size("_sketch") > 0)
        .select(F.col(by).alias("_group"), sketch_median("_sketch").alias("mediane"))
    )
    found = F.col("_value")
    counted = (
        rows.join(medians, F.col(by).eqNullSafe(F.col("_group")))
        .groupBy(by, "mediane")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(found < F.col("mediane")).alias("_below"),
            F.count_if(found <= F.col("mediane")).alias("_upto"),
        )
    )
    middle = F.ceil(F.col("n") / 2)  # from 1
    off = F.greatest(F.col("_below") + 1 - middle, middle - F.col("_upto"), F.lit(0)) / F.col("n")
    return counted.select(by, "n", "mediane", off.alias("erreur_rang")).withColumn(
        "tenue", F.col("erreur_rang") <= 3 * rank_error(size)
    )


def commune_share(sales: DataFrame) -> DataFrame:
    """Share of all sales made in each commune."""
    counts = sales.groupBy("nom_commune").agg(_sale_count())
    total = counts.agg(F.sum("nb_ventes")).scalar()
    return counts.withColumn("part", F.try_divide(F.col("nb_ventes"), total))


def subtotal_check(sales: DataFrame, by: str = "type_bien") -> DataFrame:
    """Do the counts of the known groups add up to the number of sales?"""
    counts = sales.groupBy(by).agg(_sale_count())
    known = F.sum(F.when(F.col(by).isNotNull(), F.col("nb_ventes")))
    return counts.agg(
        F.coalesce(known, F.lit(0)).alias("somme_groupes"),
        F.coalesce(F.sum("nb_ventes"), F.lit(0)).alias("nb_ventes"),
    ).withColumn("complet", F.col("somme_groupes") == F.col("nb_ventes"))
