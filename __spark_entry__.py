"""

The order tables of the test data stand in for property sales, see
``lotwise.sources.sample_tables``. Queries that read the sales once run as one job
from the raw tables; those that read them several times store the clean sales
first, as the warehouse would hold them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.operators import cleaning, market, metrics, pricing, profiling, quality, warehouse
from lotwise.plans.build import exact_medians
from lotwise.schemas import RAW_LOT
from lotwise.sources.raw_files import (
    MALFORMED,
    SOURCE_FILE,
    load_years,
    raw_file_path,
    write_raw_file,
)
from lotwise.sources.sample_tables import raw_lots
from lotwise.sources.scratch import new_path, stored
from lotwise.sources.tables import publish_years, read_years

try:  # The text operators are an optional part.
    import corpus_pipeline
    from lotwise.llm import queries as llm_queries
except ImportError as error:
    # A broken dependency of theirs is not hidden.
    if error.name not in ("corpus_pipeline", "lotwise.llm", "lotwise.llm.queries"):
        raise
    corpus_pipeline = llm_queries = None

SPLIT_DATE = "2000-01-01"


def _lots(spark: SparkSession, folder: str) -> DataFrame:
    """Raw lots that count: market sales with a price."""
    return raw_lots(spark, folder).transform(cleaning.keep_market_sales).transform(
        cleaning.drop_missing_price
    )


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    """All sales, before the filters on dwellings, price and area."""
    return cleaning.aggregate_by_sale(_lots(spark, folder))


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_sales(raw_lots(spark, folder))


def _table(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The clean sales, or some of their columns, as a stored table."""
    clean = _clean(spark, folder)
    return stored(clean.select(*columns) if columns else clean)


def _with_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Clean sales in which every house appears again, a day earlier and one euro dearer."""
    sales = _table(spark, folder)
    earlier = F.date_format(F.date_sub(F.to_date("date_mutation"), 1), "yyyy-MM-dd")
    copies = sales.filter(F.col("type_bien") == "Maison").withColumns(
        {"date_mutation": earlier, "prix": F.col("prix") + 1}
    )
    return sales.unionByName(copies)


def _split(spark: SparkSession, folder: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    return pricing.time_based_split(_table(spark, folder, *columns), SPLIT_DATE)


def _baseline(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split(spark, folder, "id_mutation", "date_mutation", "prix", "surface_bati")
    return pricing.predict_baseline(train, test)


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Doubles summed in another order differ in their last digits: round to compare."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which every client of both engines compares alike."""
    dates = [name for name, kind in df.dtypes if kind == "date"]
    return df.withColumns({name: F.col(name).cast("string") for name in dates})


def entry(spark: SparkSession) -> DataFrame:
    """Busiest communes with their median price per square metre."""
    return market.top_communes(_clean(spark, "/root/testdata/sf0.001"))


# --- Queries that need more than one call ------------------------------------------


def _lots_by_year(spark: SparkSession, folder: str) -> DataFrame:
    lots = raw_lots(spark, folder).withColumn("source_year", F.year(F.to_date("date_mutation")))
    return lots.groupBy("source_year").agg(
        F.count(F.lit(1)).alias("nb_lots"), F.count_distinct("id_mutation").alias("nb_mutations")
    )


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    staged = stored(warehouse.stage_sales(_clean(spark, folder)))
    communes = stored(warehouse.dim_commune(staged))
    return _dates_as_text(warehouse.fact_sales(staged, communes))


def _price_profile(spark: SparkSession, folder: str) -> DataFrame:
    lots = stored(raw_lots(spark, folder).select("id_mutation", "valeur_fonciere"))
    profile = profiling.describe(lots, "valeur_fonciere").withColumns(
        {
            "n_mutations": profiling.distinct_count(lots, "id_mutation").scalar(),
            "null_rate": profiling.null_rate(lots, "valeur_fonciere").scalar(),
        }
    )
    return _rounded(_rounded(profile, 2, "mean", "std"), 6, "p25", "p50", "p75")


def _no_dwelling_lot_types(spark: SparkSession, folder: str) -> DataFrame:
    lots = stored(_lots(spark, folder).select("id_mutation", "type_local"))
    return profiling.value_counts(profiling.no_dwelling_lots(lots), "type_local", keep_null=True)


def _largest_sale_lots(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.largest_sale_lots(raw_lots(spark, folder))


def _commune_median_feature(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("id_mutation", "date_mutation", "nom_commune", "prix", "surface_bati")
    train, test = _split(spark, folder, *columns)
    featured = pricing.with_commune_median(train, test)
    return _rounded(featured.select("id_mutation", "nom_commune", "prix_m2_commune"), 9, "prix_m2_commune")


def _model_predictions(spark: SparkSession, folder: str) -> DataFrame:
    train, test = (stored(part) for part in _split(spark, folder))
    model = pricing.train_model(train)
    return pricing.predict(model, test).select("id_mutation", "prix", "prediction")


def _model_vs_baseline(spark: SparkSession, folder: str) -> DataFrame:
    train, test = (stored(part) for part in _split(spark, folder))
    model = pricing.train_model(train)
    return pricing.compare_with_baseline(
        pricing.predict_baseline(train, test), pricing.predict(model, test)
    )


def _model_early_stopping(spark: SparkSession, folder: str) -> DataFrame:
    """Did the held-out sales end the boosting early, and does what it learned beat the baseline?"""
    train, test = (stored(part) for part in _split(spark, folder))
    model = pricing.train_model(train, early_stopping=True)
    tested = pricing.compare_with_baseline(
        pricing.predict_baseline(train, test), pricing.predict(model, test)
    )
    fewer = pricing.boosting_rounds(model) < pricing.MAX_ITER
    return tested.filter("modele = 'model'").select(
        F.lit(fewer).alias("arret_anticipe"), (F.col("gain") > 0).alias("meilleur_que_baseline")
    )


def _lots_through_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The raw lots, written as one gzip CSV file a year and read back with their lineage."""
    dated = F.year(F.to_date("date_mutation"))
    lots = stored(raw_lots(spark, folder).withColumn("_year", dated))
    years = sorted(row[0] for row in lots.select("_year").distinct().collect())
    path = new_path(spark)
    for year in years:
        write_raw_file(
            lots.filter(F.col("_year") == year).select(*RAW_LOT.fieldNames()),
            raw_file_path(path, "lots", "00", year),
        )
    return load_years(spark, path, "lots", "00", years, lineage=True).select(
        *RAW_LOT.fieldNames(), "source_year", SOURCE_FILE, F.size(MALFORMED).alias("nb_malformed")
    )


REBUILT_YEAR, REBUILT_FROM = 1997, 150_000.0


def _published(spark: SparkSession, folder: str) -> DataFrame:
    """Clean sales by year, one year of which was built again from dearer sales only."""
    sales, path = _table(spark, folder), new_path(spark)
    publish_years(sales, path)
    year = F.year(F.to_date("date_mutation"))
    publish_years(sales.filter((year == REBUILT_YEAR) & (F.col("prix") >= REBUILT_FROM)), path)
    return read_years(spark, path)


def _published_split(spark: SparkSession, folder: str) -> DataFrame:
    sizes = (
        part.groupBy("annee").agg(F.count(F.lit(1)).alias("nb_ventes")).withColumn("partie", F.lit(name))
        for name, part in zip(
            ("train", "test"), pricing.time_based_split(_published(spark, folder), SPLIT_DATE), strict=True
        )
    )
    return DataFrame.unionByName(*sizes)


def _observed_funnel(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = cleaning.ObservedCleaning(raw_lots(spark, folder))
    cleaned.sales.write.format("noop").mode("overwrite").save()
    return cleaned.funnel()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every implemented query by name."""
    if llm_queries is None:
        return _sales_queries()
    return _sales_queries() | llm_queries.queries() | {"pipeline": corpus_pipeline.run}


def _sales_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # cleaning
        "clean_market_sales": lambda s, d: cleaning.keep_market_sales(raw_lots(s, d)).select(
            *RAW_LOT.fieldNames()
        ),
        "clean_priced_lots": lambda s, d: cleaning.drop_missing_price(raw_lots(s, d)).select(
            *RAW_LOT.fieldNames()
        ),
        "sales_by_mutation": _sales,
        "clean_single_dwelling": lambda s, d: cleaning.keep_single_dwelling(_sales(s, d)),
        "clean_price_range": lambda s, d: cleaning.filter_price_range(_sales(s, d)),
        "clean_area_range": lambda s, d: cleaning.filter_area_range(_sales(s, d)),
        "clean_sales": _clean,
        "clean_sales_by_place": lambda s, d: cleaning.clean_sales(
            stored(raw_lots(s, d)), by_place=True
        ),
        "clean_sales_audited": lambda s, d: cleaning.clean_from_audited(
            cleaning.audited_sales(raw_lots(s, d))
        ),
        "cleaning_funnel": lambda s, d: cleaning.cleaning_funnel(
            cleaning.audited_sales(raw_lots(s, d))
        ),
        "cleaning_report": lambda s, d: _rounded(
            quality.cleaning_report(
                cleaning.cleaning_funnel(cleaning.audited_sales(raw_lots(s, d)))
            ),
            6,
            "survival_rate",
        ),
        "cleaning_funnel_observed": _observed_funnel,
        "multi_year_union": _lots_by_year,
        # files and published tables
        "lots_through_csv": _lots_through_csv,
        "published_sales": _published,
        "published_split": _published_split,
        # star schema
        "staging_sales": lambda s, d: _dates_as_text(warehouse.stage_sales(_clean(s, d))),
        "dim_commune": lambda s, d: warehouse.dim_commune(warehouse.stage_sales(_clean(s, d))),
        "dim_date": lambda s, d: _dates_as_text(
            warehouse.dim_date(warehouse.stage_sales(_clean(s, d)))
        ),
        "fact_sales": _fact,
        # controls
        "control_count": lambda s, d: quality.sale_count(_clean(s, d)),
        "null_key_count": lambda s, d: quality.null_key_count(_clean(s, d)),
        "dedup_count": lambda s, d: quality.sale_count(quality.deduplicate(_clean(s, d))),
        "dedup_latest": lambda s, d: quality.deduplicate(_with_copies(s, d)),
        "duplicate_keys": lambda s, d: quality.duplicate_keys(_with_copies(s, d)),
        "max_duplicate_rank": lambda s, d: quality.largest_duplicate_group(_with_copies(s, d)),
        "subtotal_check": lambda s, d: market.subtotal_check(_clean(s, d)),
        # analyses
        "global_medians_approx": lambda s, d: market.global_medians(_clean(s, d)),
        "global_medians_exact": lambda s, d: exact_medians(_table(s, d, "prix", "surface_bati")),
        "price_boundaries": lambda s, d: market.price_boundaries(_clean(s, d), 4),
        "median_audit": lambda s, d: market.median_audit(
            _table(s, d, "nom_commune", "prix"), "nom_commune", F.col("prix")
        ).select("nom_commune", "n", "tenue"),
        "stats_by_type": lambda s, d: market.stats_by_type(_clean(s, d)),
        "top_communes": lambda s, d: market.top_communes(_clean(s, d)),
        "yearly_evolution": lambda s, d: market.yearly_evolution(_clean(s, d)),
        "commune_ranking_having": lambda s, d: market.commune_ranking(_clean(s, d)),
        "commune_ranking_cte": lambda s, d: market.commune_ranking_sql(_clean(s, d)),
        "sale_vs_commune_median": lambda s, d: _rounded(
            market.sale_vs_commune(_table(s, d, "nom_commune", "prix", "surface_bati")),
            9,
            "prix_m2_commune",
            "rapport",
        ),
        "top_sales_per_commune": lambda s, d: market.top_sales_per_commune(
            _table(s, d, "id_mutation", "nom_commune", "prix", "surface_bati")
        ),
        "commune_yoy": lambda s, d: market.commune_yoy(_clean(s, d)),
        "price_quintiles": lambda s, d: market.price_quintiles(_clean(s, d)),
        "rank_family": lambda s, d: market.rank_family(
            _table(s, d, "nom_commune", "id_mutation", "nb_pieces"), "nb_pieces"
        ),
        "commune_share": lambda s, d: _rounded(market.commune_share(_clean(s, d)), 6, "part"),
        # exploration
        "raw_shape": lambda s, d: profiling.shape(raw_lots(s, d).select(*RAW_LOT.fieldNames())),
        "price_profile": _price_profile,
        "sale_nature_counts": lambda s, d: profiling.value_counts(
            raw_lots(s, d), "nature_mutation"
        ),
        "lot_type_counts_with_null": lambda s, d: profiling.value_counts(
            raw_lots(s, d), "type_local", keep_null=True
        ),
        "dwelling_histogram": lambda s, d: profiling.dwelling_histogram(_sales(s, d)),
        "dwelling_scope_share": lambda s, d: _rounded(
            profiling.dwelling_scope(_sales(s, d)), 6, "part"
        ),
        "no_dwelling_lot_types": _no_dwelling_lot_types,
        "largest_sale_lots": _largest_sale_lots,
        "price_quantiles": lambda s, d: _rounded(
            metrics.price_quantiles(_split(s, d, "date_mutation", "prix")[1]), 4, "prix"
        ),
        # price model
        "split_counts": lambda s, d: pricing.split_counts(_clean(s, d), SPLIT_DATE),
        "split_union": lambda s, d: quality.sale_count(
            DataFrame.unionByName(*_split(s, d, "date_mutation"))
        ),
        "model_features": lambda s, d: pricing.build_features(_clean(s, d)),
        "baseline_predictions": lambda s, d: _rounded(
            _baseline(s, d).select("id_mutation", "prix", "prediction"), 9, "prediction"
        ),
        "baseline_metrics": lambda s, d: _rounded(
            _rounded(metrics.error_means(_baseline(s, d)), 2, "mae", "rmse"), 6, "mape"
        ),
        "baseline_error_distribution": lambda s, d: _rounded(
            metrics.error_distribution(stored(_baseline(s, d))), 6, "moyenne", "mediane", "p90", "p99"
        ),
        "baseline_error_by_quintile": lambda s, d: _rounded(
            metrics.error_by_price_quintile(_baseline(s, d)), 6, "prix_median", "erreur_mediane"
        ),
        "commune_median_feature": _commune_median_feature,
        "model_predictions": _model_predictions,
        "model_vs_baseline": _model_vs_baseline,
        "model_early_stopping": _model_early_stopping,
    }


# --- Oracles -----------------------------------------------------------------------

_RAW = """
raw AS (
    SELECT l_orderkey::varchar AS id_mutation,
           strftime(o_orderdate::date + (l_linenumber - 1), '%Y-%m-%d') AS date_mutation,
           CASE WHEN o_orderstatus = 'P' AND o_custkey % 4 = 0
                THEN 'Adjudication' ELSE 'Vente' END AS nature_mutation,
           CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice + (l_linenumber - 1) END AS valeur_fonciere,
           CASE WHEN NOT (o_orderkey % 41 = 0 OR (o_orderkey % 9 = 0 AND l_linenumber = 1))
                THEN n_name END AS nom_commune,
           CASE WHEN n_nationkey % 7 <> 3 THEN (1000 + n_nationkey * 970)::double
                + CASE WHEN n_nationkey % 5 = 2 THEN 0.5::double ELSE 0::double END END AS code_postal,
           CASE WHEN l_returnflag = 'A' THEN 'Appartement'
                WHEN l_returnflag = 'R' THEN 'Dependance'
                WHEN l_returnflag = 'N' AND l_linenumber % 2 = 0 THEN 'Maison' END AS type_local,
           CASE WHEN NOT (l_returnflag = 'R' AND l_linenumber = 1)
                THEN l_quantity * 2 END AS surface_reelle_bati,
           l_linenumber::double AS nombre_pieces_principales,
           CASE WHEN l_linestatus = 'O' THEN l_quantity * 10 END AS surface_terrain,
           CASE WHEN o_orderkey % 31 <> 0
                THEN (-(o_custkey % 100))::double / 100 + (l_linenumber - 1) END AS longitude,
           CASE WHEN o_orderkey % 31 <> 0 THEN 44 + (o_custkey % 60)::double / 100 END AS latitude,
           l_linenumber * 256 + ascii(l_returnflag) AS lot_order,
           'RUE ' || (l_suppkey % 100) AS adresse_nom_voie
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
)"""

_SALES = _RAW + """,
lots AS (
    SELECT *, type_local IS NOT NULL AND type_local <> 'Dependance' AS logement
    FROM raw WHERE nature_mutation = 'Vente' AND valeur_fonciere IS NOT NULL
),
sales AS (
    SELECT id_mutation,
           arg_min(date_mutation, lot_order) FILTER (date_mutation IS NOT NULL) AS date_mutation,
           arg_min(valeur_fonciere, lot_order) FILTER (valeur_fonciere IS NOT NULL) AS prix,
           arg_min(nom_commune, lot_order) FILTER (nom_commune IS NOT NULL) AS nom_commune,
           arg_min(code_postal, lot_order) FILTER (code_postal IS NOT NULL) AS code_postal,
           count(*) FILTER (logement) AS nb_logements,
           count(*) AS nb_lots,
           coalesce(sum(surface_reelle_bati) FILTER (logement), 0) AS surface_bati,
           coalesce(sum(nombre_pieces_principales) FILTER (logement), 0) AS nb_pieces,
           coalesce(sum(surface_terrain), 0) AS surface_terrain,
           arg_min(longitude, lot_order) FILTER (longitude IS NOT NULL) AS longitude,
           arg_min(latitude, lot_order) FILTER (latitude IS NOT NULL) AS latitude,
           arg_min(type_local, lot_order) FILTER (logement) AS type_bien
    FROM lots GROUP BY id_mutation
)"""

_CLEAN = _SALES + """,
clean AS (
    SELECT *, prix / nullif(surface_bati, 0) AS m2, year(date_mutation::date)::integer AS annee
    FROM sales
    WHERE nb_logements = 1 AND prix BETWEEN 10000 AND 5000000 AND surface_bati BETWEEN 9 AND 1000
)"""

_STAGED = _CLEAN + """,
staged AS (
    SELECT * EXCLUDE (m2, annee) REPLACE (
        date_mutation::date AS date_mutation,
        lpad(round(code_postal)::bigint::varchar, 5, '0') AS code_postal,
        round(nb_pieces)::bigint AS nb_pieces)
    FROM clean
),
communes AS (
    SELECT md5(coalesce(nom_commune, '_dbt_utils_surrogate_key_null_')) AS commune_id,
           nom_commune, min(code_postal) AS code_postal
    FROM staged GROUP BY nom_commune
)"""

_COPIES = _CLEAN + """,
doubled AS (
    SELECT * EXCLUDE (m2, annee) FROM clean
    UNION ALL
    SELECT * EXCLUDE (m2, annee) REPLACE (
        strftime(date_mutation::date - 1, '%Y-%m-%d') AS date_mutation, prix + 1 AS prix)
    FROM clean WHERE type_bien = 'Maison'
)"""

_PREDICTED = _CLEAN + f""",
train AS (SELECT * FROM clean WHERE date_mutation < '{SPLIT_DATE}'),
test AS (SELECT * FROM clean WHERE date_mutation >= '{SPLIT_DATE}'),
predicted AS (
    SELECT *, surface_bati * (SELECT median(m2) FROM train) AS prediction FROM test
),
errors AS (SELECT *, abs((prix - prediction) / prix) AS erreur FROM predicted)"""

_PUBLISHED = _CLEAN + f""",
published AS (
    SELECT * EXCLUDE (m2) FROM clean WHERE annee <> {REBUILT_YEAR} OR prix >= {REBUILT_FROM}
)"""

_RAW_COLUMNS = ", ".join(RAW_LOT.fieldNames())
_CLEAN_COLUMNS = "* EXCLUDE (m2, annee)"
_MEDIAN = "quantile_disc({}, 0.5)"
_M2 = f"round({_MEDIAN.format('m2')}, 0) AS prix_m2_median"

_FUNNEL = _CLEAN + """,
funnel AS (
    SELECT 1 AS step_no, 'raw_lots' AS step, count(*) AS n_rows FROM raw
    UNION ALL SELECT 2, 'keep_market_sales', count(*) FROM raw WHERE nature_mutation = 'Vente'
    UNION ALL SELECT 3, 'drop_missing_price', count(*) FROM lots
    UNION ALL SELECT 4, 'aggregate_by_sale', count(*) FROM sales
    UNION ALL SELECT 5, 'keep_single_dwelling', count(*) FROM sales WHERE nb_logements = 1
    UNION ALL SELECT 6, 'filter_price_range', count(*) FROM sales
              WHERE nb_logements = 1 AND prix BETWEEN 10000 AND 5000000
    UNION ALL SELECT 7, 'filter_area_range', count(*) FROM clean
)"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of each query that SQL can express."""
    if llm_queries is None:
        return _sales_oracles()
    return _sales_oracles() | llm_queries.oracle_sql()


def _sales_oracles() -> dict[str, str]:
    body = {
        "clean_market_sales": (_RAW, f"SELECT {_RAW_COLUMNS} FROM raw WHERE nature_mutation = 'Vente'"),
        "clean_priced_lots": (
            _RAW, f"SELECT {_RAW_COLUMNS} FROM raw WHERE valeur_fonciere IS NOT NULL"
        ),
        "sales_by_mutation": (_SALES, "SELECT * FROM sales"),
        "clean_single_dwelling": (_SALES, "SELECT * FROM sales WHERE nb_logements = 1"),
        "clean_price_range": (_SALES, "SELECT * FROM sales WHERE prix BETWEEN 10000 AND 5000000"),
        "clean_area_range": (_SALES, "SELECT * FROM sales WHERE surface_bati BETWEEN 9 AND 1000"),
        "clean_sales": (_CLEAN, f"SELECT {_CLEAN_COLUMNS} FROM clean"),
        "clean_sales_audited": (_CLEAN, f"SELECT {_CLEAN_COLUMNS} FROM clean"),
        "clean_sales_by_place": (_CLEAN, f"SELECT {_CLEAN_COLUMNS} FROM clean"),
        "cleaning_funnel": (_FUNNEL, "SELECT * FROM funnel"),
        "cleaning_report": (
            _FUNNEL,
            """SELECT max(n_rows) FILTER (step_no = 1) AS raw_rows,
                      max(n_rows) FILTER (step_no = 7) AS kept_sales,
                      round(max(n_rows) FILTER (step_no = 7)
                            / max(n_rows) FILTER (step_no = 1), 6) AS survival_rate
               FROM funnel""",
        ),
        "cleaning_funnel_observed": (_FUNNEL, "SELECT * FROM funnel"),
        "lots_through_csv": (
            _RAW,
            f"""SELECT {_RAW_COLUMNS}, year(date_mutation::date)::integer AS source_year,
                       'lots_00_' || year(date_mutation::date) || '.csv.gz' AS source_file,
                       0::integer AS nb_malformed FROM raw""",
        ),
        "published_sales": (_PUBLISHED, "SELECT * FROM published"),
        "published_split": (
            _PUBLISHED,
            f"""SELECT annee, count(*) AS nb_ventes,
                       CASE WHEN date_mutation < '{SPLIT_DATE}' THEN 'train' ELSE 'test' END AS partie
                FROM published GROUP BY ALL""",
        ),
        "median_audit": (
            _CLEAN,
            "SELECT nom_commune, count(prix) AS n, true AS tenue FROM clean GROUP BY nom_commune",
        ),
        "model_early_stopping": (_RAW, "SELECT true AS arret_anticipe, true AS meilleur_que_baseline"),
        "multi_year_union": (
            _RAW,
            """SELECT year(date_mutation::date)::integer AS source_year, count(*) AS nb_lots,
                      count(DISTINCT id_mutation) AS nb_mutations
               FROM raw GROUP BY 1""",
        ),
        "staging_sales": (
            _STAGED,
            "SELECT * REPLACE (date_mutation::varchar AS date_mutation) FROM staged",
        ),
        "dim_commune": (_STAGED, "SELECT * FROM communes"),
        "dim_date": (
            _STAGED,
            """, days AS (
                SELECT unnest(generate_series(
                    make_date(year(min(date_mutation)), 1, 1)::timestamp,
                    make_date(year(max(date_mutation)), 12, 31)::timestamp,
                    INTERVAL 1 DAY))::date AS date_id
                FROM staged)
            SELECT date_id::varchar AS date_id, year(date_id)::integer AS annee,
                   quarter(date_id)::integer AS trimestre,
                   month(date_id)::integer AS mois,
                   ['janvier', 'février', 'mars', 'avril', 'mai', 'juin', 'juillet', 'août',
                    'septembre', 'octobre', 'novembre', 'décembre'][month(date_id)] AS nom_mois,
                   (dayofweek(date_id) + 1)::integer AS jour_semaine
            FROM days""",
        ),
        "fact_sales": (
            _STAGED,
            """SELECT id_mutation, date_mutation::varchar AS date_id, commune_id, prix, surface_bati,
                      surface_terrain, nb_pieces, nb_lots, type_bien,
                      prix / nullif(surface_bati, 0) AS prix_m2
               FROM staged LEFT JOIN communes USING (nom_commune)""",
        ),
        "control_count": (_CLEAN, "SELECT count(*) AS nb_ventes FROM clean"),
        "null_key_count": (
            _CLEAN, "SELECT count(*) FILTER (id_mutation IS NULL) AS ids_manquants FROM clean"
        ),
        "dedup_count": (_CLEAN, "SELECT count(DISTINCT id_mutation) AS nb_ventes FROM clean"),
        "dedup_latest": (
            _COPIES,
            """SELECT * FROM doubled
               QUALIFY row_number() OVER (PARTITION BY id_mutation ORDER BY date_mutation DESC) = 1""",
        ),
        "duplicate_keys": (
            _COPIES, "SELECT id_mutation, count(*) AS n FROM doubled GROUP BY 1 HAVING n > 1"
        ),
        "max_duplicate_rank": (
            _COPIES,
            """SELECT max(r) AS rang_max FROM (
                   SELECT row_number() OVER (PARTITION BY id_mutation) AS r FROM doubled)""",
        ),
        "subtotal_check": (
            _CLEAN,
            """SELECT count(type_bien) AS somme_groupes, count(*) AS nb_ventes,
                      count(type_bien) = count(*) AS complet FROM clean""",
        ),
        "global_medians_approx": (
            _CLEAN,
            f"""SELECT {_MEDIAN.format('prix')} AS prix_median,
                       {_MEDIAN.format('surface_bati')} AS surface_mediane FROM clean""",
        ),
        "global_medians_exact": (
            _CLEAN,
            "SELECT median(prix) AS prix_median, median(surface_bati) AS surface_mediane FROM clean",
        ),
        "price_boundaries": (
            _CLEAN,
            """, b AS (SELECT [min(prix), quantile_disc(prix, 0.25), quantile_disc(prix, 0.5),
                               quantile_disc(prix, 0.75), max(prix)] AS v FROM clean)
            SELECT (i - 1)::integer AS rang, v[i] AS prix FROM b, range(1, 6) t(i)""",
        ),
        "stats_by_type": (
            _CLEAN,
            f"""SELECT type_bien, count(*) AS nb_ventes, {_MEDIAN.format('prix')} AS prix_median,
                       {_M2} FROM clean GROUP BY type_bien""",
        ),
        "top_communes": (
            _CLEAN,
            f"""SELECT nom_commune, count(*) AS nb_ventes, {_M2} FROM clean
                GROUP BY nom_commune ORDER BY nb_ventes DESC, nom_commune LIMIT 10""",
        ),
        "yearly_evolution": (
            _CLEAN, f"SELECT annee, count(*) AS nb_ventes, {_M2} FROM clean GROUP BY annee"
        ),
        "commune_ranking_having": (
            _CLEAN,
            f"""SELECT nom_commune, count(*) AS nb_ventes, {_M2} FROM clean
                GROUP BY nom_commune HAVING count(*) >= 100""",
        ),
        "commune_ranking_cte": (
            _CLEAN,
            f""", g AS (SELECT nom_commune, count(*) AS nb_ventes, {_M2}
                        FROM clean GROUP BY nom_commune)
            SELECT * FROM g WHERE nb_ventes >= 100""",
        ),
        "sale_vs_commune_median": (
            _CLEAN,
            """, g AS (SELECT nom_commune, median(m2) AS mid FROM clean GROUP BY nom_commune)
            SELECT clean.nom_commune, m2 AS prix_m2, round(mid, 9) AS prix_m2_commune,
                   round(m2 / nullif(mid, 0), 9) AS rapport
            FROM clean JOIN g ON clean.nom_commune IS NOT DISTINCT FROM g.nom_commune""",
        ),
        "top_sales_per_commune": (
            _CLEAN,
            """SELECT nom_commune, prix, surface_bati,
                      (row_number() OVER (PARTITION BY nom_commune
                                          ORDER BY prix DESC, id_mutation))::integer AS rang
               FROM clean
               WHERE nom_commune IN (SELECT nom_commune FROM clean GROUP BY 1
                                     ORDER BY count(*) DESC, 1 LIMIT 5)
               QUALIFY rang <= 3""",
        ),
        "commune_yoy": (
            _CLEAN,
            f""", g AS (
                SELECT nom_commune, annee, {_M2} FROM clean
                WHERE nom_commune IN (SELECT nom_commune FROM clean GROUP BY 1
                                      ORDER BY count(*) DESC, 1 LIMIT 10)
                GROUP BY nom_commune, annee),
            p AS (SELECT *, lag(prix_m2_median) OVER (PARTITION BY nom_commune ORDER BY annee)
                         AS prix_m2_precedent FROM g)
            SELECT *, round(100 * (prix_m2_median - prix_m2_precedent)
                            / nullif(prix_m2_precedent, 0), 1) AS variation_pct FROM p""",
        ),
        "price_quintiles": (
            _CLEAN,
            f""", q AS (SELECT *, (ntile(5) OVER (ORDER BY prix, id_mutation))::integer AS quintile
                        FROM clean)
            SELECT quintile, count(*) AS nb_ventes, min(prix) AS prix_min, max(prix) AS prix_max,
                   {_MEDIAN.format('surface_bati')} AS surface_mediane FROM q GROUP BY quintile""",
        ),
        "rank_family": (
            _CLEAN,
            """SELECT nom_commune, id_mutation, nb_pieces,
                      row_number() OVER (c ORDER BY nb_pieces DESC, id_mutation) AS rang,
                      rank() OVER (c ORDER BY nb_pieces DESC) AS rang_saut,
                      dense_rank() OVER (c ORDER BY nb_pieces DESC) AS rang_dense
               FROM clean WINDOW c AS (PARTITION BY nom_commune)""",
        ),
        "commune_share": (
            _CLEAN,
            """SELECT nom_commune, count(*) AS nb_ventes,
                      round(count(*) / (SELECT count(*) FROM clean), 6) AS part
               FROM clean GROUP BY nom_commune""",
        ),
        "raw_shape": (_RAW, "SELECT count(*) AS n_rows, 12::bigint AS n_columns FROM raw"),
        "price_profile": (
            _RAW,
            """SELECT count(valeur_fonciere) AS n, round(avg(valeur_fonciere), 2) AS mean,
                      round(stddev_samp(valeur_fonciere), 2) AS std, min(valeur_fonciere) AS min,
                      round(quantile_cont(valeur_fonciere, 0.25), 6) AS p25,
                      round(quantile_cont(valeur_fonciere, 0.5), 6) AS p50,
                      round(quantile_cont(valeur_fonciere, 0.75), 6) AS p75,
                      max(valeur_fonciere) AS max, count(DISTINCT id_mutation) AS n_mutations,
                      round(1 - count(valeur_fonciere) / count(*), 3) AS null_rate
               FROM raw""",
        ),
        "sale_nature_counts": (
            _RAW, "SELECT nature_mutation, count(*) AS n FROM raw GROUP BY nature_mutation"
        ),
        "lot_type_counts_with_null": (
            _RAW, "SELECT type_local, count(*) AS n FROM raw GROUP BY type_local"
        ),
        "dwelling_histogram": (
            _SALES,
            """SELECT nb_logements, count(*) AS n FROM sales
               GROUP BY nb_logements ORDER BY nb_logements LIMIT 8""",
        ),
        "dwelling_scope_share": (
            _SALES,
            """SELECT CASE nb_logements WHEN 0 THEN '0' WHEN 1 THEN '1' ELSE '>=2' END AS logements,
                      count(*) AS mutations,
                      round(count(*) / (SELECT count(*) FROM sales), 6) AS part
               FROM sales GROUP BY 1""",
        ),
        "no_dwelling_lot_types": (
            _SALES,
            """SELECT type_local, count(*) AS n FROM lots
               WHERE id_mutation IN (SELECT id_mutation FROM sales WHERE nb_logements = 0)
               GROUP BY type_local""",
        ),
        "largest_sale_lots": (
            _RAW,
            """SELECT id_mutation, date_mutation, valeur_fonciere, type_local, surface_reelle_bati,
                      nombre_pieces_principales, adresse_nom_voie
               FROM raw WHERE id_mutation = (
                   SELECT id_mutation FROM raw GROUP BY 1 HAVING count(*) > 1
                   ORDER BY count(*) DESC, 1 LIMIT 1)""",
        ),
        "price_quantiles": (
            _PREDICTED,
            """SELECT p AS proba, round(v, 4) AS prix FROM (
                   SELECT unnest([0.2, 0.4, 0.6, 0.8, 1.0]::double[]) AS p,
                          unnest(quantile_cont(prix, [0.2, 0.4, 0.6, 0.8, 1.0])) AS v FROM test)""",
        ),
        "split_counts": (
            _PREDICTED,
            """SELECT (SELECT count(*) FROM train) AS n_train, (SELECT count(*) FROM test) AS n_test,
                      (SELECT count(*) FROM clean) AS n_total""",
        ),
        "split_union": (_CLEAN, "SELECT count(*) AS nb_ventes FROM clean"),
        "model_features": (
            _CLEAN,
            """SELECT surface_bati, nb_pieces, surface_terrain, longitude, latitude, nb_lots,
                      month(date_mutation::date)::integer AS mois, type_bien, prix FROM clean""",
        ),
        "baseline_predictions": (
            _PREDICTED, "SELECT id_mutation, prix, round(prediction, 9) AS prediction FROM predicted"
        ),
        "baseline_metrics": (
            _PREDICTED,
            """SELECT round(avg(abs(prix - prediction)), 2) AS mae, round(avg(erreur), 6) AS mape,
                      round(sqrt(avg((prix - prediction) ** 2)), 2) AS rmse FROM errors""",
        ),
        "baseline_error_distribution": (
            _PREDICTED,
            """SELECT round(avg(erreur), 6) AS moyenne, round(median(erreur), 6) AS mediane,
                      round(quantile_cont(erreur, 0.9), 6) AS p90,
                      round(quantile_cont(erreur, 0.99), 6) AS p99 FROM errors""",
        ),
        "baseline_error_by_quintile": (
            _PREDICTED,
            """, q AS (SELECT *, (ntile(5) OVER (ORDER BY prix, id_mutation))::integer AS quintile
                       FROM errors)
            SELECT quintile, round(median(prix), 6) AS prix_median,
                   round(median(erreur), 6) AS erreur_mediane FROM q GROUP BY quintile""",
        ),
        "commune_median_feature": (
            _PREDICTED,
            """, g AS (SELECT nom_commune, median(m2) AS mid FROM train GROUP BY nom_commune)
            SELECT id_mutation, nom_commune, round(mid, 9) AS prix_m2_commune
            FROM test LEFT JOIN g USING (nom_commune)""",
        ),
    }
    return {name: f"WITH {tables}\n{select}" for name, (tables, select) in body.items()}
