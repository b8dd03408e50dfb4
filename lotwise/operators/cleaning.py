"""From raw lots to one trustworthy row per sale.

Each function takes one cleaning decision and is a DataFrame-to-DataFrame step, so
that ``lots.transform(step)`` chains compose and Catalyst sees one plan.
"""

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lotwise.functions.columns import is_dwelling
from lotwise.schemas import (
    CLEAN_SALE,
    DWELLING_TYPES,
    LOT_ORDER,
    MARKET_NATURES,
    MAX_AREA,
    MAX_PRICE,
    MIN_AREA,
    MIN_PRICE,
)


def _is_market_sale() -> Column:
    return F.col("nature_mutation").isin(*MARKET_NATURES)


def _has_price() -> Column:
    price = F.col("valeur_fonciere")
    return price.isNotNull() & ~F.isnan(price)


def keep_market_sales(lots: DataFrame) -> DataFrame:
    """Keep sales agreed on the open market; auctions and the like are not priced by it."""
    return lots.filter(_is_market_sale())


def drop_missing_price(lots: DataFrame) -> DataFrame:
    """Drop lots without price: the value to predict is never imputed."""
    return lots.filter(_has_price())


def _lot_position(lots: DataFrame) -> Column:
    if LOT_ORDER not in lots.columns:
        raise ValueError(f"Lots need a column {LOT_ORDER!r}: rows of a DataFrame have no order")
    return F.col(LOT_ORDER)


def _sale_aggregates(kept: Column) -> dict[str, Column]:
    """Aggregates of one sale over its kept lots.

    "First" is the first non-null value in source order. It is a minimum over the
    lot order, not ``first``, whose result depends on how the shuffle interleaves
    rows. Every aggregate combines map-side, so a sale with very many lots reaches
    the reducer as one partial row per map task.
    """

    def first(column: str, among: Column) -> Column:
        return F.min_by(column, F.when(among & F.col(column).isNotNull(), F.col("_position")))

    def total(column: str, among: Column) -> Column:
        return F.coalesce(F.sum(F.when(among, F.col(column))), F.lit(0.0))

    dwelling = kept & F.col("_dwelling")
    return {
        "date_mutation": first("date_mutation", kept),
        "prix": first("valeur_fonciere", kept),
        "nom_commune": first("nom_commune", kept),
        "code_postal": first("code_postal", kept),
        "nb_logements": F.count_if(dwelling),
        "nb_lots": F.count_if(kept),
        "surface_bati": total("surface_reelle_bati", dwelling),
        "nb_pieces": total("nombre_pieces_principales", dwelling),
        "surface_terrain": total("surface_terrain", kept),
        "longitude": first("longitude", kept),
        "latitude": first("latitude", kept),
        "type_bien": first("type_local", dwelling),
    }


def aggregate_by_sale(lots: DataFrame) -> DataFrame:
    """One row per sale: price once, dwelling areas and rooms added up.

    Lots without sale id belong to no sale and are left out.
    """
    aggregates = _sale_aggregates(F.lit(True))
    return (
        lots.filter(F.col("id_mutation").isNotNull())
        .withColumn("_position", _lot_position(lots))
        .withColumn("_dwelling", is_dwelling())
        .groupBy("id_mutation")
        .agg(*(column.alias(name) for name, column in aggregates.items()))
        .select(*CLEAN_SALE.fieldNames())
    )


# Text of a sale, and the condition on the lots that it is taken from.
_TEXTS = ("date_mutation", "nom_commune")


def aggregate_by_place(lots: DataFrame) -> DataFrame:
    """``aggregate_by_sale`` without sorting lots: the same sales by hash aggregation alone.

    Spark cannot keep text in the buffer of a hash aggregation, so taking the first text of a
    sale makes it sort all lots. Here the aggregation only finds the places of the first
    texts, numbers like all else; the type of dwelling, one of few, travels as its number. The
    texts are then looked up among the lots by sale and place, for the sales that are left:
    filters on numbers reach the aggregation, before the lookup. Sales are the hashed side of
    these joins, one row each, and lots stream by, so neither side is sorted and a sale of very
    many lots is spread by place.

    Lots are read once more for each text. ``lot_order`` must be a number, and lots of a sale
    that tie on it must agree on their texts.
    """
    place = _lot_position(lots)
    known = lots.filter(F.col("id_mutation").isNotNull())
    kinds = F.array(*map(F.lit, DWELLING_TYPES))
    coded = known.withColumns(
        {
            "_position": place,
            "_dwelling": is_dwelling(),
            "type_local": F.nullif(F.array_position(kinds, F.col("type_local")), F.lit(0)).cast("int"),
        }
    )
    numbers = {n: c for n, c in _sale_aggregates(F.lit(True)).items() if n not in _TEXTS}
    places = {f"_{name}_at": F.min(F.when(F.col(name).isNotNull(), F.col("_position"))) for name in _TEXTS}
    sales = (
        coded.groupBy("id_mutation")
        .agg(*(column.alias(name) for name, column in (numbers | places).items()))
        .withColumn("type_bien", F.get(kinds, F.col("type_bien") - 1))
    )
    for name in _TEXTS:
        found = (
            known.filter(F.col(name).isNotNull())
            .select(F.col("id_mutation").alias("_sale"), place.alias("_place"), F.col(name))
            .distinct()
        )
        same = (F.col("id_mutation") == F.col("_sale")) & (F.col(f"_{name}_at") == F.col("_place"))
        sales = sales.hint("shuffle_hash").join(found, same, "left").drop("_sale", "_place")
    return sales.select(*CLEAN_SALE.fieldNames())


def keep_single_dwelling(sales: DataFrame) -> DataFrame:
    """Keep sales of exactly one dwelling, the only ones with a usable unit price."""
    return sales.filter(F.col("nb_logements") == 1)


def filter_price_range(
    sales: DataFrame, min_price: float = MIN_PRICE, max_price: float = MAX_PRICE
) -> DataFrame:
    """Keep prices within the bounds, both included."""
    return sales.filter(F.col("prix").between(min_price, max_price))


def filter_area_range(sales: DataFrame) -> DataFrame:
    """Keep plausible living areas, bounds included."""
    return sales.filter(F.col("surface_bati").between(MIN_AREA, MAX_AREA))


def clean_sales(lots: DataFrame, by_place: bool = False) -> DataFrame:
    """All cleaning steps in order; lots are filtered before they are shuffled.

    ``by_place`` takes texts by ``aggregate_by_place``: for lots that come in no order, where
    sorting them costs more than reading them again.
    """
    return (
        lots.transform(keep_market_sales)
        .transform(drop_missing_price)
        .transform(aggregate_by_place if by_place else aggregate_by_sale)
        .transform(keep_single_dwelling)
        .transform(filter_price_range)
        .transform(filter_area_range)
    )


# --- Cleaning with its own counts --------------------------------------------------

_AUDIT = ("_raw", "_market", "_priced")


def audited_sales(lots: DataFrame) -> DataFrame:
    """Sales of all lots, with the number of raw, market and priced lots of each.

    The two lot filters become conditions inside the aggregates, so that one pass
    over the raw lots yields both the sales and the counts of every step. Observed
    metrics would be cheaper still, but they count a lost and repeated task twice.
    """
    kept = F.col("_kept")
    aggregates = _sale_aggregates(kept)
    market = F.coalesce(_is_market_sale(), F.lit(False))
    return (
        lots.withColumn("_position", _lot_position(lots))
        .withColumn("_dwelling", is_dwelling())
        .withColumn("_in_market", market)
        .withColumn("_kept", F.col("_in_market") & _has_price())
        .groupBy("id_mutation")
        .agg(
            *(column.alias(name) for name, column in aggregates.items()),
            F.count(F.lit(1)).alias("_raw"),
            F.count_if("_in_market").alias("_market"),
            F.count_if("_kept").alias("_priced"),
        )
    )


def clean_from_audited(audited: DataFrame) -> DataFrame:
    """The clean sales among ``audited_sales``; equal to ``clean_sales`` of its lots."""
    return (
        audited.filter(F.col("id_mutation").isNotNull() & (F.col("_priced") > 0))
        .drop(*_AUDIT)
        .transform(keep_single_dwelling)
        .transform(filter_price_range)
        .transform(filter_area_range)
        .select(*CLEAN_SALE.fieldNames())
    )


def cleaning_funnel(audited: DataFrame) -> DataFrame:
    """Rows left after each cleaning step, one row per step in order."""
    sale = F.col("id_mutation").isNotNull() & (F.col("_priced") > 0)
    single = sale & (F.col("nb_logements") == 1)
    priced = single & F.col("prix").between(MIN_PRICE, MAX_PRICE)
    clean = priced & F.col("surface_bati").between(MIN_AREA, MAX_AREA)
    none = F.lit(0).cast("long")
    steps = {
        "raw_lots": F.coalesce(F.sum("_raw"), none),
        "keep_market_sales": F.coalesce(F.sum("_market"), none),
        "drop_missing_price": F.coalesce(F.sum("_priced"), none),
        "aggregate_by_sale": F.count_if(sale),
        "keep_single_dwelling": F.count_if(single),
        "filter_price_range": F.count_if(priced),
        "filter_area_range": F.count_if(clean),
    }
    counts = audited.agg(*(column.alias(name) for name, column in steps.items()))
    return counts.select(F.inline(_funnel_rows({name: F.col(name) for name in steps})))


def _funnel_rows(counts: dict[str, Column]) -> Column:
    return F.array(
        *(
            F.struct(F.lit(number).alias("step_no"), F.lit(name).alias("step"), count.alias("n_rows"))
            for number, (name, count) in enumerate(counts.items(), start=1)
        )
    )


# --- Cleaning that counts as it goes -----------------------------------------------


class ObservedCleaning:
    """``clean_sales`` whose first action also counts the rows of every step.

    The counts cost no pass and no column, unlike those of ``audited_sales``. But Spark adds
    them up by task: a task that is lost and repeated after it has ended counts twice, and a
    frame that is never run has none. ``audited_sales`` is the way for the gate.
    """

    def __init__(self, lots: DataFrame):
        market = F.coalesce(_is_market_sale(), F.lit(False))
        single = F.col("nb_logements") == 1
        priced = single & F.col("prix").between(MIN_PRICE, MAX_PRICE)
        clean = priced & F.col("surface_bati").between(MIN_AREA, MAX_AREA)
        self._of_lots, self._of_sales = Observation(), Observation()
        observed = lots.observe(
            self._of_lots,
            F.count(F.lit(1)).alias("raw_lots"),
            F.count_if(market).alias("keep_market_sales"),
            F.count_if(market & _has_price()).alias("drop_missing_price"),
        )
        sales = observed.transform(keep_market_sales).transform(drop_missing_price)
        self.sales = (
            sales.transform(aggregate_by_sale)
            .observe(
                self._of_sales,
                F.count(F.lit(1)).alias("aggregate_by_sale"),
                F.count_if(single).alias("keep_single_dwelling"),
                F.count_if(priced).alias("filter_price_range"),
                F.count_if(clean).alias("filter_area_range"),
            )
            .transform(keep_single_dwelling)
            .transform(filter_price_range)
            .transform(filter_area_range)
        )

    def funnel(self) -> DataFrame:
        """Rows left after each step, as ``cleaning_funnel`` gives them; waits for the first action."""
        counts = {**self._of_lots.get, **self._of_sales.get}
        session = self.sales.sparkSession
        rows = _funnel_rows({name: F.lit(n).cast("long") for name, n in counts.items()})
        return session.range(1).select(F.inline(rows))
