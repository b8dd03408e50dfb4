import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lotwise.operators import market
from lotwise.sources.scratch import stored


@pytest.fixture(scope="module")
def table(spark):
    """Sales of 12 communes; one holds half of them, one is null, one lacks a year."""
    communes = ["Bordeaux"] * 12 + ["Pessac", "Talence", "Cenon", "Floirac", "Lormont", "Bruges"]
    communes += ["Eysines", "Gradignan", "Begles", "Arcachon", "Libourne", None]
    rows = []
    for i in range(3000):
        commune = communes[(i * 7) % len(communes)]
        year = 2022 + (i // 24) % 3
        if commune == "Cenon" and year == 2023:
            year = 2024
        kind = "Maison" if i % 3 == 0 else "Appartement"
        price, area = 100_000.0 + 1000 * (i * 37 % 211), 30.0 + i * 13 % 90
        rows.append((f"s{i:05d}", f"{year}-0{1 + i % 9}-15", price, commune, area, kind))
    names = "id_mutation string, date_mutation string, prix double, nom_commune string, "
    return stored(spark.createDataFrame(rows, names + "surface_bati double, type_bien string"))


def test_ranking_by_dataframe_and_by_sql_agree(table):
    for least in (100, 200, 10**9):
        ranked = market.commune_ranking(table, least).collect()
        assert ranked == market.commune_ranking_sql(table, least).collect()
    assert {r.nb_ventes >= 100 for r in market.commune_ranking(table, 100).collect()} == {True}


def test_medians_are_sales_not_averages(sales):
    df = sales(*({"prix": p, "surface_bati": 10.0 * p} for p in (1.0, 2.0, 3.0, 4.0)))
    assert tuple(market.global_medians(df).first()) == (2.0, 20.0)


def test_median_of_ratios_is_not_ratio_of_medians(sales):
    df = sales(
        {"prix": 100.0, "surface_bati": 10.0},
        {"prix": 900.0, "surface_bati": 30.0},
        {"prix": 400.0, "surface_bati": 100.0},
    )
    (row,) = market.stats_by_type(df).collect()
    assert (row.prix_median, row.prix_m2_median) == (400.0, 10.0)


def test_zero_area_fails_or_is_left_out(sales):
    df = sales({"surface_bati": 0.0}, {"surface_bati": 100.0})
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        market.stats_by_type(df).collect()
    assert market.top_communes(df).first().prix_m2_median == 2400.0


def test_busiest_communes_break_ties_by_name(sales):
    df = sales({"nom_commune": "B"}, {"nom_commune": "C"}, {"nom_commune": "A"})
    assert [r.nom_commune for r in market.top_communes(df, 2).collect()] == ["A", "B"]


def test_years_add_up(table):
    years = market.yearly_evolution(table).collect()
    assert [r.annee for r in years] == [2022, 2023, 2024]
    assert sum(r.nb_ventes for r in years) == 3000


def test_every_sale_is_compared_with_its_commune(table):
    compared = market.sale_vs_commune(table)
    assert compared.count() == 3000
    assert compared.filter("prix_m2_commune is null").count() == 0
    half = compared.filter("nom_commune = 'Bordeaux' and rapport <= 1").count()
    assert abs(half / compared.filter("nom_commune = 'Bordeaux'").count() - 0.5) < 0.02


def test_top_sales_have_at_most_n_rows_per_commune(table):
    named = table.filter("nom_commune is not null")
    top = market.top_sales_per_commune(named, 5, 3).collect()
    assert len(top) == 15
    assert sorted({r.rang for r in top}) == [1, 2, 3]
    best = table.filter("nom_commune = 'Bordeaux'").agg(F.max("prix")).first()[0]
    assert [r.prix for r in top if r.nom_commune == "Bordeaux" and r.rang == 1] == [best]


def test_rank_family_on_ties(sales):
    df = sales(*({"prix": p} for p in (500.0, 400.0, 400.0, 300.0)))
    rows = sorted(market.rank_family(df).collect(), key=lambda r: r.rang)
    assert [(r.rang, r.rang_saut, r.rang_dense) for r in rows] == [
        (1, 1, 1), (2, 2, 2), (3, 2, 2), (4, 4, 3),
    ]


def test_ranks_equal_the_window_functions(spark, sales):
    rows = [
        {"nom_commune": None if i % 11 == 0 else "hot" if i % 3 else f"c{i % 7}", "prix": i * 13 % 29 * 1.0}
        for i in range(400)
    ]
    df = sales(*rows).repartition(5)
    commune = Window.partitionBy("nom_commune")
    tied = commune.orderBy(F.desc("prix"))
    plain = df.select(
        "nom_commune", "id_mutation", "prix",
        F.row_number().over(commune.orderBy(F.desc("prix"), "id_mutation")),
        F.rank().over(tied), F.dense_rank().over(tied),
    )
    ours = market.rank_family(df)
    assert sorted(map(tuple, ours.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    assert market.rank_family(df.limit(0)).count() == 0


def test_change_compares_with_the_previous_year_present(table):
    rows = {(r.nom_commune, r.annee): r for r in market.commune_yoy(table, 30).collect()}
    assert rows["Bordeaux", 2022].prix_m2_precedent is None
    assert rows["Bordeaux", 2022].variation_pct is None
    cenon = rows["Cenon", 2024]
    assert ("Cenon", 2023) not in rows
    assert cenon.prix_m2_precedent == rows["Cenon", 2022].prix_m2_median
    ratio = cenon.prix_m2_median / cenon.prix_m2_precedent
    assert cenon.variation_pct == pytest.approx(100 * (ratio - 1), abs=0.05)
    assert all(commune is not None for commune, _ in rows)


def test_null_commune_takes_a_place_but_is_not_shown(sales):
    df = sales({"nom_commune": None}, {"nom_commune": None}, {}, {"nom_commune": "Pessac"})
    assert {r.nom_commune for r in market.commune_yoy(df, 2).collect()} == {"Nantes"}
    assert {r.nom_commune for r in market.top_sales_per_commune(df, 2).collect()} == {"Nantes"}


def test_quintiles_have_equal_sizes(table):
    rows = market.price_quintiles(table.filter("id_mutation < 's02998'")).collect()
    assert [r.nb_ventes for r in rows] == [600, 600, 600, 599, 599]
    for lower, upper in zip(rows, rows[1:]):
        assert lower.prix_max <= upper.prix_min


def test_shares_and_subtotals(table, sales):
    assert market.commune_share(table).agg(F.sum("part")).first()[0] == pytest.approx(1.0)
    assert tuple(market.subtotal_check(table).first()) == (3000, 3000, True)
    assert tuple(market.subtotal_check(sales({}, {"type_bien": None})).first()) == (1, 2, False)


def test_median_audit_counts_true_ranks(spark, table):
    exact = {r.nom_commune: r for r in market.median_audit(table, "nom_commune", F.col("prix")).collect()}
    assert None in exact and all(r.erreur_rang == 0.0 and r.tenue for r in exact.values())
    assert sum(r.n for r in exact.values()) == table.count()
    # A sketch of few entries rounds; the audit sees by how much.
    spread = spark.range(0, 40_000, 1, 6).select(F.lit("g").alias("g"), (F.col("id") * 1.0).alias("v"))
    row = market.median_audit(spread, "g", F.col("v"), size=64, salts=3).first()
    true = abs(row.mediane + 1 - 20_000) / 40_000
    assert row.n == 40_000 and row.erreur_rang == pytest.approx(true) and row.erreur_rang > 0
    assert row.tenue == (row.erreur_rang <= 3 * 2.296 / 64**0.9723)


def test_median_audit_of_ties_and_nothing(spark):
    df = spark.createDataFrame([("t", 1.0)] * 9 + [("t", 2.0), ("n", None), ("n", float("nan"))], "g string, v double")
    rows = market.median_audit(df, "g", F.col("v")).collect()
    assert [(r.g, r.n, r.mediane, r.erreur_rang, r.tenue) for r in rows] == [("t", 10, 1.0, 0.0, True)]

