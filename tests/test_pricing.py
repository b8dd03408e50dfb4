import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.operators import metrics, pricing
from lotwise.plans.training import train_and_evaluate
from lotwise.sources.scratch import stored
from tests.conftest import values


@pytest.fixture
def dated(sales):
    return sales(
        {"date_mutation": "2022-05-10", "prix": 200_000.0},
        {"date_mutation": "2023-11-02", "prix": 250_000.0, "type_bien": "Maison"},
        {"date_mutation": "2024-03-15", "prix": 300_000.0},
        {"date_mutation": "2024-07-20", "prix": 180_000.0},
    )


def predictions(spark, *pairs):
    rows = [(f"s{i:03d}", float(a), float(p)) for i, (a, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, "id_mutation string, prix double, prediction double")


def test_split_by_date_is_a_partition(dated):
    train, test = pricing.time_based_split(dated, "2024-01-01")
    assert values(train, "date_mutation") == ["2022-05-10", "2023-11-02"]
    assert values(test, "date_mutation") == ["2024-03-15", "2024-07-20"]
    assert tuple(pricing.split_counts(dated, "2024-01-01").first()) == (2, 2, 4)
    on_the_day = pricing.split_counts(dated, "2024-03-15").first()
    assert tuple(on_the_day) == (2, 2, 4)


def test_split_of_real_dates_reaches_the_scan(dated):
    table = stored(dated.withColumn("date_mutation", F.to_date("date_mutation")))
    train, _ = pricing.time_based_split(table, "2024-01-01")
    assert "LessThan(date_mutation,2024-01-01)" in (
        train._jdf.queryExecution().executedPlan().toString()
    )


def test_features_have_the_month_but_no_date(dated):
    features = pricing.build_features(dated)
    assert features.columns == [*pricing.FEATURES, "prix"]
    assert values(features, "mois") == [3, 5, 7, 11]
    assert not {"annee", "date_mutation"} & set(features.columns)


def test_error_means(spark):
    perfect = metrics.evaluate(predictions(spark, (100, 100), (200, 200)))
    assert (perfect.mae, perfect.mape, perfect.rmse) == (0.0, 0.0, 0.0)
    found = metrics.evaluate(predictions(spark, (100, 90), (200, 220)))
    assert found.mae == pytest.approx(15.0)
    assert found.mape == pytest.approx(0.10)
    assert found.rmse == pytest.approx(np.sqrt(250))
    one_large = metrics.evaluate(predictions(spark, (100, 100), (100, 100), (100, 160)))
    assert one_large.rmse > one_large.mae
    assert metrics.Metrics(63966.4, 0.308, 124292.0).summary() == (
        "mean error 63,966 EUR, 30.8% of the price; root mean square 124,292 EUR"
    )


def test_gain_over_the_baseline():
    base, model = metrics.Metrics(200.0, 0.2, 1.0), metrics.Metrics(50.0, 0.1, 1.0)
    assert model.gain_over(base) == 0.75
    assert np.isnan(base.gain_over(metrics.Metrics(0.0, 0.0, 0.0)))


def test_error_distribution(spark):
    pairs = [(100, 100 + i) for i in range(1, 102)]
    row = metrics.error_distribution(predictions(spark, *pairs)).first()
    assert row.mediane == pytest.approx(0.51)
    assert row.p90 == pytest.approx(0.91)
    assert row.p99 == pytest.approx(1.00)
    assert row.moyenne == pytest.approx(0.51)


def test_price_quantiles_interpolate(spark):
    df = predictions(spark, *((p, p) for p in (1, 2, 3, 4)))
    rows = metrics.price_quantiles(df, (0.5, 0.2, 1.0)).collect()
    assert [r.proba for r in rows] == [0.5, 0.2, 1.0]
    assert [r.prix for r in rows] == pytest.approx([2.5, 1.6, 4.0])


def test_error_per_price_quintile(spark):
    df = predictions(spark, *((100 * i, 100 * i + (50 if i <= 4 else 1)) for i in range(1, 21)))
    rows = metrics.error_by_price_quintile(df).collect()
    assert [r.quintile for r in rows] == [1, 2, 3, 4, 5]
    assert [r.prix_median for r in rows] == [250.0, 650.0, 1050.0, 1450.0, 1850.0]
    assert rows[0].erreur_mediane > 10 * rows[1].erreur_mediane


def test_baseline_uses_the_training_median_only(sales):
    train = sales(*({"prix": 2000.0 * a, "surface_bati": a} for a in (100.0, 150.0, 200.0)))
    test = sales({"prix": 99_999_999.0, "surface_bati": 50.0}, {"prix": 1.0, "surface_bati": 100.0})
    found = pricing.predict_baseline(train, test)
    assert values(found, "prediction") == pytest.approx([100_000.0, 200_000.0])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_commune_median_comes_from_training(sales):
    train = sales({"nom_commune": "Pessac", "prix": 90_000.0, "surface_bati": 30.0})
    test = sales({"nom_commune": "Pessac"}, {"nom_commune": "Cenon"}, {"nom_commune": None})
    rows = {r.nom_commune: r.prix_m2_commune for r in pricing.with_commune_median(train, test).collect()}
    assert rows == {"Pessac": 3000.0, "Cenon": None, None: None}


@pytest.fixture(scope="module")
def priced_by_area(spark):
    """Price is 3000 per square metre; some coordinates are missing."""
    rows = [
        (
            f"s{i:03d}", "2023-06-15" if i % 6 else "2024-02-01", 3000.0 * (40 + i), 40.0 + i,
            1.0 + i % 5, i % 3 * 100.0, None if i % 8 == 0 else -0.57 + i % 7 * 0.01,
            44.83 + i % 5 * 0.01, 1 + i % 2, "Maison" if i % 2 else "Appartement",
        )
        for i in range(60)
    ]
    return stored(spark.createDataFrame(
        rows,
        "id_mutation string, date_mutation string, prix double, surface_bati double, "
        "nb_pieces double, surface_terrain double, longitude double, latitude double, "
        "nb_lots long, type_bien string",
    ).coalesce(1))


@pytest.mark.slow
def test_model_is_usable_and_reproducible(priced_by_area, tmp_path):
    first = pricing.train_model(priced_by_area, max_iter=8, max_depth=4)
    again = pricing.train_model(priced_by_area, max_iter=8, max_depth=4)
    found = pricing.predict(first, priced_by_area)
    assert found.columns == [*priced_by_area.columns, "prediction"]
    assert found.count() == 60 and found.filter("prediction <= 0").count() == 0
    assert values(found, "prediction") == values(pricing.predict(again, priced_by_area), "prediction")
    assert metrics.evaluate(found).mape < 0.15

    pricing.save_model(first, str(tmp_path / "model"))
    loaded = pricing.load_model(str(tmp_path / "model"))
    unseen = priced_by_area.drop("prix").withColumn("type_bien", F.lit(None).cast("string"))
    assert pricing.predict(loaded, unseen).filter("prediction > 0").count() == 60


@pytest.mark.slow
def test_training_run_writes_model_and_card(spark, priced_by_area, tmp_path):
    noisy = priced_by_area.withColumn(
        "prix", F.col("prix") * F.when(F.col("type_bien") == "Maison", 2.0).otherwise(1.0)
    )
    model, card = train_and_evaluate(noisy, str(tmp_path), max_iter=8, max_depth=4)
    (path,) = (tmp_path / "model_card").glob("part-*.json")
    written = json.loads(path.read_text())
    assert (written["training_sales"], written["test_sales"]) == (50, 10)
    assert written["split_date"] == "2024-01-01"
    assert written["columns"] == list(pricing.FEATURES)
    assert written["metrics"]["mae"] < written["baseline"]["mae"]
    assert pricing.load_model(str(tmp_path / "model")).stages
    train, test = pricing.time_based_split(noisy, "2024-01-01")
    gains = pricing.compare_with_baseline(
        pricing.predict_baseline(train, test), pricing.predict(model, test)
    ).collect()
    assert [g.modele for g in gains] == ["baseline", "model"]
    assert gains[0].gain == 0.0 and gains[1].gain > 0


@pytest.mark.slow
def test_held_out_sales_end_the_boosting(spark, priced_by_area):
    many = stored(priced_by_area.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(8)))).withColumns(
        {"id_mutation": F.concat("id_mutation", F.col("copy").cast("string")), "prix": F.col("prix") * (0.9 + 0.2 * F.rand(3))}
    ).drop("copy").coalesce(1))
    model = pricing.train_model(many, max_iter=40, max_depth=3, early_stopping=True)
    assert 1 <= pricing.boosting_rounds(model) < 40
    assert pricing.boosting_rounds(pricing.train_model(many, max_iter=5, max_depth=3)) == 5
    found = pricing.predict(model, many)
    assert found.columns == [*many.columns, "prediction"]
    assert metrics.evaluate(found).mae < metrics.evaluate(pricing.predict_baseline(many, many.limit(0).unionByName(many))).mae * 1.5


def test_default_parameters():
    assert (pricing.MAX_ITER, pricing.LEARNING_RATE, pricing.MAX_DEPTH, pricing.SEED) == (300, 0.08, 8, 42)
