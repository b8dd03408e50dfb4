import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lotwise.functions.ranking import with_ntile, with_position


@pytest.fixture(scope="module")
def prices(spark):
    """A third of the rows share one price."""
    rng = np.random.default_rng(9)
    rows = [
        (f"s{i:05d}", 147_000.0 if rng.random() < 0.34 else float(rng.integers(10, 400) * 1000))
        for i in range(5003)
    ]
    return spark.createDataFrame(rows, "id string, prix double").repartition(5)


def test_positions_are_the_global_order(prices):
    ranked = with_position(prices, ["prix", "id"]).collect()
    assert {r.n_rows for r in ranked} == {5003}
    by_position = sorted(ranked, key=lambda r: r.position)
    assert [r.position for r in by_position] == list(range(1, 5004))
    assert by_position == sorted(ranked, key=lambda r: (r.prix, r.id))


@pytest.mark.parametrize("tiles", [1, 5, 7])
def test_tiles_equal_the_window_function(prices, tiles):
    ours = with_ntile(prices, tiles, ["prix", "id"], "tile")
    plain = prices.withColumn("tile", F.ntile(tiles).over(Window.orderBy("prix", "id")))
    assert ours.columns == plain.columns
    assert ours.dtypes == plain.dtypes
    assert sorted(ours.collect()) == sorted(plain.collect())


def test_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "id string, prix double")
    tiles = with_ntile(df, 5, ["prix", "id"], "tile").orderBy("id").collect()
    assert [r.tile for r in tiles] == [1, 2]
    assert with_ntile(df.limit(0), 5, ["prix", "id"], "tile").count() == 0
