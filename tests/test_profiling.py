import numpy as np
import pytest

from lotwise.operators import profiling
from lotwise.operators.cleaning import aggregate_by_sale
from tests.conftest import values


def test_value_counts_with_and_without_null(lots):
    df = lots(
        {"id_mutation": "A"}, {"id_mutation": "A"}, {"id_mutation": "B", "type_local": None},
        {"id_mutation": "C", "type_local": "Maison"},
    )
    assert [tuple(r) for r in profiling.value_counts(df, "type_local").collect()] == [
        ("Appartement", 2), ("Maison", 1),
    ]
    with_null = profiling.value_counts(df, "type_local", keep_null=True).collect()
    assert {tuple(r) for r in with_null} == {("Appartement", 2), ("Maison", 1), (None, 1)}


def test_histogram_and_scope_of_dwellings(lots):
    df = lots(
        {"id_mutation": "A"}, {"id_mutation": "B"}, {"id_mutation": "B"},
        {"id_mutation": "C", "type_local": "Dependance"}, {"id_mutation": "D"},
    )
    sales = aggregate_by_sale(df)
    assert [tuple(r) for r in profiling.dwelling_histogram(sales).collect()] == [
        (0, 1), (1, 2), (2, 1),
    ]
    assert len(profiling.dwelling_histogram(sales, 2).collect()) == 2
    scope = {r.logements: (r.mutations, r.part) for r in profiling.dwelling_scope(sales).collect()}
    assert scope == {"0": (1, 0.25), "1": (2, 0.5), ">=2": (1, 0.25)}


def test_shape_distinct_and_null_rate(lots):
    df = lots({"id_mutation": "A"}, {"id_mutation": "A", "valeur_fonciere": None}, {"id_mutation": None})
    assert tuple(profiling.shape(df).first()) == (3, 13)
    for approximate in (False, True):
        assert profiling.distinct_count(df, "id_mutation", approximate=approximate).first()[0] == 1
    assert profiling.null_rate(df, "valeur_fonciere").first()[0] == 0.333


def test_describe(sales):
    prices = [5.0, 1.0, 3.0, 10.0, None]
    row = profiling.describe(sales(*({"prix": p} for p in prices)), "prix").first()
    known = np.array(prices[:4])
    assert (row.n, row["min"], row["max"]) == (4, 1.0, 10.0)
    assert row["mean"] == pytest.approx(known.mean())
    assert row["std"] == pytest.approx(known.std(ddof=1))
    assert [row.p25, row.p50, row.p75] == pytest.approx(list(np.quantile(known, [0.25, 0.5, 0.75])))


def test_lots_of_sales_without_dwelling(lots):
    df = lots(
        {"id_mutation": "A"}, {"id_mutation": "A", "type_local": None},
        {"id_mutation": "B", "type_local": None}, {"id_mutation": "B", "type_local": "Dependance"},
    )
    assert values(profiling.no_dwelling_lots(df), "id_mutation") == ["B", "B"]


def test_lots_of_the_largest_sale(lots):
    df = lots(
        {"id_mutation": "C"}, {"id_mutation": "B"}, {"id_mutation": "B"}, {"id_mutation": "A"},
        {"id_mutation": "A", "type_local": "Maison"}, {"id_mutation": None},
        {"id_mutation": None}, {"id_mutation": None},
    )
    largest = profiling.largest_sale_lots(df)
    assert values(largest, "id_mutation") == ["A", "A"]
    assert len(largest.columns) == 6
    single = lots({"id_mutation": "A"}, {"id_mutation": "B"})
    assert profiling.largest_sale_lots(single).count() == 0
