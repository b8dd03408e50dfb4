import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lotwise.plans.session import local_session  # noqa: E402
from lotwise.schemas import CLEAN_SALE, LOT_ORDER, RAW_LOT  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lots(spark):
    """Raw lots out of partial rows; ``lot_order`` follows the list."""

    def build(*rows, ordered=True):
        defaults = {
            "date_mutation": "2023-10-06",
            "nature_mutation": "Vente",
            "valeur_fonciere": 240_000.0,
            "nom_commune": "Nantes",
            "code_postal": 44000.0,
            "type_local": "Appartement",
            "surface_reelle_bati": 75.0,
            "nombre_pieces_principales": 4.0,
            "surface_terrain": 0.0,
            "longitude": -1.55,
            "latitude": 47.22,
        }
        names = RAW_LOT.fieldNames()
        full = [{**defaults, **row} for row in rows]
        if not ordered:
            return spark.createDataFrame([tuple(r[n] for n in names) for r in full], RAW_LOT)
        schema = RAW_LOT.jsonValue()
        schema = type(RAW_LOT).fromJson(schema).add(LOT_ORDER, "long")
        return spark.createDataFrame(
            [(*(r[n] for n in names), i) for i, r in enumerate(full)], schema
        )

    return build


@pytest.fixture
def sales(spark):
    """Clean sales out of partial rows."""

    def build(*rows):
        defaults = {
            "date_mutation": "2023-10-06",
            "prix": 240_000.0,
            "nom_commune": "Nantes",
            "code_postal": 44000.0,
            "nb_logements": 1,
            "nb_lots": 1,
            "surface_bati": 75.0,
            "nb_pieces": 4.0,
            "surface_terrain": 0.0,
            "longitude": -1.55,
            "latitude": 47.22,
            "type_bien": "Appartement",
        }
        names = CLEAN_SALE.fieldNames()
        full = [{"id_mutation": f"s{i:04d}", **defaults, **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in full], CLEAN_SALE)

    return build


def values(df, column):
    return sorted(row[0] for row in df.select(column).collect())
