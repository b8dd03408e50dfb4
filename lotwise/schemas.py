"""Column layouts of each layer and the fixed values the cleaning rules rely on."""

from pyspark.sql import types as T

STRING, DOUBLE, LONG, INT, DATE = (
    T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.DateType()
)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# One row per lot; the sale price is repeated on every lot of the sale.
RAW_LOT = _schema(
    id_mutation=STRING,
    date_mutation=STRING,
    nature_mutation=STRING,
    valeur_fonciere=DOUBLE,
    nom_commune=STRING,
    code_postal=DOUBLE,
    type_local=STRING,
    surface_reelle_bati=DOUBLE,
    nombre_pieces_principales=DOUBLE,
    surface_terrain=DOUBLE,
    longitude=DOUBLE,
    latitude=DOUBLE,
)

# One row per sale.
CLEAN_SALE = _schema(
    id_mutation=STRING,
    date_mutation=STRING,
    prix=DOUBLE,
    nom_commune=STRING,
    code_postal=DOUBLE,
    nb_logements=LONG,
    nb_lots=LONG,
    surface_bati=DOUBLE,
    nb_pieces=DOUBLE,
    surface_terrain=DOUBLE,
    longitude=DOUBLE,
    latitude=DOUBLE,
    type_bien=STRING,
)

STAGED_SALE = _schema(
    id_mutation=STRING,
    prix=DOUBLE,
    nom_commune=STRING,
    nb_logements=LONG,
    nb_lots=LONG,
    surface_bati=DOUBLE,
    surface_terrain=DOUBLE,
    longitude=DOUBLE,
    latitude=DOUBLE,
    type_bien=STRING,
    date_mutation=DATE,
    code_postal=STRING,
    nb_pieces=LONG,
)

# Optional column of the raw layer: position of a lot in its source. It decides
# which lot counts as the first one of a sale.
LOT_ORDER = "lot_order"

# --- Fixed values --------------------------------------------------------------
DWELLING_TYPES = ("Maison", "Appartement")
MARKET_NATURES = ("Vente",)
MIN_PRICE, MAX_PRICE = 10_000.0, 5_000_000.0
MIN_AREA, MAX_AREA = 9.0, 1000.0
MIN_SURVIVAL_RATE = 0.10

# Cells that mean "missing" in the raw CSV files.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

FRENCH_MONTHS = (
    "janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août",
    "septembre", "octobre", "novembre", "décembre",
)

# Hashed in place of a null by the surrogate-key convention of the warehouse.
NULL_KEY_MARKER = "_dbt_utils_surrogate_key_null_"
# -------------------------------------------------------------------------------
