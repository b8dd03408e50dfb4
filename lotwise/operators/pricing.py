"""Price model: temporal split, features, baseline and boosted trees on log price."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.columns import price_per_sqm
from lotwise.functions.quantiles import exact_quantiles
from lotwise.operators.metrics import error_means
from lotwise.sources.scratch import shared_folder, stored
from lotwise.sources.tables import YEAR

# --- Fixed values --------------------------------------------------------------
NUMERIC_FEATURES = (
    "surface_bati", "nb_pieces", "surface_terrain", "longitude", "latitude", "nb_lots",
)
CATEGORICAL_FEATURES = ("type_bien",)
TARGET = "prix"
FEATURES = (*NUMERIC_FEATURES, "mois", *CATEGORICAL_FEATURES)

SPLIT_DATE = "2024-01-01"
MAX_ITER, LEARNING_RATE, MAX_DEPTH, MIN_LEAF, SEED = 300, 0.08, 8, 20, 42
# -------------------------------------------------------------------------------

# Early stopping: the held-out share of training sales, and the least gain of a round.
HELD_OUT, HELD_OUT_PART, STOP_GAIN = "_held_out", 10, 0.01

# Numeric features that may be missing after the cleaning.
_NULLABLE = ("longitude", "latitude")


def time_based_split(
    sales: DataFrame, split_date: str = SPLIT_DATE
) -> tuple[DataFrame, DataFrame]:
    """Sales before the date, and sales from the date on.

    ISO dates sort as text, so both filters reach the scan, be the column text or a date.
    Sales published by year are also filtered by that column, so that the scan of each part
    opens the folders of its years only.
    """
    sold, limit = F.col("date_mutation"), F.lit(split_date)
    before, after = sales.filter(sold < limit), sales.filter(sold >= limit)
    if YEAR in sales.columns:
        year = int(split_date[:4])
        before, after = before.filter(F.col(YEAR) <= year), after.filter(F.col(YEAR) >= year)
        if split_date[4:] == "-01-01":
            before = before.filter(F.col(YEAR) < year)
    return before, after


def split_counts(sales: DataFrame, split_date: str = SPLIT_DATE) -> DataFrame:
    """Size of both parts and of the whole, in one pass."""
    sold, limit = F.to_date("date_mutation"), F.lit(split_date).cast("date")
    return sales.agg(
        F.count_if(sold < limit).alias("n_train"),
        F.count_if(sold >= limit).alias("n_test"),
        F.count(F.lit(1)).alias("n_total"),
    )


def build_features(sales: DataFrame) -> DataFrame:
    """The feature columns and the target.

    The month stands for the season. The year is left out on purpose: trees do not
    extrapolate to a year they have not seen.
    """
    month = F.month(F.to_date("date_mutation")).alias("mois")
    return sales.select(*NUMERIC_FEATURES, month, *CATEGORICAL_FEATURES, TARGET)


def training_price_per_sqm(train: DataFrame) -> DataFrame:
    """One row: exact median price per square metre of the training sales."""
    ratios = train.select(price_per_sqm().alias("prix_m2"))
    return exact_quantiles(ratios, "prix_m2", [0.5]).select(
        F.col("quantiles")[0].alias("prix_m2_median")
    )


def predict_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test sales with ``prediction``: area times the training median, nothing of the test.

    The median, one number, is fetched first, so test sales are neither joined nor shuffled,
    and the ranks behind it are searched once.
    """
    found = training_price_per_sqm(train).first()
    median = F.lit(found.prix_m2_median if found else None).cast("double")
    return test.withColumn("prediction", F.col("surface_bati") * median)


def price_pipeline(
    max_iter: int = MAX_ITER, max_depth: int = MAX_DEPTH, early_stopping: bool = False
) -> Pipeline:
    """Month, imputed coordinates, indexed type, boosted trees and the way back to euros.

    With ``early_stopping`` boosting ends once the held-out sales gain less than
    ``STOP_GAIN`` of their error from a round. The trees refuse missing values: a missing coordinate takes the training median
    and raises a flag of its own, so that the trees can still tell it apart.
    """
    derived = ", ".join(
        ["month(to_date(date_mutation)) AS mois"]
        + [f"double({c} IS NULL OR isnan({c})) AS {c}_absent" for c in _NULLABLE]
    )
    imputed = [f"{c}_rempli" for c in _NULLABLE]
    inputs = [
        *(c for c in NUMERIC_FEATURES if c not in _NULLABLE),
        *imputed,
        *(f"{c}_absent" for c in _NULLABLE),
        "mois",
        *(f"{c}_code" for c in CATEGORICAL_FEATURES),
    ]
    stopping = {"validationIndicatorCol": HELD_OUT, "validationTol": STOP_GAIN} if early_stopping else {}
    trees = GBTRegressor(
        labelCol="log_prix",
        predictionCol="log_prediction",
        maxIter=max_iter,
        stepSize=LEARNING_RATE,
        maxDepth=max_depth,
        maxBins=255,
        minInstancesPerNode=MIN_LEAF,
        seed=SEED,
        checkpointInterval=10,
        **stopping,
    )
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {derived} FROM __THIS__"),
            Imputer(strategy="median", inputCols=list(_NULLABLE), outputCols=imputed),
            StringIndexer(
                inputCols=list(CATEGORICAL_FEATURES),
                outputCols=[f"{c}_code" for c in CATEGORICAL_FEATURES],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            ),
            VectorAssembler(inputCols=inputs, outputCol="features"),
            trees,
            SQLTransformer(statement="SELECT *, exp(log_prediction) AS prediction FROM __THIS__"),
        ]
    )


def train_model(
    train: DataFrame,
    max_iter: int = MAX_ITER,
    max_depth: int = MAX_DEPTH,
    early_stopping: bool = False,
) -> PipelineModel:
    """Fit the trees on the logarithm of the price, which weighs errors by ratio.

    Boosting reads the training sales again for every tree level: they should be a
    stored table. The trees cut their lineage in the checkpoint folder.

    With ``early_stopping`` one sale in ``HELD_OUT_PART``, by the hash of its id, is kept from
    the trees and decides how many rounds there are, ``max_iter`` at most. Hashes hold out the
    same sales in every run and on every cluster.
    """
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(train.sparkSession))
    logged = train.withColumn("log_prix", F.log(TARGET))
    if early_stopping:
        held = F.pmod(F.xxhash64("id_mutation"), F.lit(HELD_OUT_PART)) == 0
        logged = logged.withColumn(HELD_OUT, F.coalesce(held, F.lit(False)))
    return price_pipeline(max_iter, max_depth, early_stopping).fit(logged)


def boosting_rounds(model: PipelineModel) -> int:
    """Trees of the fitted model."""
    return next(s for s in model.stages if isinstance(s, GBTRegressionModel)).getNumTrees


def predict(model: PipelineModel, sales: DataFrame) -> DataFrame:
    """Sales with ``prediction`` in euros; the logarithm stays inside the model."""
    return model.transform(sales).select(*sales.columns, "prediction")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def compare_with_baseline(baseline: DataFrame, model: DataFrame) -> DataFrame:
    """Error means of both predictions side by side, and the gain in mean error."""
    base, tested = (
        error_means(predictions).withColumn("modele", F.lit(name))
        for name, predictions in (("baseline", baseline), ("model", model))
    )
    # Two rows, so one task does; a scalar subquery would evaluate the baseline again.
    base_mae = F.max(F.when(F.col("modele") == "baseline", F.col("mae"))).over(Window.partitionBy())
    return base.unionByName(tested).select(
        "modele", "mae", "mape", "rmse", (1 - F.try_divide(F.col("mae"), base_mae)).alias("gain")
    )


def with_commune_median(train: DataFrame, test: DataFrame) -> DataFrame:
    """Test sales with the training median price per square metre of their commune.

    Null for a commune without training sales: test prices must not leak in.
    """
    ratios = train.select("nom_commune", price_per_sqm().alias("prix_m2"))
    medians = stored(
        exact_quantiles(ratios, "prix_m2", [0.5], ["nom_commune"]).select(
            "nom_commune", F.col("quantiles")[0].alias("prix_m2_commune")
        )
    )
    return test.join(medians, "nom_commune", "left")
