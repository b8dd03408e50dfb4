"""Clean sales to a fitted, evaluated and documented price model."""

import argparse
import logging
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from lotwise.operators.metrics import Metrics, evaluate
from lotwise.operators.pricing import (
    FEATURES,
    MAX_DEPTH,
    MAX_ITER,
    SPLIT_DATE,
    predict,
    predict_baseline,
    save_model,
    time_based_split,
    train_model,
)
from lotwise.sources.scratch import stored
from lotwise.sources.tables import read_parquet

logger = logging.getLogger(__name__)

_CARD = (
    "split_date string, training_sales long, test_sales long, columns array<string>, "
    "metrics struct<mae double, mape double, rmse double>, "
    "baseline struct<mae double, mape double, rmse double>"
)


def model_card(
    spark: SparkSession, split_date: str, n_train: int, n_test: int, model: Metrics, base: Metrics
) -> DataFrame:
    """One row describing the data, the columns and the quality of a model."""
    row = (split_date, n_train, n_test, list(FEATURES), asdict(model), asdict(base))
    return spark.createDataFrame([row], _CARD)


def train_and_evaluate(
    sales: DataFrame,
    folder: str,
    split_date: str = SPLIT_DATE,
    max_iter: int = MAX_ITER,
    max_depth: int = MAX_DEPTH,
    early_stopping: bool = False,
) -> tuple[PipelineModel, DataFrame]:
    """Train before the date, test after it, and write model and card under ``folder``."""
    train, test = (stored(part) for part in time_based_split(sales, split_date))
    baseline = evaluate(predict_baseline(train, test))
    logger.info("Baseline: %s", baseline.summary())
    model = train_model(train, max_iter, max_depth, early_stopping)
    quality = evaluate(predict(model, test))
    logger.info("Model: %s", quality.summary())
    logger.info("Gain over the baseline: %.1f%%", 100 * quality.gain_over(baseline))

    card = model_card(
        sales.sparkSession, split_date, train.count(), test.count(), quality, baseline
    )
    save_model(model, f"{folder}/model")
    card.coalesce(1).write.mode("overwrite").json(f"{folder}/model_card")
    return model, card


def main(arguments: Sequence[str] | None = None) -> None:
    """``spark-submit lotwise/plans/training.py --sales ... --folder ...``."""
    parser = argparse.ArgumentParser(description="Train and evaluate the price model.")
    parser.add_argument("--sales", required=True, help="folder of the clean table")
    parser.add_argument("--folder", required=True, help="folder for the model and its card")
    parser.add_argument("--split-date", default=SPLIT_DATE)
    parser.add_argument("--max-iter", type=int, default=MAX_ITER)
    parser.add_argument("--max-depth", type=int, default=MAX_DEPTH)
    parser.add_argument("--early-stopping", action="store_true", help="held-out sales end the boosting")
    options = vars(parser.parse_args(arguments))
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    spark = SparkSession.builder.getOrCreate()
    train_and_evaluate(read_parquet(spark, options.pop("sales")), **options)


if __name__ == "__main__":
    main()
