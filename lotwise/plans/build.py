"""Raw files to the clean sales table, behind the quality gate."""

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions.quantiles import exact_quantiles_of
from lotwise.operators.cleaning import audited_sales, clean_from_audited, cleaning_funnel
from lotwise.operators.quality import CleaningReport, check_quality, cleaning_report
from lotwise.schemas import MIN_SURVIVAL_RATE
from lotwise.sources.raw_files import load_years
from lotwise.sources.scratch import stored
from lotwise.sources.tables import read_parquet, write_parquet

logger = logging.getLogger(__name__)


def build_clean_table(
    lots: DataFrame, destination: str, min_rate: float = MIN_SURVIVAL_RATE
) -> CleaningReport:
    """Clean ``lots``, check the survival rate, then publish to ``destination``.

    The raw lots are read once: sales and step counts come out of the same pass,
    which is stored before the gate. A failed gate leaves the destination as it was.
    """
    audited = stored(audited_sales(lots))
    report = CleaningReport.of(cleaning_report(cleaning_funnel(audited)))
    check_quality(report, min_rate)
    logger.info(report.summary())
    write_parquet(clean_from_audited(audited), destination)
    return report


def build_from_files(
    spark: SparkSession,
    folder: str,
    dataset: str,
    department: str,
    years: Sequence[int],
    destination: str,
    min_rate: float = MIN_SURVIVAL_RATE,
) -> DataFrame:
    """Load the yearly files, build the clean table and return it."""
    build_clean_table(load_years(spark, folder, dataset, department, years), destination, min_rate)
    sales = read_parquet(spark, destination)
    row = exact_medians(sales).first()
    logger.info("Median price %.0f EUR, median area %.0f sqm", *row)
    return sales


def exact_medians(sales: DataFrame) -> DataFrame:
    """Interpolated median price and area, as one row; ``sales`` is a stored table."""
    found = exact_quantiles_of(sales, ["prix", "surface_bati"], [0.5])

    def of(column: str):
        return F.max(F.when(F.col("column") == column, F.col("quantiles")[0]))

    return found.agg(of("prix").alias("prix_median"), of("surface_bati").alias("surface_mediane"))


def main(arguments: Sequence[str] | None = None) -> None:
    """``spark-submit lotwise/plans/build.py --folder ... --destination ...``."""
    parser = argparse.ArgumentParser(description="Build the clean sales table.")
    parser.add_argument("--folder", required=True, help="folder of the yearly raw files")
    parser.add_argument("--dataset", required=True, help="first part of the file names")
    parser.add_argument("--department", default="33")
    parser.add_argument("--years", type=int, nargs="+", default=[2022, 2023, 2024])
    parser.add_argument("--destination", required=True, help="folder of the clean table")
    parser.add_argument("--min-rate", type=float, default=MIN_SURVIVAL_RATE)
    options = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    build_from_files(SparkSession.builder.getOrCreate(), **vars(options))


if __name__ == "__main__":
    main()
