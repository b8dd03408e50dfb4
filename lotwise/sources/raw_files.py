"""Yearly gzip CSV files of raw lots."""

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lotwise.schemas import LOT_ORDER, MISSING_TOKENS, RAW_LOT

logger = logging.getLogger(__name__)


def raw_file_path(folder: str, dataset: str, department: str, year: int) -> str:
    """``<folder>/<dataset>_<department>_<year>.csv.gz``."""
    return f"{folder.rstrip('/')}/{dataset}_{department}_{year}.csv.gz"


# Columns of the file lineage.
SOURCE_FILE, MALFORMED = "source_file", "malformed"
_UNPARSED = "_unparsed_row"
# The place of a row within a file stays below this power of two: a file of a million parts.
_FILE_BITS = 53


def read_raw_file(
    spark: SparkSession, path: str, *, all_columns: bool = False, lineage: bool = False
) -> DataFrame:
    """Read one raw file, by header name, with the types of the raw layer.

    A user schema on CSV binds by position, so every cell is read as text, picked
    by name and cast. Without ``all_columns`` the parser skips all but the twelve
    columns of the raw layer. ``lot_order`` is the row's place in the file. A cell that is
    not of its type fails the job.

    With ``lineage`` it does not: such a cell is null, and ``malformed`` lists the names of
    all such cells of the row, empty for a sound row, with ``row`` for a row that has too many
    or too few cells. ``source_file`` is the name of the file the row is from, or of the
    folder that stands for it. The parser then reads whole rows.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", True)  # quoted line breaks; gzip is not splittable anyway
        .option("escape", '"')
    )
    text = reader.csv(path)
    header = text.columns
    names = header if all_columns else RAW_LOT.fieldNames()
    typed = {field.name: field.dataType for field in RAW_LOT}
    if lineage:
        cells = StructType([StructField(name, StringType()) for name in [*header, _UNPARSED]])
        text = reader.schema(cells).option("columnNameOfCorruptRecord", _UNPARSED).csv(path)

    def present(name: str) -> Column:
        value = F.col(f"`{name}`")
        return F.when(~value.isin(*MISSING_TOKENS), value)

    def cell(name: str) -> Column:
        cast = Column.try_cast if lineage else Column.cast
        return cast(present(name), typed.get(name, "string")).alias(name)

    order = F.monotonically_increasing_id().alias(LOT_ORDER)
    if not lineage:
        return text.select(*map(cell, names), order)
    bad_cells = [
        F.when(present(name).isNotNull() & present(name).try_cast(typed[name]).isNull(), F.lit(name))
        for name in names
        if not isinstance(typed.get(name, StringType()), StringType)
    ]
    bad_row = F.when(F.col(_UNPARSED).isNotNull(), F.lit("row"))
    file = F.regexp_extract("_metadata.file_path", r"([^/]+\.csv\.gz)(?:/[^/]*)?$", 1)
    return text.select(
        *map(cell, names), order, file.alias(SOURCE_FILE), F.array_compact(F.array(bad_row, *bad_cells)).alias(MALFORMED)
    )


def write_raw_file(lots: DataFrame, path: str) -> None:
    """Write lots as a raw file: a folder of gzip CSV parts, read back like a single file."""
    lots.write.option("header", True).option("compression", "gzip").option("escape", '"').csv(path)


def load_years(
    spark: SparkSession,
    folder: str,
    dataset: str,
    department: str,
    years: Sequence[int],
    *,
    lineage: bool = False,
) -> DataFrame:
    """Union the files of several years; missing years are skipped with a warning.

    Adds ``source_year``. Files are read one by one because Spark would apply the
    header of the first to all of them. ``lot_order`` keeps the order of ``years``,
    then the order within each file. ``lineage`` as in ``read_raw_file``.
    """
    frames = []
    for rank, year in enumerate(years):
        path = raw_file_path(folder, dataset, department, year)
        try:
            lots = read_raw_file(spark, path, lineage=lineage)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            logger.warning("No file for %s, year skipped: %s", year, path)
            continue
        frames.append(
            lots.withColumn(LOT_ORDER, F.col(LOT_ORDER) + F.lit(rank << _FILE_BITS))
            .withColumn("source_year", F.lit(year))
        )
    if not frames:
        raise FileNotFoundError(f"No raw file of department {department} in {folder}")
    return reduce(DataFrame.unionByName, frames)
