"""Intermediate tables on the shared folder of the cluster."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """This application's subfolder of the folder named by ``spark.checkpoint.dir``.

    Without that setting the warehouse, which all machines reach as well, takes its place.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{named.rstrip('/')}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession) -> str:
    """A path of the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    For frames consumed by several passes. Unlike a cache it survives the loss of
    executors without recomputation, it cuts the lineage, later passes read only
    the columns they need, and the optimizer knows its true size, so small tables
    are broadcast, and large ones are not, without any hint.
    """
    spark = df.sparkSession
    path = new_path(spark)
    with _shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _folders(df: DataFrame) -> list[str]:
    return sorted({file.rpartition("/")[0] for file in df.inputFiles()})


def together(frames: list[DataFrame]) -> DataFrame:
    """Stored frames of one schema, read at once."""
    folders = [folder for df in frames for folder in _folders(df)]
    if not folders:
        return frames[0]
    return frames[0].sparkSession.read.schema(frames[0].schema).parquet(*folders)


def discard(df: DataFrame) -> None:
    """Delete a stored frame that nothing reads any more."""
    spark = df.sparkSession
    for folder in _folders(df):
        if spark.sparkContext.applicationId not in folder:
            raise ValueError(f"not a stored frame: {folder}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are deleted as soon as it has ended.

    Else they stay until a collection on the driver, and a plan of many stored tables holds
    the shuffles of all of them on the executors' disks.
    """
    before = spark.conf.get(FILE_CLEANUP, "false")
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(FILE_CLEANUP, before)


def release(spark: SparkSession) -> bool:
    """Delete what this application has stored; results that still read it are lost."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(path, True)
