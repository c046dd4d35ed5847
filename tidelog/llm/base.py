"""What several operators share: staged tables and table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import configure, unstage, workspace

#: Rows and bytes of an Arrow batch: a Python worker holds a few at a time, and a
#: row here may be a whole text or set.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


#: Rows of fixed width that may be broadcast: some tens of megabytes.
BROADCAST_ROWS = 500_000


def checked(staged: DataFrame) -> DataFrame:
    """A staged table of fixed-width rows, broadcast if it is counted to be small.

    A larger one is left to the planner, which joins by shuffling.
    """
    return F.broadcast(staged) if staged.count() <= BROADCAST_ROWS else staged


def small_batches(spark: SparkSession) -> None:
    """Bound what Python workers hold; every operator that uses Python asks for it."""
    for key, value in ARROW.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by name, with the library's session settings applied."""
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder, compressed, and read it back.

    The written table outlives any executor, cuts the lineage, and tells the
    planner its exact size.
    """
    path = workspace(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing will read again."""
    unstage(*staged)
