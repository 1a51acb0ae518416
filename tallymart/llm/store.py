"""Reading tables and handing over stored ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymart.session import scratch_path

#: rows that Spark hands to Python at once; texts are long, so not its 10,000
BATCH_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The rows, written to the shared folder and read again: a cut of the
    lineage that survives the loss of executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)
