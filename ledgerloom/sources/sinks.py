"""Writers. A snapshot is written beside the old one, never over its input."""
from pyspark.sql import DataFrame, functions as F

from ledgerloom.sources.readers import TIME_FORMATS


def append(df: DataFrame, path: str, partition_by: list | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: list | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list) -> None:
    """Overwrite the partitions that have rows here; all others keep their files. The rebalance hint gathers the rows of a
    partition and lets Spark split one that is much larger than others."""
    df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def export_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8") -> None:
    df.write.mode("overwrite").options(header=True, sep=sep, encoding=encoding, **TIME_FORMATS).csv(path)


def export_daily(df: DataFrame, path: str, ts: str, sep: str = ",") -> None:
    """One folder of files per day, in one write. The rebalance hint gathers the
    rows of a day and lets Spark split a day that is much larger than others."""
    df.withColumn("event_date", F.to_date(ts)).hint("rebalance", "event_date").write.mode("overwrite").partitionBy(
        "event_date").options(header=True, sep=sep, **TIME_FORMATS).csv(path)


def export_exceptions(exceptions: DataFrame, path: str, column: str = "exception_column") -> None:
    """Rejected rows in one folder per failed column."""
    exceptions.hint("rebalance", column).write.mode("overwrite").partitionBy(column).options(header=True, **TIME_FORMATS).csv(path)


def publish(df: DataFrame, path: str) -> None:
    """Result rows as JSON lines."""
    df.write.mode("overwrite").json(path)
