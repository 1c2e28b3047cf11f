"""Streams over landed files. Each job runs on what is there and stops, so a
scheduler can start it again; offsets and keyed state live in the checkpoint."""
from pyspark.sql import DataFrame, SparkSession, functions as F

def parquet_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def csv_stream(spark: SparkSession, path: str, schema, pattern: str, header: bool = True) -> DataFrame:
    return spark.readStream.schema(schema).options(header=header, pathGlobFilter=pattern, recursiveFileLookup=True).csv(path)


def unique_requests(stream: DataFrame, key: str, ts: str, look_back: str = "30 days") -> DataFrame:
    """Requests seen for the first time within the look-back."""
    return stream.withWatermark(ts, look_back).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything there is into a parquet folder."""
    query = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start(path)
    query.awaitTermination()


def run_upserts(stream: DataFrame, checkpoint: str, keys: list, newest_by: list) -> DataFrame:
    """Keep the newest row of each key, over all deliveries; returns the newest snapshot.

    The rows are keyed state of the stream: a delivery writes the keys it has,
    however many others there are. The snapshot is the state as of the last
    finished batch, read from the checkpoint, so a run that finds nothing new
    returns it as it was.
    """
    rest = [c for c in stream.columns if c not in keys and c not in newest_by]
    newest = stream.groupBy(*keys).agg(F.max(F.struct(*newest_by, *rest)).alias("row"))
    state = _run_stateful(newest, checkpoint)
    if state is None:
        return stream.sparkSession.createDataFrame([], stream.schema)
    return state.select("key.*", "value.max").toDF(*keys, "row").select(*keys, "row.*").select(stream.columns)


def hourly_totals(stream: DataFrame, ts: str, amount: str, checkpoint: str) -> DataFrame:
    """Count and sum per hour over all rows ever delivered, however late; the hours are keyed state, as above."""
    totals = stream.groupBy(F.date_trunc("hour", ts).alias("hour")).agg(F.count(F.lit(1)).alias("total_count"), F.sum(amount).alias("total_sum"))
    state = _run_stateful(totals, checkpoint)
    if state is None:
        return stream.sparkSession.createDataFrame([], totals.schema)
    total = F.col("value.sum").cast(totals.schema["total_sum"].dataType)
    return state.select("key.*", "value.count", total).toDF(*totals.columns)


def _run_stateful(updates: DataFrame, checkpoint: str) -> DataFrame | None:
    """Fold what there is into the stream's state; returns the state (``key``, ``value``), or None before the first batch."""
    spark = updates.sparkSession
    updates.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    done = files.exists(path) and any(status.getPath().getName().isdigit() for status in files.listStatus(path))
    return spark.read.format("statestore").load(checkpoint) if done else None
