"""Incremental loads with Structured Streaming: a checkpoint takes the place of the state column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from fieldmart.operators.load import FactSpec, load_insert_new, load_merge_latest
from fieldmart.sources.raw import stamp_load


def read_landing(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", files_at_once: int = 100) -> DataFrame:
    """Stream of the folder's files, each once, some at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).format(kind).load(folder)


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException:
        return like.limit(0)


def _run(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_ingest(stream: DataFrame, target: str, checkpoint: str, now: Column) -> None:
    """Landing rows with their file, load time and state, appended; each batch overwrites its own folder, so a replay changes nothing."""

    def each(batch: DataFrame, number: int) -> None:
        stamp_load(batch, F.col("_file"), now).write.mode("overwrite").parquet(f"{target}/batch={number}")

    _run(stream.withColumn("_file", F.col("_metadata.file_name")), checkpoint, each)


def stream_insert_new(stream: DataFrame, spec: FactSpec, target: str, checkpoint: str) -> None:
    """Rows of new grains only. A batch is compared with the batches before it and overwrites its own folder."""

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stored = _stored(spark, target, batch.withColumn("batch", F.lit(0))).where(F.col("batch") < number).drop("batch")
        load_insert_new(batch, stored, spec).inserted.write.mode("overwrite").parquet(f"{target}/batch={number}")

    _run(stream, checkpoint, each)


BUCKETS = 64
"""Parts of a merged state, by the hash of the grain; a batch rewrites those that it touches."""


def _manifest(spark: SparkSession, target: str, number: int) -> dict[int, int]:
    """bucket -> the version that holds it, after a batch: at most BUCKETS rows."""
    if number < 0:
        return {}
    return {r.bucket: r.version for r in spark.read.schema("bucket int, version long").json(f"{target}/manifest/{number}").collect()}


def _state(spark: SparkSession, target: str, held: dict[int, int], schema: StructType) -> DataFrame:
    """Rows of the buckets (bucket -> version)."""
    paths = [f"{target}/v{version}/bucket={bucket}" for bucket, version in sorted(held.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def stream_merge_latest(stream: DataFrame, spec: FactSpec, target: str, checkpoint: str, buckets: int = BUCKETS) -> None:
    """Latest-wins merge. Batch n writes the buckets that it touches to folder v<n> and then the list of where each bucket is.

    Stored buckets are read from the list of batch n-1, so a replay makes the same again; what neither of the last two
    lists names is removed. The number of buckets of a target stays as it is.
    """
    bucket = F.pmod(F.xxhash64(*spec.grain), F.lit(buckets)).cast("int")

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _manifest(spark, target, number - 1)
        touched = sorted(r.b for r in batch.select(bucket.alias("b")).distinct().collect())
        stored = _state(spark, target, {b: before[b] for b in touched if b in before}, batch.schema)
        merged = load_merge_latest(batch, stored, spec).drop("action").withColumn("bucket", bucket)
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/v{number}")
        now = before | dict.fromkeys(touched, number)
        spark.createDataFrame(sorted(now.items()), "bucket int, version long").coalesce(1).write.mode("overwrite").json(f"{target}/manifest/{number}")
        last = _manifest(spark, target, number - 2) if number > 1 else {}
        for old, version in before.items():
            if last.get(old, version) != version:
                path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/v{last[old]}/bucket={old}")
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    _run(stream, checkpoint, each)


def merged_state(spark: SparkSession, target: str, checkpoint: str, schema: StructType | str) -> DataFrame:
    """The state after the last committed batch."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    listed = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    last = max(int(s.getPath().getName()) for s in listed if s.getPath().getName().isdigit())
    return _state(spark, target, _manifest(spark, target, last), schema)


def stream_daily_rollup(stream: DataFrame, at: str, key: str, value: str, delay: str, target: str, checkpoint: str) -> None:
    """Daily aggregates of a stream, appended once the watermark has passed a day."""
    day = stream.withWatermark(at, delay).groupBy(F.window(at, "1 day"), key)
    rolled = day.agg(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).select(F.to_date("window.start").alias("day"), key, "n", "low", "high")
    rolled.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def event_tail(events: DataFrame, of: Column, id_: str, cursor: int, limit: int) -> DataFrame:
    """The next events after a cursor."""
    return events.where(of & (F.col(id_) > cursor)).orderBy(id_).limit(limit)
