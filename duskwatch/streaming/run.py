"""Running a streaming frame to the end of what has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep operator state in RocksDB: it spills to disk and stateful processors need it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def drain_to_files(stream: DataFrame, path: str, checkpoint: str, *, mode: str = "append") -> None:
    """Process everything available into parquet files; a restart goes on from the checkpoint."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_batches(stream: DataFrame, on_batch, checkpoint: str, *, mode: str = "append") -> None:
    """Process everything available through a batch function, which must be safe to repeat."""
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landing_files(spark: SparkSession) -> int:
    """Into how many files a landed batch is cut: a quarter of the shuffle partitions, which grow with the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)


def stream_parquet(spark: SparkSession, path: str, *, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
