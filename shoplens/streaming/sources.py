"""Streaming sources: topics (Kafka, or a folder per topic under test) and
driver tables read as file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.streaming import topic_log


def topic_stream(spark: SparkSession, topic: str, fmt: str = "kafka",
                 bootstrap_servers: str | None = None, group_id: str | None = None,
                 starting_offsets: str = "latest", path: str | None = None,
                 options: dict[str, str] | None = None) -> DataFrame:
    """Message values of one topic as ``value`` (string) plus ``received_ts``.

    ``fmt='kafka'`` subscribes to the topic; offsets live in the query's
    checkpoint, ``group_id`` names the consumer group, ``starting_offsets``
    applies to the first run only. ``fmt='log'`` reads the topic log at ``path``
    (``topic_log``), with the same meaning of group and offsets. Any other ``fmt``
    reads text lines from ``{path}/topic={topic}`` (the layout ``sinks.topic_sink`` writes).
    """
    opts = dict(options or {})
    if fmt == "log":
        if path is None:
            raise ValueError("a topic log needs a path")
        return topic_log.read_stream(spark, path, topic, group_id, starting_offsets).select("value", "received_ts")
    if fmt == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("subscribe", topic)
                  .option("startingOffsets", starting_offsets))
        if bootstrap_servers:
            reader = reader.option("kafka.bootstrap.servers", bootstrap_servers)
        if group_id:
            reader = reader.option("kafka.group.id", group_id)
        for k, v in opts.items():
            reader = reader.option(k, v)
        return reader.load().select(F.col("value").cast("string").alias("value"),
                                    F.unix_millis(F.col("timestamp")).alias("received_ts"))
    if path is None:
        raise ValueError("a file-backed topic needs a path")
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.load(f"{path.rstrip('/')}/topic={topic}").select(
        "value", F.unix_millis(F.current_timestamp()).alias("received_ts"))


def table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A driver table (``{folder}/{name}.parquet``) as a file stream; new
    files named like it are picked up as they arrive."""
    if schema is None:
        schema = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(folder)
