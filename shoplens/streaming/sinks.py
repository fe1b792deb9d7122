"""Replay-safe sinks.

Every micro-batch is written to its own ``batch_id=N`` folder with overwrite,
so a batch replayed after a failure replaces its own output instead of
duplicating it. Keyed tables are read through a latest-per-key view (last
batch, then version, wins), which gives upsert semantics without a table
format; ``compact`` folds the batches into one snapshot.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from shoplens.operators.dedup import keep_last
from shoplens.streaming import topic_log

#: The jobs' name as writer of a topic log.
WRITER = "job"
BatchFn = Callable[[DataFrame, int], None]


def batch_writer(path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                 transform: Callable[[DataFrame], DataFrame] | None = None,
                 sort_by: list[str] | None = None) -> BatchFn:
    """Write each micro-batch to ``{path}/batch_id=N``. ``sort_by`` orders rows
    within each file so Parquet min/max statistics let filters on those
    columns skip row groups without partitioning every batch by them."""
    def write(df: DataFrame, batch_id: int) -> None:
        out = transform(df) if transform else df
        if sort_by:
            out = out.sortWithinPartitions(*sort_by)
        w = out.write.mode("overwrite").format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(f"{path.rstrip('/')}/batch_id={batch_id}")
    return write


def column_table_writer(path: str, columns: list[str], partition_by: list[str] | None = None,
                        upper: bool = True, sort_by: list[str] | None = None) -> BatchFn:
    """Table write by an explicit column list (names upper-cased like the
    serving tables); a missing column fails the batch."""
    def name(c: str) -> str:
        return c.upper() if upper else c

    def select(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(name(c)) for c in columns])
    parts = [name(p) for p in (partition_by or [])]
    return batch_writer(path, partition_by=parts or None, transform=select,
                        sort_by=[name(c) for c in sort_by] if sort_by else None)


def with_generated_id(id_col: str = "doc_id") -> Callable[[DataFrame], DataFrame]:
    """Append with a generated id; ids stay unique because a replayed batch
    overwrites its own folder."""
    return lambda df: df.withColumn(id_col, F.expr("uuid()"))


def with_doc_id(keys: list[str], id_col: str = "doc_id", trailing: str = "") -> Callable[[DataFrame], DataFrame]:
    """Document id from key columns joined by ':' (e.g. 'order:line:')."""
    return lambda df: df.withColumn(id_col, F.concat(
        F.concat_ws(":", *[F.col(k).cast("string") for k in keys]), F.lit(trailing)))


def read_batches(spark: SparkSession, path: str, fmt: str = "parquet", before: int | None = None) -> DataFrame:
    """All rows with their ``batch_id``. ``before``: only batches below it, which
    is what a batch may look at, so that a replay sees what the first run saw."""
    df = spark.read.format(fmt).load(path)
    return df if before is None else df.where(F.col("batch_id") < before)


def has_batches(spark: SparkSession, path: str, before: int | None = None) -> bool:
    """Whether the folder holds a batch (below ``before``)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/batch_id=*")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    ids = [int(f.getPath().getName().split("=")[1]) for f in found]
    return any(before is None or i < before for i in ids)


def read_latest(spark: SparkSession, path: str, keys: list[str],
                version: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """Latest row per key across batches (upsert view)."""
    df = read_batches(spark, path, fmt)
    return keep_last(df, keys, ["batch_id", *(version or [])]).drop("batch_id")


def compact(spark: SparkSession, path: str, keys: list[str] | None, out: str,
            version: list[str] | None = None, partition_by: list[str] | None = None) -> None:
    """Fold the batch folders into one snapshot: latest row per key (or all
    rows when ``keys`` is None), optionally partitioned (e.g. by day) - the
    periodic job that turns many small per-batch files into a serving table."""
    df = (read_latest(spark, path, keys, version) if keys
          else read_batches(spark, path).drop("batch_id"))
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(out)


def start_foreach(df: DataFrame, fn: BatchFn, checkpoint: str, output_mode: str = "append",
                  trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    w: DataStreamWriter = (df.writeStream.outputMode(output_mode).foreachBatch(fn)
                           .option("checkpointLocation", checkpoint))
    if name:
        # one query per checkpoint, so the name stays unique among active queries
        import zlib
        w = w.queryName(f"{name}-{zlib.crc32(checkpoint.encode()):08x}")
    return w.trigger(**(trigger or {"processingTime": "3 seconds"})).start()


def topic_sink(df: DataFrame, checkpoint: str, fmt: str = "kafka",
               bootstrap_servers: str | None = None, path: str | None = None,
               trigger: dict | None = None) -> StreamingQuery:
    """Write (topic, value) rows: to Kafka (the ``topic`` column picks the
    topic per row), to a topic log (``fmt='log'``; a path has one writer), or as gzipped text
    lines under ``{path}/topic=<t>/``."""
    if fmt == "log":
        if path is None:
            raise ValueError("a topic log needs a path")
        return topic_log.start_append(df, path, checkpoint, WRITER, trigger=trigger)
    out = df.select("topic", F.col("value").cast("string").alias("value"))
    if fmt == "kafka":
        w = out.writeStream.format("kafka")
        if bootstrap_servers:
            w = w.option("kafka.bootstrap.servers", bootstrap_servers)
    else:
        if path is None:
            raise ValueError("a file-backed topic sink needs a path")
        w = out.writeStream.format("text").option("compression", "gzip").partitionBy("topic").option("path", path)
    return (w.option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "3 seconds"})).start())


def write_topics(df: DataFrame, batch_id: int, fmt: str = "kafka", bootstrap_servers: str | None = None,
                 path: str | None = None) -> None:
    """One micro-batch of (topic, value) rows: to Kafka, to a topic log (a repeated batch is left
    out), or as text lines under ``{path}/topic=<t>/batch-N-*`` (a replay replaces the batch's files)."""
    if fmt == "log":
        if path is None:
            raise ValueError("a topic log needs a path")
        return topic_log.append_batch(df, batch_id, path, WRITER)
    out = df.select("topic", F.col("value").cast("string").alias("value"))
    if fmt == "kafka":
        w = out.write.format("kafka")
        if bootstrap_servers:
            w = w.option("kafka.bootstrap.servers", bootstrap_servers)
        w.save()
        return
    if path is None:
        raise ValueError("a file-backed topic sink needs a path")
    for topic in [r[0] for r in out.select("topic").distinct().collect()]:  # two topics
        out.where(F.col("topic") == topic).select("value").write.mode("overwrite").text(
            f"{path.rstrip('/')}/topic={topic}/batch-{batch_id}")
