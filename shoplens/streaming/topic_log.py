"""A topic log in shared storage: partitions, offsets, consumer groups, replay-safe appends.

Format "topic_log" for ``readStream`` and ``writeStream``. A folder holds Parquet segments and a
log of commits. Tasks write segments under names of their own; one commit file a micro-batch lists
them with (topic, partition, first offset, rows), so what a lost or repeated attempt wrote
is never seen, and a batch that is committed again is left out. Messages keep the order of their
key, whose hash picks the partition.

A reader starts at the committed offsets of its consumer group, or, where the group has none, at
``startingOffsets``: "earliest", "latest", or JSON {partition: offset}, missing partitions from 0. The
group's offsets are stored when Spark starts the micro-batch after a finished one, those of
a stopped query's last one by ``finish``; a group delivers at least once, and one query
at a time reads for it. A query that has a checkpoint goes on from there, like any stream. Offsets and listings that reach the driver are
one entry a partition and a segment, never messages. A folder has one writer at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage)
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "topic string, partition int, offset long, value string, received_ts long"
#: Rows a task holds before it writes them as row groups, and rows a reading task takes.
FLUSH_ROWS, TASK_ROWS = 65_536, 1_000_000


class _Folder:
    """The commits and group offsets below a path. Files are put in place by one rename."""

    def __init__(self, path: str):
        self.fs, self.root = fs.FileSystem.from_uri(path)  # "/x", "file:/x", "hdfs://..."

    def put(self, name: str, content: dict) -> None:
        folder = f"{self.root}/{name}".rpartition("/")[0]
        self.fs.create_dir(folder, recursive=True)
        temp = f"{folder}/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(temp) as f:
            f.write(json.dumps(content).encode())
        self.fs.move(temp, f"{self.root}/{name}")

    def get(self, name: str) -> dict | None:
        path = f"{self.root}/{name}"
        if self.fs.get_file_info(path).type == fs.FileType.NotFound:
            return None
        with self.fs.open_input_stream(path) as f:
            return json.loads(f.read())

    def version(self) -> int:
        """The newest commit, 0 where there is none."""
        found = self.fs.get_file_info(fs.FileSelector(f"{self.root}/commits", allow_not_found=True))
        return max((int(i.base_name[:-5]) for i in found if i.base_name.endswith(".json") and i.base_name[:1] != "."), default=0)

    def commit(self, version: int) -> dict:
        if not version:
            return {"ends": {}, "writers": {}, "segments": []}
        return self.get(f"commits/{version:020d}.json")


@dataclass
class Segments(WriterCommitMessage):
    listed: list


class TopicLogWriter(DataSourceStreamArrowWriter):
    """Rows (topic, partition, value). Option ``writer`` names the writer, whose batch numbers tell a
    repeated commit from a new one."""

    def __init__(self, options: dict):
        self.path, self.writer = options["path"], options["writer"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Segments:
        folder = _Folder(self.path)
        folder.fs.create_dir(f"{folder.root}/segments", recursive=True)
        name, listed, held, out = f"segments/{uuid.uuid4().hex}.parquet", [], [], None
        schema = pa.schema([("value", pa.string())])

        def flush():
            rows = pa.Table.from_batches(held)
            for key in rows.group_by(["topic", "partition"]).aggregate([]).to_pylist():
                mine = rows.filter((pa.compute.field("topic") == key["topic"]) & (pa.compute.field("partition") == key["partition"]))
                out.write_table(mine.select(["value"]).cast(schema), row_group_size=FLUSH_ROWS * 2)
                listed.append({"topic": key["topic"], "partition": key["partition"], "rows": mine.num_rows, "file": name,
                               "group": len(listed), "ts": time.time_ns() // 1_000_000})
            held.clear()

        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                out = out or pq.ParquetWriter(f"{folder.root}/{name}", schema, filesystem=folder.fs)
                for at in range(0, batch.num_rows, FLUSH_ROWS):
                    held.append(batch.slice(at, FLUSH_ROWS))
                    if sum(b.num_rows for b in held) >= FLUSH_ROWS:
                        flush()
            if held:
                flush()
        finally:
            if out is not None:
                out.close()
        return Segments(listed)

    def commit(self, messages, batchId: int) -> None:  # noqa: N803
        folder = _Folder(self.path)
        version = folder.version()
        last = folder.commit(version)
        if last["writers"].get(self.writer, -1) >= batchId:
            return self.abort(messages, batchId)  # a repeated batch: its messages are in the log
        ends, segments = dict(last["ends"]), []
        for s in (s for m in messages if m is not None for s in m.listed):
            key = f"{s['topic']}/{s['partition']}"
            segments.append({**s, "first": ends.get(key, 0)})
            ends[key] = ends.get(key, 0) + s["rows"]
        folder.put(f"commits/{version + 1:020d}.json",
                   {"ends": ends, "writers": {**last["writers"], self.writer: batchId}, "segments": segments})

    def abort(self, messages, batchId: int) -> None:  # noqa: N803
        folder = _Folder(self.path)
        for name in {s["file"] for m in messages if m is not None for s in m.listed}:
            if folder.fs.get_file_info(f"{folder.root}/{name}").type != fs.FileType.NotFound:
                folder.fs.delete_file(f"{folder.root}/{name}")


@dataclass
class Pieces(InputPartition):
    listed: list


class TopicLogReader(DataSourceStreamReader):
    """Options: path, topic, group (none: offsets are not stored), startingOffsets."""

    def __init__(self, options: dict):
        self.path, self.topic = options["path"], options["topic"]
        self.group, self.start = options.get("group"), options.get("startingoffsets", options.get("startingOffsets", "latest"))

    def _ends(self, version: int) -> dict:
        ends = _Folder(self.path).commit(version)["ends"]
        return {k.rpartition("/")[2]: n for k, n in ends.items() if k.rpartition("/")[0] == self.topic}

    def _group_file(self) -> str:
        return f"groups/{self.group}/{self.topic}.json"

    def initialOffset(self) -> dict:
        stored = _Folder(self.path).get(self._group_file()) if self.group else None
        if stored is not None:
            return stored
        if self.start == "latest":
            return self.latestOffset()
        # version 0: all commits are looked through for what lies behind the offsets
        return {"topic": self.topic, "version": 0, "ends": {} if self.start == "earliest" else {str(k): int(n) for k, n in json.loads(self.start).items()}}

    def latestOffset(self) -> dict:
        version = _Folder(self.path).version()
        return {"topic": self.topic, "version": version, "ends": self._ends(version)}

    def partitions(self, start: dict, end: dict) -> list[Pieces]:
        folder, parts, have = _Folder(self.path), [], TASK_ROWS
        for version in range(start["version"] + 1, end["version"] + 1):
            for s in folder.commit(version)["segments"]:
                begin = max(s["first"], start["ends"].get(str(s["partition"]), 0))
                rows = s["first"] + s["rows"] - begin
                if s["topic"] != self.topic or rows <= 0:
                    continue
                if have + rows > TASK_ROWS:
                    parts.append(Pieces([]))
                    have = 0
                parts[-1].listed.append({**s, "begin": begin})
                have += rows
        return parts or [Pieces([])]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        folder = _Folder(self.path)
        for s in partition.listed:
            with folder.fs.open_input_file(f"{folder.root}/{s['file']}") as f:
                at = s["first"]
                for batch in pq.ParquetFile(f).iter_batches(row_groups=[s["group"]], batch_size=10_000):
                    skip, at = max(0, s["begin"] - at), at + batch.num_rows
                    batch = batch.slice(skip)
                    n = batch.num_rows
                    if n:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([self.topic] * n, pa.string()), pa.array([s["partition"]] * n, pa.int32()),
                             pa.array(range(at - n, at), pa.int64()), batch.column(0), pa.array([s["ts"]] * n, pa.int64())],
                            names=["topic", "partition", "offset", "value", "received_ts"])

    def commit(self, end: dict) -> None:
        if self.group:
            _Folder(self.path).put(self._group_file(), end)

    def stop(self) -> None:
        pass


class TopicLogBatchWriter(DataSourceArrowWriter):
    """The same append from ``foreachBatch``; option ``batch`` is the micro-batch's number."""

    def __init__(self, options: dict):
        self.inner, self.batch = TopicLogWriter(options), int(options["batch"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Segments:
        return self.inner.write(iterator)

    def commit(self, messages) -> None:
        self.inner.commit(messages, self.batch)

    def abort(self, messages) -> None:
        self.inner.abort(messages, self.batch)


class TopicLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TopicLogReader:  # noqa: N802
        return TopicLogReader(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> TopicLogWriter:  # noqa: N802
        return TopicLogWriter(dict(self.options))

    def writer(self, schema, overwrite: bool) -> TopicLogBatchWriter:
        return TopicLogBatchWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    import sys
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not hold the package
    spark.dataSource.register(TopicLogSource)


def read_stream(spark: SparkSession, path: str, topic: str, group: str | None = None, starting_offsets: str = "latest") -> DataFrame:
    """(topic, partition, offset, value, received_ts) of one topic; the last is the time of writing."""
    register(spark)
    reader = spark.readStream.format("topic_log").option("path", path).option("topic", topic).option("startingOffsets", starting_offsets)
    return (reader.option("group", group) if group else reader).load()


def _dealt(df: DataFrame, key: Column | None, partitions: int) -> DataFrame:
    register(df.sparkSession)
    part = F.pmod(F.xxhash64(F.col("value") if key is None else key), F.lit(partitions)).cast("int")
    return df.select(F.col("topic").cast("string").alias("topic"), part.alias("partition"), F.col("value").cast("string").alias("value"))


def start_append(df: DataFrame, path: str, checkpoint: str, writer: str, key: Column | None = None, partitions: int = 8,
                 trigger: dict | None = None) -> StreamingQuery:
    """Appends a stream of (topic, value); ``key`` (the value, if none is given) picks the partition."""
    return (_dealt(df, key, partitions).writeStream.format("topic_log").option("path", path).option("writer", writer)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "3 seconds"})).start())


def append_batch(df: DataFrame, batch_id: int, path: str, writer: str, key: Column | None = None, partitions: int = 8) -> None:
    """Appends one micro-batch of (topic, value) from ``foreachBatch``; a repeated batch is left out."""
    (_dealt(df, key, partitions).write.format("topic_log").mode("append").option("path", path).option("writer", writer)
     .option("batch", str(batch_id)).save())


def finish(query: StreamingQuery, path: str, group: str) -> None:
    """Waits for a query that reads topics for a group to end, and stores the offsets of its last finished batch."""
    query.awaitTermination()
    ends = {}
    for progress in query.recentProgress:
        for source in json.loads(progress.json)["sources"]:
            if isinstance(source["endOffset"], dict) and "topic" in source["endOffset"]:
                ends[source["endOffset"]["topic"]] = source["endOffset"]
    for topic, end in ends.items():
        TopicLogReader({"path": path, "topic": topic, "group": group}).commit(end)
