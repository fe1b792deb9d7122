"""The topic log: offsets, consumer groups, and appends that survive replays and crashes."""

import json
from collections import Counter

import pyarrow as pa
import pytest

from shoplens.config import scratch_path
from shoplens.streaming import sinks
from shoplens.streaming import topic_log as L
from shoplens.streaming.sources import topic_stream

ONCE = {"availableNow": True}


def append(spark, base, name, rows, partitions=3, checkpoint="ckpt"):
    """One more file in the input folder, appended by the writer of that checkpoint."""
    spark.createDataFrame(rows, "topic string, value string").coalesce(1).write.mode("append").parquet(f"{base}/{name}")
    raw = spark.readStream.schema("topic string, value string").parquet(f"{base}/{name}")
    L.start_append(raw, f"{base}/log", f"{base}/{checkpoint}", name, partitions=partitions, trigger=ONCE).awaitTermination()


def consume(spark, base, topic, run, group=None, start="earliest"):
    """What one run sees: (partition, offset, value) rows of its batches."""
    seen = []
    q = (L.read_stream(spark, f"{base}/log", topic, group, start).writeStream
         .foreachBatch(lambda df, _: seen.extend((r.partition, r.offset, r.value) for r in df.collect()))
         .option("checkpointLocation", f"{base}/{run}").trigger(**ONCE).start())
    if group:
        L.finish(q, f"{base}/log", group)
    else:
        q.awaitTermination()
    return seen


def rows(topic, a, b):
    return [(topic, f"{topic}-{i}") for i in range(a, b)]


def values(seen):
    return Counter(v for _, _, v in seen)


def test_groups_and_starting_offsets(spark):
    base = scratch_path(spark, "topic_log")
    append(spark, base, "in", rows("a", 0, 50) + rows("b", 0, 5))
    one = consume(spark, base, "a", "run1", "g")
    assert values(one) == Counter(v for _, v in rows("a", 0, 50))
    for p in {p for p, _, _ in one}:  # offsets are dense from 0
        mine = sorted(o for q, o, _ in one if q == p)
        assert mine == list(range(len(mine)))
    append(spark, base, "in", rows("a", 50, 80) + [("a", None), ("a", ""), ("a", "two\nlines")])
    two = consume(spark, base, "a", "run2", "g")  # a new checkpoint: the group's offsets count
    assert values(two) == Counter([v for _, v in rows("a", 50, 80)] + [None, "", "two\nlines"])
    assert consume(spark, base, "a", "run3", "g") == []
    assert len(consume(spark, base, "a", "other", "h")) == 83
    assert consume(spark, base, "a", "late", None, "latest") == []
    both = {(p, o): v for p, o, v in one + two}
    assert len(both) == 83
    start = {str(p): 5 for p in range(3)}
    explicit = consume(spark, base, "a", "explicit", None, json.dumps(start))
    assert {(p, o): v for p, o, v in explicit} == {k: v for k, v in both.items() if k[1] >= 5}
    assert values(consume(spark, base, "b", "b")) == Counter(v for _, v in rows("b", 0, 5))
    assert consume(spark, base, "none", "none") == []


def test_a_checkpoint_goes_on(spark):
    base = scratch_path(spark, "topic_log_ckpt")
    append(spark, base, "in", rows("a", 0, 10))
    assert len(consume(spark, base, "a", "run")) == 10
    append(spark, base, "in", rows("a", 10, 13))
    assert values(consume(spark, base, "a", "run")) == Counter(v for _, v in rows("a", 10, 13))


def batch(topic, partition, messages):
    return pa.RecordBatch.from_pydict({"topic": [topic] * len(messages), "partition": pa.array([partition] * len(messages), pa.int32()),
                                       "value": messages})


def test_repeated_and_lost_attempts_are_not_seen(spark):
    base = scratch_path(spark, "topic_log_crash")
    w = L.TopicLogWriter({"path": f"{base}/log", "writer": "w"})
    w.write(iter([batch("a", 0, ["lost"])]))  # a task whose executor is lost: never committed
    first = w.write(iter([batch("a", 0, ["x", "y"]), batch("a", 1, ["z"])]))
    w.commit([first, None], 0)
    w.commit([w.write(iter([batch("a", 0, ["x", "y"])]))], 0)  # the driver died behind the commit: batch 0 again
    w.commit([w.write(iter([batch("a", 0, ["v"])])), w.write(iter([]))], 1)
    L.TopicLogWriter({"path": f"{base}/log", "writer": "w2"}).commit([w.write(iter([batch("a", 1, ["u"])]))], 0)
    got = sorted(consume(spark, base, "a", "run"))
    assert got == [(0, 0, "x"), (0, 1, "y"), (0, 2, "v"), (1, 0, "z"), (1, 1, "u")]


def test_a_large_partition_is_many_tasks(spark, monkeypatch):
    base = scratch_path(spark, "topic_log_tasks")
    monkeypatch.setattr(L, "FLUSH_ROWS", 100)
    monkeypatch.setattr(L, "TASK_ROWS", 300)
    w = L.TopicLogWriter({"path": f"{base}/log", "writer": "w"})
    w.commit([w.write(iter([batch("a", 0, [str(i) for i in range(1000)])]))], 0)
    reader = L.TopicLogReader({"path": f"{base}/log", "topic": "a", "startingOffsets": "earliest"})
    parts = reader.partitions({"version": 0, "ends": {"0": 150}}, reader.latestOffset())
    assert len(parts) == 3 and max(sum(s["rows"] for s in p.listed) for p in parts) <= 300
    got = [v for p in parts for b in reader.read(p) for v in b.column("value").to_pylist()]
    assert got == [str(i) for i in range(150, 1000)]


def test_a_batch_job_and_its_repeated_batches(spark):
    base = scratch_path(spark, "topic_log_batch")
    df = spark.createDataFrame(rows("a", 0, 20) + rows("b", 0, 3), "topic string, value string")
    for batch_id in (0, 0, 1):
        sinks.write_topics(df, batch_id, "log", path=f"{base}/log")
    assert values(consume(spark, base, "a", "a")) == Counter([v for _, v in rows("a", 0, 20)] * 2)
    got = topic_stream(spark, "b", fmt="log", path=f"{base}/log", starting_offsets="earliest")
    assert got.columns == ["value", "received_ts"]


def test_options_are_required(spark):
    with pytest.raises(KeyError):
        L.TopicLogWriter({"path": "/tmp/x"})
