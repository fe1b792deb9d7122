"""Collector -> topic -> parse -> DAU stream -> serving table -> report."""

import tempfile

from pyspark.sql import functions as F

from parity import rows_of
from shoplens.plans import registry as R
from shoplens.plans import reports
from shoplens.sources import testdata as td
from shoplens.sources.tables import read_serving_table
from shoplens.streaming import jobs
from shoplens.streaming.sources import topic_stream

SF = "/root/testdata/sf0.01"
ONCE = {"availableNow": True}


def _run(q):
    q.awaitTermination()
    assert q.exception() is None, q.exception()


def test_logs_to_hourly_report(spark):
    base = tempfile.mkdtemp(prefix="e2e-")
    raw = td.raw_logs(spark, SF).select("value", "received_ts", "event_id")
    # the logs arrive as three files, newest first, read one per micro-batch:
    # the earliest startup must still win whatever the arrival order
    days = raw.withColumn("_d", F.date_format(F.timestamp_millis("received_ts"), "yyyy-MM-dd"))
    for lo, hi in [("2024-01-21", "2024-02-01"), ("2024-01-11", "2024-01-21"), ("2024-01-01", "2024-01-11")]:
        part = days.where((F.col("_d") >= lo) & (F.col("_d") < hi)).drop("_d")
        part.coalesce(1).write.mode("append").parquet(f"{base}/raw")
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", "1").parquet(f"{base}/raw")
    _run(jobs.start_log_collector(stream, f"{base}/ckpt-collect", f"{base}/archive",
                                  fmt="files", path=f"{base}/topics", trigger=ONCE))

    startup_raw = topic_stream(spark, "startup_log_topic", fmt="files", path=f"{base}/topics",
                               options={"maxFilesPerTrigger": "1"})
    _run(jobs.start_dau(startup_raw, f"{base}/dau", f"{base}/ckpt-dau", ONCE, keep="earliest"))
    dau_path = f"{base}/dau-table"
    jobs.read_dau(spark, f"{base}/dau").write.partitionBy("log_date").parquet(dau_path)

    day = R.DAU_DATE
    served = read_serving_table(spark, dau_path, "log_date", [day, "2024-01-14"])
    got = reports.realtime_hour("dau", served.withColumn("log_date", F.col("log_date").cast("string")), day)
    want = R.QUERIES["hourly_compare_dau"](spark, SF)
    cols = ["hour", "today", "yesterday"]
    assert rows_of(cols, [tuple(r) for r in got.select(*cols).collect()]) == \
        rows_of(cols, [tuple(r) for r in want.select(*cols).collect()])
    assert spark.read.parquet(dau_path).count() == 4006
    assert spark.read.parquet(f"{base}/dau").select("batch_id").distinct().count() >= 2
