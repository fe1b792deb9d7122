"""Streaming jobs run to completion over the driver's tables.

Each run writes its messages to a fresh folder under the checkpoint root, dealt
in turn over the files of ``BATCHES`` micro-batches: rows arrive in no order of
time, and every batch but the first meets what earlier ones stored. A micro-batch
has files in proportion to the tables, so no task reads a fixed share of them; what
a finished one has read is deleted.
What the job's reader returns is comparable with the batch twin.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.config import scratch_path, shuffles_dropped, stored_bytes
from shoplens.functions import timeparts
from shoplens.constants import EVENT_LOG_TOPIC, ORDER_INFO_TOPIC
from shoplens.operators import dau as dau_ops
from shoplens.operators import orders as order_ops
from shoplens.plans import registry as R
from shoplens.sources import testdata as td
from shoplens.streaming import jobs, topic_log
from shoplens.streaming.sources import topic_stream

ONCE = {"availableNow": True}
BATCHES = 4
#: Bytes of the tables, as stored, for each file of messages made from them.
FILE_BYTES = 1 << 20


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def files_per_batch(messages: DataFrame, batches: int) -> int:
    """So many files a micro-batch that a file is made from ``FILE_BYTES`` of the tables behind ``messages``."""
    return max(1, -(-stored_bytes(messages) // (batches * FILE_BYTES)))


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files below ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    found, names = fs.listFiles(p, True), []
    while found.hasNext():
        names.append(found.next().getPath().toString())
    return [n for n in names if not n.rsplit("/", 1)[1].startswith(("_", "."))]


def _delete(spark: SparkSession, path: str) -> None:
    """Messages that no later step reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_dealt(messages: DataFrame, path: str, batches: int) -> int:
    """Append ``messages`` to ``path`` in files of about as many rows, equal messages apart too; returns the files of
    a micro-batch. Each task deals its rows over a file of every micro-batch, so none is shuffled; a stream takes files
    in order of their time, which is set to that of their micro-batch."""
    spark, row = messages.sparkSession, F.monotonically_increasing_id()
    tables = messages.inputFiles()
    with shuffles_dropped(spark):
        rows = spark.read.parquet(*tables).count() if tables else 0
    per_file = max(1, -(-rows // (batches * files_per_batch(messages, batches))))
    # of each ``batches`` rows in a row one goes to each micro-batch, in an order of their own
    order = F.pmod(F.xxhash64(F.expr(f"monotonically_increasing_id() div {batches}")), F.lit(batches))
    turn = ((row + order) % batches).cast("int")
    before = set(_files(spark, path))
    # a task writes its files side by side: no sort by ``_turn``
    settings = {"spark.sql.optimizer.plannedWrite.enabled": "false", "spark.sql.maxConcurrentOutputFileWriters": str(batches)}
    held = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        with shuffles_dropped(spark):
            messages.withColumn("_turn", turn).write.mode("append").option("compression", "zstd").option(
                "maxRecordsPerFile", per_file).partitionBy("_turn").parquet(path)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    new = [f for f in _files(spark, path) if f not in before]
    now, jvm = int(time.time() * 1000), spark.sparkContext._jvm
    for f in new:
        p = jvm.org.apache.hadoop.fs.Path(f)
        at = now - 1000 * (batches - int(f.split("/_turn=")[1].split("/")[0]))
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).setTimes(p, at, -1)
    return max(1, -(-len(new) // batches))


def message_stream(spark: SparkSession, schema, path: str, per: int) -> DataFrame:
    """What ``write_dealt`` wrote, ``per`` files a micro-batch; a file goes when its micro-batch is done."""
    return (spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", str(per))
            .option("cleanSource", "delete").parquet(path))


def dealt_stream(messages: DataFrame, path: str, batches: int = BATCHES) -> DataFrame:
    """``messages`` as a stream of ``batches`` micro-batches."""
    per = write_dealt(messages, path, batches)
    return message_stream(messages.sparkSession, messages.schema, path, per)


def _topic(spark: SparkSession, topic: str, path: str) -> DataFrame:
    """A topic of files in ``BATCHES`` micro-batches; where they are few, four files are one."""
    per = max(BATCHES, -(-len(_files(spark, f"{path}/topic={topic}")) // BATCHES))
    return topic_stream(spark, topic, fmt="files", path=path, options={"maxFilesPerTrigger": str(per)})


def _dau(spark: SparkSession, sf: str, name: str) -> DataFrame:
    base = scratch_path(spark, name)
    raw = dealt_stream(td.startup_messages(spark, sf), f"{base}/in")
    _run(jobs.start_dau(raw, f"{base}/out", f"{base}/ckpt", ONCE, keep="earliest"))
    return jobs.read_dau(spark, f"{base}/out")


def stream_dau(spark: SparkSession, sf: str) -> DataFrame:
    return _dau(spark, sf, "stream_dau")


def stream_dau_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return dau_ops.dau_by_hour(_dau(spark, sf, "stream_dau_hourly"))


def _orders(spark: SparkSession, feed: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
    """Change feed -> router -> order_info topic -> bind, mask -> order table (``columns`` of it)."""
    base = scratch_path(spark, name)
    stream = dealt_stream(feed, f"{base}/feed")
    _run(jobs.start_change_router(stream, f"{base}/ckpt-route", fmt="files", path=f"{base}/topics", trigger=ONCE))
    _delete(spark, f"{base}/feed")
    raw_orders = _topic(spark, ORDER_INFO_TOPIC, f"{base}/topics")
    _run(jobs.start_orders(raw_orders, f"{base}/orders", f"{base}/rejects", f"{base}/ckpt-orders", ONCE))
    return jobs.read_orders(spark, f"{base}/orders", columns=columns)


def stream_order_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, td.change_feed(spark, sf), "stream_orders")


def stream_order_redelivery(spark: SparkSession, sf: str) -> DataFrame:
    """Every message delivered twice; the amounts count each order once."""
    feed = td.change_feed(spark, sf)
    return order_ops.amount_by_date(_orders(spark, feed.unionByName(feed), "stream_redelivery", ["create_date", "total_amount"]))


_ALERT_COLUMNS = ["mid", "window_start", "window_end", "coupon_accounts", "n_events"]


def _alerts(spark: SparkSession, raw: DataFrame, base: str) -> str:
    _run(jobs.start_alerts(raw, f"{base}/out", f"{base}/ckpt", R.ALERT_LENGTH, R.ALERT_SLIDE, R.ALERT_MIN_ACCOUNTS,
                           R.ALERT_THROTTLE, ONCE))
    return f"{base}/out"


def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "stream_alerts")
    out = _alerts(spark, dealt_stream(td.event_messages(spark, sf), f"{base}/in"), base)
    return jobs.read_alerts(spark, out).select(*_ALERT_COLUMNS)


def stream_alerts_throttled(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "stream_alerts_throttled")
    out = _alerts(spark, dealt_stream(td.event_messages(spark, sf), f"{base}/in"), base)
    return jobs.read_throttled_alerts(spark, out).select("doc_id", *_ALERT_COLUMNS)


def stream_alerts_from_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Raw log lines -> collector -> event topic -> bind -> alerts."""
    base = scratch_path(spark, "stream_alerts_logs")
    logs = td.raw_logs(spark, sf).select("value", "received_ts")
    raw = dealt_stream(logs, f"{base}/in")
    _run(jobs.start_log_collector(raw, f"{base}/ckpt-logs", f"{base}/archive", fmt="files", path=f"{base}/topics", trigger=ONCE))
    events = _topic(spark, EVENT_LOG_TOPIC, f"{base}/topics")
    return jobs.read_alerts(spark, _alerts(spark, events, base)).select(*_ALERT_COLUMNS)


def stream_log_archive(spark: SparkSession, sf: str) -> DataFrame:
    """What the collector archives by day, line by line."""
    base = scratch_path(spark, "stream_log_archive")
    raw = dealt_stream(td.raw_logs(spark, sf).select("value", "received_ts"), f"{base}/in")
    _run(jobs.start_log_collector(raw, f"{base}/ckpt", f"{base}/archive", fmt="files", path=f"{base}/topics", trigger=ONCE))
    lines = spark.read.option("basePath", f"{base}/archive").text(f"{base}/archive")
    return lines.select(F.col("dt").cast("string").alias("dt"), F.from_json("value", "logType string, mid string, ts long").alias("j")).select("dt", "j.*")


def stream_consumer_group(spark: SparkSession, sf: str) -> DataFrame:
    """Collector -> topic log -> two runs of one consumer group. The second run has a checkpoint of its
    own and begins at the offsets the group committed; each event log comes with the run that read it."""
    base = scratch_path(spark, "stream_group")
    raw = td.raw_logs(spark, sf).select("value", "received_ts")
    turn_of = F.pmod(F.expr("received_ts div 1000"), F.lit(2))
    for turn in (0, 1):
        per = write_dealt(raw.where(turn_of == turn), f"{base}/in", 2)
        lines = message_stream(spark, raw.schema, f"{base}/in", per)
        _run(jobs.start_log_collector(lines, f"{base}/ckpt-logs", f"{base}/archive", fmt="log", path=f"{base}/log", trigger=ONCE))
        events = topic_stream(spark, EVENT_LOG_TOPIC, fmt="log", path=f"{base}/log", group_id="alerts", starting_offsets="earliest")
        query = (events.select("value").writeStream.format("parquet").option("path", f"{base}/out/run={turn + 1}")
                 .option("checkpointLocation", f"{base}/ckpt-{turn}").trigger(**ONCE).start())
        topic_log.finish(query, f"{base}/log", "alerts")
    runs = [spark.read.parquet(f"{base}/out/run={turn}").withColumn("run", F.lit(turn)) for turn in (1, 2)]
    return runs[0].unionByName(runs[1]).select("run", F.from_json("value", "logType string, mid string, ts long").alias("j")).select("run", "j.*")


def stream_dau_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Actives by hour as the job keeps them: earlier startups that come late move devices to their hour."""
    base = scratch_path(spark, "stream_dau_counts")
    raw = dealt_stream(td.startup_messages(spark, sf), f"{base}/in")
    _run(jobs.start_dau(raw, f"{base}/out", f"{base}/ckpt", ONCE, keep="earliest", counts=True))
    return jobs.dau_counts(spark, f"{base}/out")


def stream_order_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts by hour as the job keeps them. Each order comes three times, in any order: with an amount
    that is wrong, corrected, and the correction again."""
    base = scratch_path(spark, "stream_order_counts")
    last = td.order_messages(spark, sf)
    draft = last.withColumn("value", F.regexp_replace("value", '"total_amount":"?[^,"}]*"?', '"total_amount":"7.00"'))
    fixed = last.withColumn("value", F.concat(F.lit('{"operate_time":"9999",'), F.substring("value", 2, 1 << 20)))
    again = fixed.withColumn("received_ts", F.col("received_ts") + 1)
    raw = dealt_stream(draft.unionByName(fixed).unionByName(again), f"{base}/in")
    _run(jobs.start_orders(raw, f"{base}/out", f"{base}/rejects", f"{base}/ckpt", ONCE, counts=True))
    return jobs.order_counts(spark, f"{base}/out")


def stream_sale_wide(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "stream_sales")
    messages = jobs.order_and_detail_messages(td.order_messages(spark, sf), td.detail_messages(spark, sf))
    raw = dealt_stream(messages, f"{base}/in")
    lookup = jobs.dimension_lookup(lambda: td.user_info(spark, sf))
    _run(jobs.start_sales(raw, f"{base}/out", f"{base}/ckpt", lookup, R.AS_OF, bound=R.JOIN_BOUND, trigger=ONCE))
    return jobs.read_sales(spark, f"{base}/out").select(*[f.name for f in schemas.SALE_DETAIL.fields])


def stream_sale_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Users change while sales run: by turns the changes and the sales of a span of time are delivered,
    and each sale takes the user's row of its order's time."""
    base = scratch_path(spark, "stream_sale_as_of")
    versions = td.user_versions(spark, sf).withColumn("birthday", F.col("birthday").cast("string"))
    orders, details = td.order_messages(spark, sf), td.detail_messages(spark, sf)
    messages = jobs.order_and_detail_messages(orders, details)
    cut = R.USERS_CUT
    at = F.lit(cut).cast("timestamp_ntz")
    early = F.col("received_ts") < timeparts.ntz_to_epoch_millis(at)
    lookup = jobs.version_lookup(spark, f"{base}/users")
    for turn in (0, 1):
        (versions.where(F.col("valid_from") < at) if not turn else versions.where(F.col("valid_from") >= at)).write.mode("append").parquet(f"{base}/changes")
        changes = spark.readStream.schema(versions.schema).parquet(f"{base}/changes")
        _run(jobs.start_users(changes, f"{base}/users", f"{base}/ckpt-users", ONCE))
        # one micro-batch: of sales with the same ids in one batch the largest stands, else the last to come
        per = write_dealt(messages.where(~early if turn else early), f"{base}/in", 1)
        raw = message_stream(spark, messages.schema, f"{base}/in", per)
        _run(jobs.start_sales(raw, f"{base}/out", f"{base}/ckpt", lookup, R.AS_OF, bound=R.JOIN_BOUND, trigger=ONCE))
    return jobs.read_sales(spark, f"{base}/out")


STREAM_QUERIES = {
    "stream_sale_as_of": stream_sale_as_of,
    "stream_log_archive": stream_log_archive,
    "stream_consumer_group": stream_consumer_group,
    "stream_dau": stream_dau,
    "stream_dau_hourly": stream_dau_hourly,
    "stream_dau_counts": stream_dau_counts,
    "stream_order_counts": stream_order_counts,
    "stream_alerts": stream_alerts,
    "stream_alerts_throttled": stream_alerts_throttled,
    "stream_alerts_from_logs": stream_alerts_from_logs,
    "stream_sale_wide": stream_sale_wide,
    "stream_order_ingest": stream_order_ingest,
    "stream_order_redelivery": stream_order_redelivery,
}
