"""Stream = batch over several time-ordered micro-batches, with a restart."""

import tempfile

import pytest
from pyspark.sql import functions as F

from parity import rows_of
from shoplens import schemas
from shoplens.functions import parse
from shoplens.operators import alerts, sales
from shoplens.sources import testdata as td
from shoplens.streaming import jobs, sinks

SF = "/root/testdata/sf0.01"
ONCE = {"availableNow": True}


def _run(q):
    q.awaitTermination()
    assert q.exception() is None, q.exception()


def _alert_rows(df):
    cols = ["mid", "window_start", "window_end", "coupon_accounts", "n_events"]
    out = df.select(*cols)
    return rows_of(cols, [tuple(r) for r in out.collect()])


def _dealt(spark, messages, path, files, start=0):
    """Messages dealt by hash over files, in no order of time; from ``start`` on."""
    part = F.pmod(F.xxhash64("value"), F.lit(files))
    for i in range(start, files):
        messages.where(part == i).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(path)


def test_alert_stream_equals_batch_with_restart(spark):
    out = tempfile.mkdtemp(prefix="ev-out-")
    messages = td.event_messages(spark, SF)
    part = F.pmod(F.xxhash64("value"), F.lit(4))

    def start():
        return jobs.start_alerts(_stream(spark, f"{out}/in", messages.schema), f"{out}/data", f"{out}/ckpt",
                                 "6 hours", "1 hour", 3, "1 day", ONCE)

    messages.where(part < 2).repartition(2).write.parquet(f"{out}/in")
    _run(start())
    messages.where(part >= 2).repartition(2).write.mode("append").parquet(f"{out}/in")
    _run(start())   # more data arrives; restart from checkpoint
    streamed = jobs.read_alerts(spark, f"{out}/data")
    batch = alerts.coupon_alerts(alerts.pane_table(td.event_log(spark, SF), "1 hour"), "6 hours", "1 hour", 3)
    assert _alert_rows(streamed) == _alert_rows(batch)
    assert streamed.count() == 152


def test_replayed_batch_changes_nothing(spark):
    """A batch run again (as after a failure) sees what it saw the first time."""
    out = tempfile.mkdtemp(prefix="replay-")
    messages = td.startup_messages(spark, "/root/testdata/sf0.001")
    messages.repartition(3).write.parquet(f"{out}/in")

    def start():
        return jobs.start_dau(_stream(spark, f"{out}/in", messages.schema), f"{out}/data", f"{out}/ckpt", ONCE, keep="earliest")

    _run(start())
    first = rows_of(["mid", "ts"], [tuple(r) for r in jobs.read_dau(spark, f"{out}/data").select("mid", "ts").collect()])
    import os
    last = max(int(f) for f in os.listdir(f"{out}/ckpt/commits") if f.isdigit())
    os.remove(f"{out}/ckpt/commits/{last}")
    crc = f"{out}/ckpt/commits/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    _run(start())
    again = rows_of(["mid", "ts"], [tuple(r) for r in jobs.read_dau(spark, f"{out}/data").select("mid", "ts").collect()])
    assert first == again


def test_dau_keeps_first_arrivals_and_writes_eleven_columns(spark):
    out = tempfile.mkdtemp(prefix="dau-out-")
    messages = td.startup_messages(spark, SF)
    _dealt(spark, messages, f"{out}/in", 4)
    bad = spark.createDataFrame([("{broken", 0), ('{"mid":"m"}', 0)], messages.schema)
    bad.coalesce(1).write.mode("append").parquet(f"{out}/in")
    _run(jobs.start_dau(_stream(spark, f"{out}/in", messages.schema), f"{out}/data", f"{out}/ckpt", ONCE))
    got = spark.read.parquet(f"{out}/data")
    assert sorted(set(got.columns) - {"batch_id"}) == sorted(c.upper() for c in schemas.DAU_TABLE)
    assert got.count() == got.select("LOG_DATE", "MID").distinct().count() == 4006
    assert spark.read.parquet(f"{out}/data_rejects").count() == 2


def _sale_messages(spark):
    return jobs.order_and_detail_messages(td.order_messages(spark, SF), td.detail_messages(spark, SF))


def test_sale_stream_equals_batch(spark):
    out = tempfile.mkdtemp(prefix="sale-out-")
    messages = _sale_messages(spark)
    _dealt(spark, messages, f"{out}/in", 4)
    lookup = jobs.dimension_lookup(lambda: td.user_info(spark, SF))
    _run(jobs.start_sales(_stream(spark, f"{out}/in", messages.schema), f"{out}/data", f"{out}/ckpt", lookup, "2020-08-25",
                          bound="30 days", trigger=ONCE))
    streamed = jobs.read_sales(spark, f"{out}/data")
    batch = sales.sale_wide(parse.ingest_orders(td.raw_order_info(spark, SF)), td.order_detail(spark, SF),
                            td.user_info(spark, SF), "2020-08-25", bound="30 days")
    cols = batch.columns
    s_rows = rows_of(cols, [tuple(r) for r in streamed.select(*cols).collect()])
    assert s_rows == rows_of(cols, [tuple(r) for r in batch.collect()])
    assert len(s_rows) == 1450


def test_user_who_appears_later_is_found(spark):
    """The dimension is read for each batch; a pair whose user is unknown waits."""
    out = tempfile.mkdtemp(prefix="fresh-")
    order = ('{"id":"%s","consignee":"Wang","total_amount":"9.90","create_time":"2020-08-19 00:08:13","user_id":"%s"}')
    line = '{"id":"%s","order_id":"%s","order_price":"4.50","sku_name":"x"}'
    schema = "kind string, value string, received_ts long"
    users = [("7", "u7", "1", "1990-01-01", "M")]
    fields = "id string, login_name string, user_level string, birthday string, gender string"
    lookup = jobs.dimension_lookup(lambda: parse.typed_users(spark.createDataFrame(users, fields)))

    def deliver(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{out}/in")
        _run(jobs.start_sales(_stream(spark, f"{out}/in", schema), f"{out}/data", f"{out}/ckpt", lookup, trigger=ONCE))
        return sorted((r.order_id, r.user_gender) for r in jobs.read_sales(spark, f"{out}/data").collect())

    minute = 60_000
    assert deliver([("order", order % (1, 7), 0), ("detail", line % (1, 1), minute), ("order", order % (2, 8), 0),
                    ("detail", line % (2, 2), minute), ("detail", line % (3, 3), minute)]) == [("1", "M")]
    users.append(("8", "u8", "1", "not-a-date", "F"))
    assert deliver([("order", order % (3, 8), 2 * minute), ("detail", line % (4, 1), 100 * minute),
                    ("detail", '{"id":"9","order_id":"1","order_price":"cheap"}', 0)]) == [("1", "M"), ("2", "F"), ("3", "F")]
    assert spark.read.parquet(f"{out}/data/rejects").count() == 1


def test_hot_device_and_order(spark):
    """A third of the rows under one key: one row a task and batch for the device; the order's
    pairs are all found."""
    out = tempfile.mkdtemp(prefix="hot-")
    n = 9000
    startups = spark.range(n).select(F.to_json(F.struct(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("mid"),
        (F.col("id") * 1000).alias("ts"))).alias("value"), F.col("id").alias("received_ts"))
    _dealt(spark, startups, f"{out}/in", 3)
    _run(jobs.start_dau(_stream(spark, f"{out}/in", startups.schema), f"{out}/dau", f"{out}/ckpt", ONCE))
    assert jobs.read_dau(spark, f"{out}/dau").count() == n - n // 3 + 1


def test_keyed_sink_replay_is_idempotent(spark):
    out = tempfile.mkdtemp(prefix="keyed-")
    w = sinks.batch_writer(out)
    df1 = spark.createDataFrame([("k1", 1), ("k2", 1)], "k string, v int")
    df2 = spark.createDataFrame([("k1", 2)], "k string, v int")
    w(df1, 0)
    w(df2, 1)
    w(df2, 1)          # replayed batch overwrites its own folder
    latest = {r.k: r.v for r in sinks.read_latest(spark, out, ["k"]).collect()}
    assert latest == {"k1": 2, "k2": 1}
    assert sinks.read_batches(spark, out).count() == 3


def test_lookup_by_ids(spark):
    from shoplens.sources.tables import lookup_by_ids
    ids = spark.createDataFrame([("1",), ("1",), ("999999",)], "user_id string")
    assert lookup_by_ids(td.user_info(spark, SF), ids).count() == 1


def test_serving_table_partition_pruning(spark):
    from shoplens.operators import dau as dau_ops
    from shoplens.sources.tables import read_serving_table
    out = tempfile.mkdtemp(prefix="dau-table-")
    dau = dau_ops.daily_actives(td.startup_log(spark, SF))
    dau.write.mode("overwrite").partitionBy("log_date").parquet(out)
    one = read_serving_table(spark, out, "log_date", ["2024-01-15"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan
    assert one.count() == dau.where("log_date = '2024-01-15'").count()


def test_change_router_stream_equals_batch(spark):
    from shoplens import schemas
    from shoplens.operators import routing
    src = tempfile.mkdtemp(prefix="cdc-src-")
    out = tempfile.mkdtemp(prefix="cdc-out-")
    small = "/root/testdata/sf0.001"
    feed = td.change_feed(spark, small)
    feed.write.mode("overwrite").json(f"{src}/feed")
    stream = spark.readStream.schema(schemas.CHANGE_ENTRY).json(f"{src}/feed")
    _run(jobs.start_change_router(stream, f"{out}/ckpt", fmt="files", path=f"{out}/topics", trigger=ONCE))
    got = spark.read.text(f"{out}/topics").select("topic", "value")
    want = routing.route_changes(feed).select("topic", "value")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_log_collector_routes_and_archives(spark):
    out = tempfile.mkdtemp(prefix="logs-")
    src = tempfile.mkdtemp(prefix="logs-src-")
    raw = td.raw_logs(spark, "/root/testdata/sf0.001").select("value", "received_ts")
    raw.write.mode("overwrite").parquet(f"{src}/raw")
    stream = spark.readStream.schema(raw.schema).parquet(f"{src}/raw")
    _run(jobs.start_log_collector(stream, f"{out}/ckpt", f"{out}/archive", fmt="files",
                                  path=f"{out}/topics", trigger=ONCE))
    topics = spark.read.option("recursiveFileLookup", "true").text(f"{out}/topics").withColumn(
        "topic", F.regexp_extract(F.input_file_name(), "topic=([^/]+)", 1))
    n = raw.count()
    assert topics.count() == n
    by_topic = {r.topic: r["count"] for r in topics.groupBy("topic").count().collect()}
    assert by_topic == {"startup_log_topic": n // 2, "event_log_topic": n // 2}
    archive = spark.read.text(f"{out}/archive")
    assert archive.count() == n
    assert archive.select("dt").distinct().count() == raw.select(
        F.date_format(F.timestamp_millis("received_ts"), "yyyy-MM-dd")).distinct().count()


def test_order_ingest_stream_splits_rejects(spark):
    src = tempfile.mkdtemp(prefix="orders-src-")
    out = tempfile.mkdtemp(prefix="orders-out-")
    good = ('{"id":"1","consignee":"Wang","consignee_tel":"13812345678","total_amount":"9.90",'
            '"create_time":"2020-08-19 00:08:13","user_id":"7","order_status":"1001"}')
    lines = [good, "{broken", '{"id":"2","consignee":"Li"}', good.replace("9.90", "abc"),
             good.replace("2020-08-19 00:08:13", "2020")]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(src)
    stream = spark.readStream.format("text").load(src)
    _run(jobs.start_orders(stream, f"{out}/orders", f"{out}/rejects", f"{out}/ckpt", ONCE))
    rows = jobs.read_orders(spark, f"{out}/orders").collect()
    assert [(r.id, r.consignee, r.consignee_tel, r.create_date, r.create_hour) for r in rows] == \
        [("1", "W**", "138****5678", "2020-08-19", "00")]
    reasons = sorted(r.reason for r in spark.read.parquet(f"{out}/rejects").collect())
    assert reasons == ["bad create_time", "bad total_amount", "malformed json", "missing: create_time"]


def test_collector_keeps_lines_as_they_are(spark):
    """Nested values survive, a repeated key or broken line becomes a reject, archive and topic agree."""
    out = tempfile.mkdtemp(prefix="stamp-")
    lines = ['{"logType":"startup","o":{"a":[1,"x"],"ts":5}}', '{"a":1,"a":2}', "{broken", '{"logType":"event","ts":7,"n":{"k":1}}', '{}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{out}/raw")
    raw = spark.readStream.format("text").load(f"{out}/raw").withColumn("received_ts", F.unix_millis(F.current_timestamp()))
    _run(jobs.start_log_collector(raw, f"{out}/ckpt", f"{out}/archive", fmt="files", path=f"{out}/topics", trigger=ONCE))
    read = lambda p: sorted(r.value for r in spark.read.option("recursiveFileLookup", "true").text(p).collect())
    assert read(f"{out}/topics") == read(f"{out}/archive") and len(read(f"{out}/topics")) == 3
    import json
    kept = [json.loads(x) for x in read(f"{out}/topics")]
    assert all(k["ts"] > 10**12 for k in kept)
    assert {"logType": "startup", "o": {"a": [1, "x"], "ts": 5}} in [{k: v for k, v in x.items() if k != "ts"} for x in kept]
    assert sorted(r.raw for r in spark.read.parquet(f"{out}/archive_rejects").collect()) == sorted(lines[1:3])


def test_alert_job_prints_alerts(spark, capfd):
    out = tempfile.mkdtemp(prefix="evc-out-")
    messages = td.event_messages(spark, SF)
    messages.coalesce(1).write.parquet(f"{out}/in")
    _run(jobs.start_alerts(_stream(spark, f"{out}/in", messages.schema), f"{out}/data", f"{out}/ckpt", "6 hours", "1 hour",
                           trigger=ONCE, show=5))
    assert jobs.read_alerts(spark, f"{out}/data").count() == 152
    assert "window_start" in capfd.readouterr().out


def test_compaction_and_generated_ids(spark):
    out = tempfile.mkdtemp(prefix="compact-")
    w = sinks.batch_writer(f"{out}/batches", transform=sinks.with_generated_id())
    w(spark.createDataFrame([("k1", 1), ("k2", 1)], "k string, v int"), 0)
    w(spark.createDataFrame([("k1", 5)], "k string, v int"), 1)
    ids = [r.doc_id for r in sinks.read_batches(spark, f"{out}/batches").collect()]
    assert len(ids) == len(set(ids)) == 3
    sinks.compact(spark, f"{out}/batches", ["k"], f"{out}/snapshot")
    snap = {r.k: r.v for r in spark.read.parquet(f"{out}/snapshot").collect()}
    assert snap == {"k1": 5, "k2": 1}


def test_column_table_writer_uppercases_and_checks_columns(spark):
    out = tempfile.mkdtemp(prefix="coltable-")
    df = spark.createDataFrame([("m1", "2024-01-01", 3)], "mid string, log_date string, n int")
    sinks.column_table_writer(out, ["mid", "log_date"], partition_by=["log_date"])(df, 0)
    got = spark.read.parquet(out)
    assert sorted(got.columns) == ["LOG_DATE", "MID", "batch_id"]
    with pytest.raises(Exception):
        sinks.column_table_writer(out, ["mid", "missing"])(df, 1)


def test_read_dimension_from_files(spark):
    from shoplens.sources.tables import read_dimension
    out = tempfile.mkdtemp(prefix="dim-")
    users = td.user_info(spark, SF)
    users.withColumn("birthday", F.col("birthday").cast("string")).write.mode("overwrite").parquet(out)
    dim = read_dimension(spark, fmt="parquet", path=out)
    assert dict(dim.dtypes)["birthday"] == "date"
    assert dim.count() == users.count()


def test_dealt_files_grow_with_the_tables_and_spread_equal_messages(spark, tmp_path, monkeypatch):
    from shoplens.streaming import runs
    spark.range(4000).selectExpr("uuid() AS u").write.parquet(f"{tmp_path}/t")
    # every message is the same but one in ten
    messages = spark.read.parquet(f"{tmp_path}/t").select(F.when(F.col("u") < "1", F.col("u")).otherwise("same").alias("value"))
    assert runs.files_per_batch(messages, 4) == 1
    monkeypatch.setattr(runs, "FILE_BYTES", 4 << 10)
    per = runs.write_dealt(messages, f"{tmp_path}/in", 4)
    counts = [r[0] for r in spark.read.parquet(f"{tmp_path}/in").groupBy(F.input_file_name()).count().select("count").collect()]
    assert per > 1 and len(counts) == 4 * per and sum(counts) == 4000
    assert max(counts) < 2 * 4000 / len(counts)
    query = (runs.dealt_stream(messages, f"{tmp_path}/stream").writeStream.format("noop")
             .option("checkpointLocation", f"{tmp_path}/ckpt").trigger(availableNow=True).start())
    query.awaitTermination()
    assert [p.numInputRows > 0 for p in query.recentProgress].count(True) == 4
