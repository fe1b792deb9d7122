"""What the jobs and stored tables leave on the disks, and steps done in turns."""

import os
import time

from pyspark import StorageLevel
from pyspark.sql import functions as F

from shoplens import config
from shoplens.operators import search
from shoplens.operators.postings import SearchIndex
from shoplens.plans import registry as R
from shoplens.streaming import runs, state

SF = "/root/testdata/sf0.001"


def shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def gone(spark, before: set[str]) -> bool:
    for _ in range(100):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.1)
    return False


def test_sales_stored_in_turns_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "_STORED", {})
    monkeypatch.setattr(config, "TURN_BYTES", 16 << 10)
    before = shuffle_files(spark)
    joins = []
    join = R.sales.sale_wide
    monkeypatch.setattr(R.sales, "sale_wide", lambda *a, **b: joins.append(1) or join(*a, **b))
    table, index = R.stored_sales(spark, SF)
    files = {f.rsplit(".", 2)[-2] for f in table.inputFiles()}
    assert len(joins) == config.TURNS and files == {"zstd"}
    # what finds the days and parts of a batch is a handful of rows
    left = shuffle_files(spark) - before
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    time.sleep(2)
    files = disk.getAllFiles()
    sizes = [files.apply(i).length() for i in range(files.size()) if files.apply(i).getName() in left]
    assert sum(sizes) < 64 << 10
    want = R.sale_index(spark, SF)
    assert sorted(map(tuple, table.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    whole = SearchIndex(spark, f"{tmp_path}/whole")
    monkeypatch.setattr(config, "TURN_BYTES", 1 << 30)
    whole.update(want, 0)
    got, one = (x.search("red").select(*search.TIE_BREAK, F.round("score", 9)) for x in (index, whole))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, one.collect()))


def test_index_of_repeated_and_null_keys_in_turns(spark, tmp_path, monkeypatch):
    rows = [(str(i % 30) if i % 7 else None, str(i % 3), f"2024-01-0{i % 4 + 1}", f"red box{i % 5}") for i in range(200)]
    spark.createDataFrame(rows, "order_id string, order_detail_id string, dt string, sku_name string").write.parquet(f"{tmp_path}/in")
    batch = spark.read.parquet(f"{tmp_path}/in")

    def stored(name):
        index = SearchIndex(spark, f"{tmp_path}/{name}")
        index.update(batch, 0)
        index.update(batch.where("order_detail_id = '1'"), 1)
        return [sorted(map(tuple, t.read().collect()), key=str) for t in (index.rows, index.postings, index.sums)]

    want = stored("whole")
    monkeypatch.setattr(config, "TURN_BYTES", 256)
    assert config.turns(batch) > 1
    assert stored("turns") == want


def test_a_batch_in_parts_is_one_batch_also_when_run_again(spark, tmp_path):
    table = state.DayTable(spark, str(tmp_path), "day", lambda t: t, ["k"])
    rows = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "k int, day int")
    for _ in range(2):
        mine = table.write([rows.where("k < 2"), rows.where("k >= 2")], 0)
        assert sorted(r.k for r in mine.collect()) == [1, 2, 3]
    assert sorted(r.k for r in table.read().collect()) == [1, 2, 3]
    assert sorted(r.k for r in table.read([1]).collect()) == [1, 2]


def test_dealing_messages_shuffles_nothing_and_keeps_every_row(spark, tmp_path, monkeypatch):
    spark.range(0, 4000, 1, 3).selectExpr("cast(id as string) AS value").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    monkeypatch.setattr(runs, "FILE_BYTES", 1 << 10)
    for turn in (1, 2):     # appended
        per = runs.write_dealt(table.unionByName(table), f"{tmp_path}/in", 4)
        assert per > 1
        dealt = spark.read.parquet(f"{tmp_path}/in")
        assert dealt.groupBy("value").count().where(F.col("count") != 2 * turn).count() == 0
    by_turn = {r._turn: r["count"] for r in dealt.groupBy("_turn").count().collect()}
    assert sorted(by_turn) == [0, 1, 2, 3] and max(by_turn.values()) - min(by_turn.values()) < 100
    apart = dealt.groupBy("value").agg(F.count_distinct("_turn").alias("n")).where("n > 1").count()
    assert apart > 2000
    times = {}
    for f in runs._files(spark, f"{tmp_path}/in"):
        times.setdefault(f.split("_turn=")[1][0], []).append(os.stat(f.removeprefix("file:")).st_mtime)
    assert max(map(min, times.values())) == min(times["3"]) and min(map(min, times.values())) == min(times["0"])
    fresh = shuffle_files(spark)
    runs.write_dealt(table, f"{tmp_path}/again", 4)
    assert gone(spark, fresh)


def test_orders_read_from_the_feed_leave_no_messages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    got = runs.stream_order_redelivery(spark, SF)
    once = R.order_ops.amount_by_date(R.order_table(spark, SF).dropDuplicates(["id"]))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, once.collect()))
    base = f"{tmp_path}/stream_redelivery"
    assert runs._files(spark, f"{base}/feed") == []
    topics = runs._files(spark, f"{base}/topics")
    assert topics and all(f.endswith(".gz") or "_spark_metadata" in f for f in topics)
    names = ["create_date", "total_amount"]
    want = runs.jobs.read_orders(spark, f"{base}/orders").select(*names)
    assert sorted(map(tuple, runs.jobs.read_orders(spark, f"{base}/orders", columns=names).collect())) == sorted(map(tuple, want.collect()))


def test_parsed_messages_are_kept_on_disk(spark):
    kept = []

    def parser(messages, keep):
        kept.append(keep(messages))
        return kept[0], kept[0]

    with runs.jobs._parsed(parser, spark.range(10).toDF("value")) as (rows, _):
        assert rows.count() == 10
        assert kept[0].storageLevel == StorageLevel.DISK_ONLY
    assert kept[0].storageLevel == StorageLevel.NONE
