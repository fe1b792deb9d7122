"""Counts kept by signed deltas: equal to a recount after corrections, redeliveries, replays and gaps."""

import json
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shoplens.operators import dau as dau_ops
from shoplens.operators import orders as order_ops
from shoplens.plans import reports
from shoplens.streaming import counters, jobs

ONCE = {"availableNow": True}
LAYOUT = {"fold_every": 2}


def start(path, n, rows, spark):
    """Batch ``n`` of a stream of JSON texts."""
    os.makedirs(f"{path}/in", exist_ok=True)
    with open(f"{path}/in/{n}.txt", "w") as f:
        f.write("".join(json.dumps(r) + "\n" for r in rows))
    return spark.readStream.text(f"{path}/in").withColumn("received_ts", F.lit(0).cast("long"))


def order(i, amount, hour="10", day="2024-03-01", operate=None):
    return {"id": str(i), "consignee": "x y", "consignee_tel": "13800000000", "create_time": f"{day} {hour}:00:00",
            "operate_time": operate, "total_amount": amount}


def startup(mid, ts):
    return {"mid": mid, "uid": "u", "logType": "startup", "ts": ts}


def hours(df):
    return sorted(tuple(r) for r in df.collect())


def order_hours(spark, out):
    table = order_ops.amount_by_hour(jobs.read_orders(spark, out)).where("order_amount IS NOT NULL")
    return hours(jobs.order_counts(spark, out)), hours(table)


ORDERS = [
    [order(1, "10.00"), order(2, "5.50", "11"), order(3, None)],
    [order(1, "12.00", operate="2024-03-01 12:00:00"), order(4, "1.25", day="2024-03-02")],
    [order(1, "11.00", operate="2024-03-01 11:00:00"), order(2, "5.50", "11")],                 # an older version, a redelivery
    [order(4, "0.00", day="2024-03-02", operate="2024-03-03 00:00:00"), order(4, "9", day="2024-03-02")],
    [order(2, "-1.00", "12", operate="2024-03-05 00:00:00"), order(5, "abc")],                  # moves to another hour; a reject
    [order(6, "99999999999999.99")] * 3,
]


@pytest.mark.parametrize("layout", [LAYOUT, {"fold_every": 100}])
def test_amounts_equal_a_recount_after_every_batch(spark, layout):
    base = tempfile.mkdtemp(prefix="counts-")
    for n, rows in enumerate(ORDERS):
        raw = start(base, n, rows, spark)
        q = jobs.start_orders(raw, f"{base}/out", f"{base}/rej", f"{base}/ck", ONCE, layout=layout, counts=True)
        q.awaitTermination()
        kept, table = order_hours(spark, f"{base}/out")
        assert kept == table and len(kept) > 0
    assert ("2024-03-01", "12", Decimal("-1.00")) in kept and ("2024-03-01", "10", Decimal("100000000000011.99")) in kept


def test_earlier_startups_move_a_device_to_their_hour(spark):
    base, h = tempfile.mkdtemp(prefix="counts-"), 3_600_000
    batches = [[startup("a", 9 * h), startup("b", 9 * h), startup("a", 30 * h)],
               [startup("a", 5 * h), startup("b", 10 * h), startup("c", 5 * h)],
               [startup("a", 3 * h)], [startup("a", 4 * h), {"mid": "z"}], [startup("c", 5 * h)]]
    for n, rows in enumerate(batches):
        raw = start(base, n, rows, spark)
        jobs.start_dau(raw, f"{base}/out", f"{base}/ck", ONCE, keep="earliest", layout=LAYOUT, counts=True).awaitTermination()
        assert hours(jobs.dau_counts(spark, f"{base}/out")) == hours(dau_ops.dau_by_hour(jobs.read_dau(spark, f"{base}/out")))
    assert ("1970-01-01", "03", 1) in hours(jobs.dau_counts(spark, f"{base}/out"))
    jobs.count_store(spark, f"{base}/out").compact()
    assert hours(jobs.dau_counts(spark, f"{base}/out", ["1970-01-02"])) == [("1970-01-02", "06", 1)]


def test_a_gap_is_recounted_and_a_replay_adds_nothing(spark):
    base = tempfile.mkdtemp(prefix="counts-")
    for n, rows in enumerate(ORDERS):
        raw = start(base, n, rows, spark)
        # batches 0, 2 and 3 run without counts
        jobs.start_orders(raw, f"{base}/out", f"{base}/rej", f"{base}/ck", ONCE, layout=LAYOUT, counts=n not in (0, 2, 3)).awaitTermination()
        if n in (0, 2, 3):
            assert jobs.order_counts(spark, f"{base}/out") is None
        else:
            kept, table = order_hours(spark, f"{base}/out")
            assert kept == table
    # the last batch is run again, as after a crash before its commit
    last = len(ORDERS) - 1
    os.remove(f"{base}/ck/commits/{last}")
    crc = f"{base}/ck/commits/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    raw = start(base, last, ORDERS[last], spark)
    jobs.start_orders(raw, f"{base}/out", f"{base}/rej", f"{base}/ck", ONCE, layout=LAYOUT, counts=True).awaitTermination()
    again, table = order_hours(spark, f"{base}/out")
    assert again == kept == table


def test_reports_from_counts_equal_those_from_the_tables(spark):
    base = tempfile.mkdtemp(prefix="counts-")
    for n, rows in enumerate(ORDERS):
        jobs.start_orders(start(base, n, rows, spark), f"{base}/out", f"{base}/rej", f"{base}/ck", ONCE, counts=True).awaitTermination()
    counts = jobs.order_counts(spark, f"{base}/out", ["2024-02-29", "2024-03-01"])
    want = reports.hourly_amount_compare(jobs.read_orders(spark, f"{base}/out"), "2024-03-01")
    got = reports.hourly_compare_of_counts("order_amount", counts, "2024-03-01")
    assert hours(got) == hours(want) and got.schema == want.schema


def test_no_batch_no_counts(spark):
    base = tempfile.mkdtemp(prefix="counts-")
    assert jobs.order_counts(spark, f"{base}/out") is None
    empty = spark.createDataFrame([], "CREATE_DATE string, CREATE_HOUR string, TOTAL_AMOUNT decimal(16,2)")
    assert counters.recount(empty, "CREATE_DATE", "CREATE_HOUR", "TOTAL_AMOUNT").count() == 0
