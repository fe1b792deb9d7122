"""The jobs' stored tables: level cost, atomic folding, replays; windows by sweep."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from shoplens.functions import parse
from shoplens.operators import alerts
from shoplens.operators.dedup import keep_last
from shoplens.streaming import jobs
from shoplens.streaming.state import DayTable

ONCE = {"availableNow": True}
DAY0 = dt.date(2024, 1, 1)


def table(spark, path, **layout):
    return DayTable(spark, path, "day", lambda t: keep_last(t, ["k"], ["v", "batch_id"]), ["k"], **layout)


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, day date").coalesce(1)


def content(df):
    return sorted((r.k, r.v) for r in df.collect())


def test_files_opened_stay_level_over_200_batches(spark):
    """A batch opens its own days' files only, and as many at the end as after the first fold."""
    t = table(spark, tempfile.mkdtemp(prefix="level-"), grace=40)
    opened, want = [], {}
    for n in range(200):
        day = DAY0 + dt.timedelta(n // 10)
        if n and n % 16 == 1:
            old = t.rows([day, DAY0], before=n)
            opened.append(len(old.inputFiles()))
        rows = [(f"k{n % 23}-{n // 10}", n, day)]
        want.update({k: v for k, v, _ in rows})
        t.write(batch(spark, rows), n)
    assert max(opened) <= opened[0] + 2
    assert content(t.read()) == sorted(want.items())
    # what no manifest names any more is removed after a while
    import os
    assert len([f for f in os.listdir(t.path) if f.startswith("batch_id=")]) <= 40 + 2 * 16


def test_days_of_any_text_are_found(spark):
    days = ["2024-01-01", "it's", "a\\b", 'say "x"', "a`b\nc", ""]
    t = DayTable(spark, tempfile.mkdtemp(prefix="days-"), "day", lambda t: keep_last(t, ["k"], ["v", "batch_id"]), ["k"])
    t.write(spark.createDataFrame([(f"k{i}", i, d) for i, d in enumerate(days)], "k string, v int, day string"), 0)
    for i, d in enumerate(days):
        assert content(t.read([d])) == [(f"k{i}", i)]
    assert content(t.read(days[1:3])) == [("k1", 1), ("k2", 2)]
    many = [DAY0 + dt.timedelta(i) for i in range(3000)]
    t = table(spark, tempfile.mkdtemp(prefix="days-"))
    t.write(batch(spark, [("a", 1, many[0]), ("b", 2, many[-1]), ("c", 3, many[-1] + dt.timedelta(1))]), 0)
    assert content(t.read(many)) == [("a", 1), ("b", 2)]


def test_replay_and_crash_before_the_manifest(spark):
    t = table(spark, tempfile.mkdtemp(prefix="crash-"), fold_every=2)
    for n in range(5):
        t.write(batch(spark, [("a", n, DAY0), (f"b{n}", n, DAY0 + dt.timedelta(n))]), n)
    before = content(t.read())
    # batch 5 fails after its rows are written and the fold is done: readers see nothing of it
    commit = t.commit
    t.commit = lambda m: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        t.write(batch(spark, [("a", 99, DAY0)]), 5)
    t.commit = commit
    assert content(table(spark, t.path).read()) == before
    for _ in range(2):     # it is run again, twice
        seen = content(t.read(before=5))
        t.write(batch(spark, [("a", 99, DAY0)]), 5)
        assert seen == before and dict(content(t.read()))["a"] == 99 and len(content(t.read())) == len(before)


def test_reading_is_equal_before_during_and_after_folding(spark):
    t = table(spark, tempfile.mkdtemp(prefix="fold-"), span=7)
    for n in range(6):
        t.write(batch(spark, [("a", n, DAY0), (f"b{n}", n, DAY0 + dt.timedelta(5 * n)), ("x", 9 - n, DAY0)]), n)
    t.write(spark.createDataFrame([("none", 1, None)], "k string, v int, day date"), 6)
    reader, held = table(spark, t.path, span=7), t.read()
    before = content(reader.read())
    manifest = t.manifest()
    folded = t.folded(manifest, manifest["batch"], "_base/6-compacted")
    assert content(reader.read()) == before                   # new folders are there, no manifest names them
    t.commit(folded)
    assert content(reader.read()) == before == content(held)   # a reader with the older manifest goes on
    assert not t.manifest()["live"] and content(t.read([DAY0])) == [("a", 5), ("b0", 0), ("x", 9)]
    t.compact()
    t.write(batch(spark, [("a", 50, DAY0)]), 7)
    assert dict(content(t.read()))["a"] == 50 and dict(content(t.read()))["none"] == 1


def test_text_days_and_empty_batches(spark):
    t = DayTable(spark, tempfile.mkdtemp(prefix="text-"), "day", lambda d: keep_last(d, ["k"], ["batch_id"]), ["k"], fold_every=1)
    rows = [("a", "2024-02-29"), ("b", "2024-99-99"), ("c", None), ("d", "")]
    t.write(spark.createDataFrame([], "k string, day string"), 0)
    for n in (1, 2, 3):
        t.write(spark.createDataFrame(rows, "k string, day string"), n)
    assert sorted(r.k for r in t.read().collect()) == ["a", "b", "c", "d"]
    assert [r.k for r in t.read(["2024-02-29"]).collect()] == ["a"] and [r.k for r in t.read(["2024-99-99"]).collect()] == ["b"]
    assert t.read(["2024-03-01"]).collect() == [] and t.rows(before=0) is None


def run_dau(spark, out, rows, layout):
    spark.createDataFrame(rows, "value string, received_ts long").coalesce(1).write.mode("append").parquet(f"{out}/in")
    stream = spark.readStream.schema("value string, received_ts long").parquet(f"{out}/in")
    q = jobs.start_dau(stream, f"{out}/dau", f"{out}/ckpt", ONCE, keep="earliest", layout=layout)
    q.awaitTermination()
    assert q.exception() is None, q.exception()


def test_job_folds_while_it_runs(spark):
    out, rng, want = tempfile.mkdtemp(prefix="dau-fold-"), random.Random(1), {}
    for n in range(7):
        rows = []
        for _ in range(30):
            mid, ts = f"m{rng.randrange(9)}", 1_704_067_200_000 + rng.randrange(3 * 86_400_000)
            day = dt.datetime.fromtimestamp(ts / 1000, dt.timezone.utc).date().isoformat()
            want[day, mid] = min(want.get((day, mid), ts), ts)
            rows.append(('{"mid":"%s","uid":"u","ts":%d,"logType":"startup"}' % (mid, ts), 0))
        run_dau(spark, out, rows, {"fold_every": 2})
    assert jobs.dau_store(spark, f"{out}/dau").manifest()["base"]
    assert {(r.log_date, r.mid): r.ts for r in jobs.read_dau(spark, f"{out}/dau").collect()} == want
    one = {k: v for k, v in want.items() if k[0] == "2024-01-02"}
    assert {(r.log_date, r.mid): r.ts for r in jobs.read_dau(spark, f"{out}/dau", ["2024-01-02"]).collect()} == one


def test_an_older_version_does_not_replace_a_newer_one(spark):
    out = tempfile.mkdtemp(prefix="versions-")
    row = ('{"id":"1","consignee":"Wang","total_amount":"%s","create_time":"2020-08-19 00:08:13","operate_time":"%s","user_id":"7"}')
    for amount, changed in (("5.00", "2020-08-19 03:00:00"), ("4.00", "2020-08-19 01:00:00")):   # the older one comes late
        spark.createDataFrame([(row % (amount, changed),)], "value string").coalesce(1).write.mode("append").text(f"{out}/in")
        q = jobs.start_orders(spark.readStream.format("text").load(f"{out}/in"), f"{out}/orders", f"{out}/rejects", f"{out}/ckpt", ONCE)
        q.awaitTermination()
        assert q.exception() is None
    assert [str(r.total_amount) for r in jobs.read_orders(spark, f"{out}/orders").collect()] == ["5.00"]


def test_dimension_that_changes_within_a_batch_loses_no_pair(spark):
    """Users appear each time the dimension is looked at; every pair is in the sales or waits."""
    out, looks = tempfile.mkdtemp(prefix="race-"), []
    order = '{"id":"%s","consignee":"Wang","total_amount":"9.90","create_time":"2020-08-19 00:08:13","user_id":"%s"}'
    line = '{"id":"%s","order_id":"%s","order_price":"4.50","sku_name":"x"}'
    fields = "id string, login_name string, user_level string, birthday string, gender string"

    def read(pairs):
        looks.append(1)
        # evaluated anew, this would be other users each time
        users = spark.createDataFrame([("0", "u", "1", "1990-01-01", "M")] + [(str(i), "u", "1", "1990-01-01", "M") for i in range(len(looks))], fields)
        return parse.typed_users(users).dropDuplicates(["id"])

    schema = "kind string, value string, received_ts long"
    for n in range(4):
        rows = [("order", order % (10 * n + i, i), n) for i in range(4)] + [("detail", line % (10 * n + i, 10 * n + i), n) for i in range(4)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{out}/in")
        q = jobs.start_sales(spark.readStream.schema(schema).parquet(f"{out}/in"), f"{out}/data", f"{out}/ckpt", read, trigger=ONCE, layout={"fold_every": 1})
        q.awaitTermination()
        assert q.exception() is None, q.exception()
        assert len(looks) == n + 1     # one look a batch
        sold = {(r.order_id, r.order_detail_id) for r in jobs.read_sales(spark, f"{out}/data").collect()}
        waits = {(r.order_id, r.order_detail_id) for r in jobs.sale_stores(spark, f"{out}/data")["waiting"].read().collect()}
        assert sold | waits == {(str(10 * m + i),) * 2 for m in range(n + 1) for i in range(4)} and not sold & waits
    assert not waits


# --- sweep ---------------------------------------------------------------------

def brute_windows(rows, k):
    """rows: (mid, pane, uid, n, clicked): {(mid, w): (accounts, events, clicked)}"""
    out = {}
    for mid, pane, uid, n, clicked in rows:
        for w in range(pane - k + 1, pane + 1):
            a, e, c = out.get((mid, w), (set(), 0, False))
            out[mid, w] = (a | ({uid} if uid else set()), e + n, c or bool(clicked))
    return {x: (len(a), e, c) for x, (a, e, c) in out.items()}


@pytest.mark.parametrize("k,chunk,seed", [(1, 2, 1), (5, 1, 2), (5, 64, 3), (12, 2, 4)])
def test_sweep_against_brute_force(spark, monkeypatch, k, chunk, seed):
    monkeypatch.setattr(alerts, "CHUNK", chunk)
    rng = random.Random(seed)
    rows = {(f"m{rng.randrange(3)}", rng.randrange(-40, 160), rng.choice([None, "u1", "u2", "u3", "u4"])): (rng.randrange(1, 4), int(rng.random() < 0.05)) for _ in range(260)}
    rows = [(*key, *v) for key, v in rows.items()]
    parts = spark.createDataFrame(rows, "mid string, pane long, uid string, n long, clicked int")
    want = brute_windows(rows, k)
    got = alerts.alert_windows(parts, f"{k} seconds", "1 second").collect()
    assert {(r.mid, r.w): (r.coupon_accounts, r.n_events, r.clicked) for r in got} == want and len(got) == len(want)
    got = alerts.coupon_alerts(parts, f"{k} seconds", "1 second", 2).collect()
    assert {(r.mid, r.w): (r.coupon_accounts, r.n_events) for r in got} == {x: v[:2] for x, v in want.items() if v[0] >= 2 and not v[2]}
    some = parts.where("pane % 7 = 0")
    touched = {(m, w) for m, p, *_ in rows if p % 7 == 0 for w in range(p - k + 1, p + 1)}
    kept = alerts.in_windows_of(alerts.alert_windows(parts, f"{k} seconds", "1 second"), some, k).collect()
    assert {(r.mid, r.w) for r in kept} == touched


def test_rows_of_the_sweep_do_not_grow_with_the_windows_per_event(spark):
    parts = spark.range(4000).select((F.col("id") % 3).cast("string").alias("mid"), (F.col("id") * 37 % 9000).alias("pane"),
                                     (F.col("id") % 50).cast("string").alias("uid"), F.lit(1).cast("long").alias("n"), F.lit(0).alias("clicked"))
    runs = [alerts.window_runs(parts, k).count() for k in (10, 50, 250)]
    assert max(runs) <= 4 * parts.count()
