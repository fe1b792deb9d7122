"""The as-of join against brute force, with a hot key, and users that change between batches."""

import datetime as dt
import random
import tempfile

import pytest

from shoplens.operators.dimension import as_of_join
from shoplens.streaming import jobs

T0 = dt.datetime(2024, 1, 1)


def brute(rows, versions):
    out = []
    for i, key, t in rows:
        mine = sorted((at, level) for k, at, level in versions if k == key and k is not None and at is not None)
        if mine and t is not None:
            before = [v for v in mine if v[0] <= t]
            out.append((i, before[-1][1] if before else max(l for at, l in mine if at == mine[0][0])))
    return sorted(out)


@pytest.mark.parametrize("seed,bucket", [(1, "1 day"), (2, "1 hour"), (3, "400 days")])
def test_against_brute_force(spark, seed, bucket):
    rng = random.Random(seed)

    def some(n):
        return [("hot" if rng.random() < 0.4 else f"u{rng.randrange(40)}", T0 + dt.timedelta(minutes=rng.randrange(20_000))) for _ in range(n)]

    versions = [(k, t, f"v{rng.randrange(9)}") for k, t in some(300)] + [("u1", T0, "a"), ("u1", T0, "b"), (None, T0, "x"), ("u2", None, "y")]
    rows = [(i, k, t) for i, (k, t) in enumerate(some(500))] + [(900, "u1", T0), (901, "u1", T0 - dt.timedelta(9)), (902, None, T0), (903, "hot", None), (904, "nobody", T0)]
    got = as_of_join(spark.createDataFrame(rows, "i int, k string, t timestamp_ntz"), spark.createDataFrame(versions, "id string, since timestamp_ntz, level string"),
                     "k", "t", "id", "since", ["level"], bucket)
    assert got.columns == ["i", "k", "t", "level"]
    assert sorted((r.i, r.level) for r in got.collect()) == brute(rows, versions)


def test_hot_key_is_spread_over_buckets(spark):
    """A key with all rows is sorted bucket by bucket; only bucket summaries are seen by key alone."""
    rows = spark.range(20_000).selectExpr("id", "'k' as k", "timestampadd(MINUTE, id, timestamp_ntz'2024-01-01 00:00:00') as t")
    versions = rows.where("id % 10 = 0").selectExpr("k as id", "t as since", "cast(id as string) as level")
    got = as_of_join(rows, versions, "k", "t", "id", "since", ["level"])
    assert got.where("level <> cast(id div 10 * 10 as string)").count() == 0 and got.count() == 20_000


def test_changes_between_batches(spark):
    """The row valid at the order's time holds, whenever the batch runs; rejects are kept."""
    out = tempfile.mkdtemp(prefix="users-")
    fields = "id string, login_name string, user_level string, birthday string, gender string, valid_from timestamp_ntz"

    def change(*rows):
        spark.createDataFrame(rows, fields).coalesce(1).write.mode("append").parquet(f"{out}/changes")
        q = jobs.start_users(spark.readStream.schema(fields).parquet(f"{out}/changes"), f"{out}/users", f"{out}/ckpt-users", {"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None, q.exception()

    def sell(order, day):
        schema = "kind string, value string, received_ts long"
        value = '{"id":"%s","consignee":"Wang","total_amount":"9.90","create_time":"2024-01-%02d 10:00:00","user_id":"7"}' % (order, day)
        line = '{"id":"l","order_id":"%s","order_price":"4.50","sku_name":"x"}' % order
        spark.createDataFrame([("order", value, 0), ("detail", line, 0)], schema).coalesce(1).write.mode("append").parquet(f"{out}/in")
        q = jobs.start_sales(spark.readStream.schema(schema).parquet(f"{out}/in"), f"{out}/sales", f"{out}/ckpt", jobs.version_lookup(spark, f"{out}/users"),
                             "2024-06-01", trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None, q.exception()
        return {r.order_id: r.user_level for r in jobs.read_sales(spark, f"{out}/sales").collect()}

    change(("7", "u", "silver", "1990-01-01", "M", T0), ("7", "u", "gold", "1990-01-01", "M", T0 + dt.timedelta(5)), (None, "u", "x", None, None, T0))
    assert sell("1", 3) == {"1": "silver"}
    change(("7", "u", "black", "1990-01-01", "M", T0 + dt.timedelta(9)), ("7", "u", "silver", "1990-01-01", "M", T0))
    assert sell("2", 8) == {"1": "silver", "2": "gold"} and sell("3", 20)["3"] == "black"
    assert spark.read.parquet(f"{out}/users_rejects").count() == 1
    assert jobs.user_store(spark, f"{out}/users").read().count() == 3
