"""Skewed inputs derived from the test tables: one device holding a third of
all events, one order holding a third of all lines. Results must stay exact."""

from pyspark.sql import functions as F

from parity import compare
from shoplens.operators import alerts, sales
from shoplens.plans import oracle
from shoplens.plans import registry as R
from shoplens.sources import testdata as td

SF = "/root/testdata/sf0.01"


def test_alerts_with_a_hot_device(spark, duck_parity):
    hot = F.when(F.col("event_id") % 3 == 0, F.lit("mid_hot")).otherwise(F.col("mid"))
    ev = td.event_log(spark, SF).withColumn("mid", hot)
    panes = alerts.pane_table(ev, R.ALERT_SLIDE)
    got = alerts.coupon_alerts(panes, R.ALERT_LENGTH, R.ALERT_SLIDE, R.ALERT_MIN_ACCOUNTS).select(
        "mid", "window_start", "window_end", "coupon_accounts", "n_events")
    sql = oracle.SQL["coupon_alerts"].replace(
        "'mid_' || CAST(user_id % 25 AS VARCHAR) AS mid",
        "CASE WHEN event_id % 3 = 0 THEN 'mid_hot' ELSE 'mid_' || CAST(user_id % 25 AS VARCHAR) END AS mid")
    assert "mid_hot" in sql
    problems, n_spark, _ = compare(got, duck_parity, sql)
    assert not problems, problems
    # the hot device always has a click in its windows, so it never alerts;
    # its windows still aggregate a third of the events, exactly
    w = alerts.alert_windows(panes, R.ALERT_LENGTH, R.ALERT_SLIDE).where("mid = 'mid_hot'")
    sql_w = oracle.SQL["coupon_alert_windows"].replace(
        "'mid_' || CAST(user_id % 25 AS VARCHAR) AS mid",
        "CASE WHEN event_id % 3 = 0 THEN 'mid_hot' ELSE 'mid_' || CAST(user_id % 25 AS VARCHAR) END AS mid")
    want = duck_parity.sql(f"SELECT max(coupon_accounts), sum(n_events) FROM ({sql_w}) WHERE mid = 'mid_hot'").fetchall()[0]
    got_w = w.agg(F.max("coupon_accounts"), F.sum("n_events")).first()
    assert tuple(got_w) == tuple(want) and want[0] >= R.ALERT_MIN_ACCOUNTS


def test_dedup_with_a_hot_device(spark, duck_parity):
    st = td.startup_log(spark, SF).withColumn(
        "mid", F.when(F.col("event_id") % 3 == 0, F.lit("mid_hot")).otherwise(F.col("mid")))
    got = R.dau_ops.daily_actives(st)
    sql = oracle.SQL["dau_dedup"].replace(
        "'mid_' || CAST(user_id AS VARCHAR) AS mid",
        "CASE WHEN event_id % 3 = 0 THEN 'mid_hot' ELSE 'mid_' || CAST(user_id AS VARCHAR) END AS mid")
    problems, _, _ = compare(got, duck_parity, sql)
    assert not problems, problems


def test_sale_join_with_a_hot_order(spark, duck_parity):
    li = td.table(spark, SF, "lineitem").withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("l_orderkey")))
    details = td.order_detail_from(li, td.table(spark, SF, "part"))
    got = sales.sale_wide(R.order_table(spark, SF), details, td.user_info(spark, SF), R.AS_OF, bound=None)
    sql = oracle.SQL["sale_wide_unbounded"]
    for old in ("CAST(l.l_orderkey AS VARCHAR) || ':'", "CAST(l.l_orderkey AS VARCHAR) AS order_id"):
        assert old in sql
    hot_key = "CAST(CASE WHEN l.l_linenumber % 3 = 0 THEN 0 ELSE l.l_orderkey END AS VARCHAR)"
    sql = sql.replace("CAST(l.l_orderkey AS VARCHAR) || ':'", hot_key + " || ':'") \
             .replace("CAST(l.l_orderkey AS VARCHAR) AS order_id", hot_key + " AS order_id")
    problems, n_spark, n_duck = compare(got, duck_parity, sql)
    assert not problems, problems
    assert got.where("order_id = '0'").count() > 10000


def test_full_pairs_equal_full_outer_join(spark):
    li = td.table(spark, SF, "lineitem").withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("l_orderkey")))
    orders = R.order_table(spark, SF)
    details = td.order_detail_from(li, td.table(spark, SF, "part"))
    for bound in (None, "30 days"):
        flat = sales.full_pairs(orders, details, bound).select("order_id", "detail_order_id", "detail_id")
        outer = sales.join_orders_details(orders, details, bound, how="full").select(
            F.col("o.id"), F.col("d.order_id"), F.col("d.id"))
        assert flat.exceptAll(outer).count() == 0 and outer.exceptAll(flat).count() == 0
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan
