
import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.constants import EVENT_LOG_TOPIC, STARTUP_LOG_TOPIC
from shoplens.functions import masking, parse
from shoplens.functions.text import query_tokens
from shoplens.operators import alerts, orders, routing, sales, search
from shoplens.plans import reports


def test_phone_and_name_masking(spark):
    df = spark.createDataFrame(
        [("13812345678", "Zhang"), ("8613812345678", "L"), ("138****5678", ""), (None, None), ("123", "x")],
        "tel string, name string")
    out = df.select(masking.mask_phone("tel").alias("t"), masking.mask_name("name").alias("n")).collect()
    assert [r.t for r in out] == ["138****5678", "861****345678", "138****5678", None, "123"]
    assert [r.n for r in out] == ["Z**", "L**", "**", None, "x**"]
    twice = df.select(masking.mask_phone(masking.mask_phone("tel")).alias("t")).collect()
    assert [r.t for r in twice] == [r.t for r in out]


def test_golden_event_json(spark):
    line = ('{"logType":"event","area":"beijing","uid":"uid5774","eventId":"coupon","itemId":38,'
            '"os":"android","nextPageId":33,"appId":"shop","mid":"mid_58","pageId":50,"ts":1598000978921}')
    rows, rejects = parse.event_logs(spark.createDataFrame([(line,)], "value string"), tz="UTC")
    r = rows.first()
    assert (r.itemId, r.log_date, r.log_hour, r.pageId) == ("38", "2020-08-21", "09", "50")
    assert rejects.count() == 0


def test_explicit_zone(spark):
    line = '{"mid":"m","ts":1598000978921}'
    rows, _ = parse.startup_logs(spark.createDataFrame([(line,)], "value string"), tz="Asia/Shanghai")
    assert rows.first().log_hour == "17"


def test_rejects_for_malformed_and_missing(spark):
    msgs = ['{"id":"1","create_time":"2020-08-19 00:08:13","consignee":"Wang","consignee_tel":"13812345678",'
            '"total_amount":"12.5"}',
            '{not json', '{"id":"2","consignee":"Li"}', None]
    rows, rejects = parse.order_infos(spark.createDataFrame([(m,) for m in msgs], "value string"))
    r = rows.first()
    assert rows.count() == 1
    assert (r.create_date, r.create_hour, r.consignee, r.consignee_tel) == \
        ("2020-08-19", "00", "W**", "138****5678")
    reasons = sorted(x.reason for x in rejects.collect())
    assert reasons == ["malformed json", "missing: create_time", "null message"]


@pytest.mark.parametrize("parser", [parse.startup_logs, parse.event_logs, parse.order_infos, parse.order_details])
def test_a_message_is_parsed_once(spark, parser):
    """Rows need one parsing of a message, however many of its fields are asked about; with ``keep`` rows and
    rejects have it in common."""
    msgs = ['{"id":"1","order_id":"2","mid":"m","ts":1,"create_time":"2020-08-19 00:08:13","consignee":"Wang","order_price":"1"}',
            '{not json', '{"id":"2"}', None, '{"id":"1","order_id":"2","mid":"m","ts":"x","create_time":"2020","order_price":"no"}']
    path = tempfile.mkdtemp(prefix="msgs-")
    spark.createDataFrame([(m, 5) for m in msgs], "value string, received_ts long").write.mode("overwrite").parquet(path)
    raw = spark.read.parquet(path)
    kept = []

    def keep(df):
        kept.append(df.persist())
        return kept[-1]

    plain, once = parser(raw), parser(raw, keep=keep)
    assert plain[0]._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert len(kept) == 1
    for a, b in zip(plain, once):
        assert a.columns == b.columns
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert plain[0].count() + plain[1].count() == len(msgs)
    kept[0].unpersist()


def test_bad_values_are_rejects_or_null(spark):
    line = '{"id":"1","order_id":"2","order_price":"%s"}'
    rows, rejects = parse.order_details(spark.createDataFrame([(line % "1.25",), (line % "cheap",)], "value string"))
    assert rows.count() == 1 and [r.reason for r in rejects.collect()] == ["bad order_price"]
    users = spark.createDataFrame([("1", "1990-01-01"), ("2", "not-a-date"), ("3", None)], "id string, birthday string")
    users = users.selectExpr("id", "'n' login_name", "'1' user_level", "birthday", "'M' gender")
    assert [r.birthday is None for r in parse.typed_users(users).orderBy("id").collect()] == [False, True, True]


def _orders(spark, rows):
    return spark.createDataFrame(rows, "id string, order_status string, create_time string, "
                                       "user_id string, order_ts timestamp_ntz")


def _details(spark, rows):
    return spark.createDataFrame(rows, "id string, order_id string, sku_id string, sku_name string, "
                                       "order_price string, detail_ts timestamp_ntz")


T0 = dt.datetime(2020, 8, 19, 10, 0, 0)


def test_order_one_does_not_pick_up_order_ten(spark):
    o = _orders(spark, [("1", "1001", "2020-08-19 10:00:00", "7", T0),
                        ("10", "1001", "2020-08-19 10:00:00", "7", T0)])
    d = _details(spark, [("a", "1", "s", "x", "1.00", T0), ("b", "10", "s", "x", "2.00", T0),
                         ("c", "11", "s", "x", "3.00", T0)])
    pairs = sales.sale_rows(sales.join_orders_details(o, d, "30 minutes")).collect()
    assert sorted((p.order_id, p.order_detail_id) for p in pairs) == [("1", "a"), ("10", "b")]


def test_interval_bound_and_repeats(spark):
    m = dt.timedelta(minutes=1)
    o = _orders(spark, [("1", "1001", "2020-08-19 10:00:00", "7", T0),
                        ("2", "1001", "2020-08-19 10:00:00", "7", T0)])
    d = _details(spark, [("before", "1", "s", "x", "1", T0 - 20 * m),
                         ("after", "1", "s", "x", "1", T0 + 29 * m),
                         ("same", "1", "s", "x", "1", T0),
                         ("too_late", "1", "s", "x", "1", T0 + 31 * m),
                         ("same", "1", "s", "x", "1", T0)])
    rows = sales.sale_rows(sales.join_orders_details(o, d, "30 minutes")).dropDuplicates(sales.SALE_KEY)
    got = sorted(r.order_detail_id for r in rows.collect())
    assert got == ["after", "before", "same"]
    full = sales.join_orders_details(o, d, "30 minutes", how="full")
    assert full.where(F.col("d.id").isNull()).select("o.id").first()[0] == "2"


def test_unknown_user_inner_vs_left(spark):
    s = spark.createDataFrame([("d", "1", "1001", "2020-08-19 10:00:00", "404", "s", "x", "1.00", "2020-08-19")],
                              "order_detail_id string, order_id string, order_status string, create_time string, "
                              "user_id string, sku_id string, sku_name string, sku_price string, dt string")
    u = spark.createDataFrame([("7", "n", "1", dt.date(2000, 1, 1), "M")],
                              "id string, login_name string, user_level string, birthday date, gender string")
    assert sales.enrich_users(s, u, "2020-08-25").count() == 0
    left = sales.enrich_users(s, u, "2020-08-25", how="left").first()
    assert left.user_id == "404" and left.user_gender is None


def _events(spark, rows):
    return spark.createDataFrame(rows, "mid string, uid string, eventId string, itemId string, "
                                       "event_time timestamp_ntz")


def test_null_account_ignored_and_click_suppresses(spark):
    s = dt.timedelta(seconds=1)
    ev = _events(spark, [("m1", "u1", "coupon", "1", T0), ("m1", "u2", "coupon", "2", T0 + s),
                         ("m1", None, "coupon", "3", T0 + 2 * s),
                         ("m2", "u1", "coupon", "1", T0), ("m2", "u2", "coupon", "2", T0 + s),
                         ("m2", "u3", "coupon", "3", T0 + 2 * s),
                         ("m3", "u1", "coupon", "1", T0), ("m3", "u2", "coupon", "2", T0 + s),
                         ("m3", "u3", "coupon", "3", T0 + 2 * s), ("m3", "u4", "clickItem", "9", T0 + 3 * s)])
    a = alerts.coupon_alerts(alerts.pane_table(ev, "6 seconds"), "5 minutes", "6 seconds", 3)
    assert {r.mid for r in a.collect()} == {"m2"}
    # the reference's rule: one alert per device per minute, last window wins
    t = alerts.throttle_alerts(a, "1 minute").collect()
    assert len({(r.mid, r.bucket) for r in t}) == len(t)
    # every window of m2 containing all three coupons: 50-slide windows hold them
    assert a.where("mid = 'm2'").count() == 50
    acc = alerts.alert_accounts(alerts.pane_table(ev, "6 seconds"), a, "5 minutes", "6 seconds")
    assert {r.uid for r in acc.collect()} == {"u1", "u2", "u3"}


def test_log_routing_modes_and_server_ts(spark):
    lines = [('{"logType":"event","area":"startup-park","mid":"m"}', 5),
             ('{"logType":"startup","mid":"m","ts":1}', 7),
             ('not json', 9)]
    raw = spark.createDataFrame(lines, "value string, received_ts long")
    by_field = routing.route_logs(raw).collect()
    assert [r.topic for r in by_field] == [EVENT_LOG_TOPIC, STARTUP_LOG_TOPIC]
    assert json.loads(by_field[1].value)["ts"] == 7
    assert json.loads(by_field[0].value)["area"] == "startup-park"
    assert [r.raw for r in routing.stamp_logs(raw).where("value is null").collect()] == ["not json"]
    by_text = routing.route_logs(raw, mode="substring").collect()
    assert by_text[0].topic == STARTUP_LOG_TOPIC


def test_change_feed_filter(spark):
    row = [("id", "1"), ("user_id", "7")]
    entries = [("order_info", "ROWDATA", "INSERT", [row]),
               ("order_info", "ROWDATA", "UPDATE", [row]),
               ("order_info", "ROWDATA", "DELETE", [row]),
               ("user_info", "ROWDATA", "INSERT", [row]),
               ("order_detail", "TRANSACTIONEND", None, []),
               ("order_detail", "ROWDATA", "INSERT", []),
               ("order_detail", "ROWDATA", "INSERT", [[("id", "d1")], [("id", "d2")]])]
    feed = spark.createDataFrame(entries, schemas.CHANGE_ENTRY)
    out = routing.route_changes(feed).collect()
    assert [(r.topic, json.loads(r.value)) for r in out] == [
        ("order_info_topic", {"id": "1", "user_id": "7"}),
        ("order_detail_topic", {"id": "d1"}), ("order_detail_topic", {"id": "d2"})]


def test_date_without_orders_is_zero(spark):
    o = spark.createDataFrame([("2020-08-19", "00", "1.50")],
                              "create_date string, create_hour string, total_amount string")
    assert float(orders.amount_for_date(o, "2020-08-20").first().order_amount) == 0.0
    cmp = reports.realtime_hour("order_amount", o, "2020-08-20").collect()
    assert len(cmp) == 24 and float(cmp[0].yesterday) == 1.5 and float(cmp[0].today) == 0
    with pytest.raises(ValueError):
        reports.realtime_hour("no_such_metric", o, "2020-08-20")


def test_gender_labels_and_age_bands(spark):
    rows = [("M", 19), ("F", 20), (None, 29), ("M", 30), ("M", 45)]
    m = spark.createDataFrame(rows, "user_gender string, user_age int")
    g = {r.name: r.value for r in search.gender_stats(m).collect()}
    assert g == {"男": 3, "女": 1}
    a = [(r.name, r.value) for r in search.age_stats(m).orderBy("band_order").collect()]
    assert a == [("20岁以下", 1), ("20岁到30岁", 2), ("30岁及以上", 2)]
    empty = search.age_stats(m.where("false")).collect()
    assert [r.value for r in empty] == [0, 0, 0]


def test_keyword_tokens_and_empty_keyword(spark):
    assert query_tokens("手机小米") == ["手", "机", "小", "米"]
    assert query_tokens("Red  WIDGET!") == ["red", "widget"]
    df = spark.createDataFrame([("red widget",), ("小米手机 Pro",), ("blue gear",)], "sku_name string")
    assert search.match_all(df, "widget red").count() == 1
    assert search.match_all(df, "手机小米").count() == 1
    assert search.match_all(df, "").count() == 0
    assert search.match_all(df, "", empty_keyword="all").count() == 3


def test_pages_concatenate(spark):
    df = spark.range(23).select(F.col("id").cast("string").alias("order_id"),
                                F.lit("x").alias("order_detail_id"), (F.col("id") % 3).cast("double").alias("score"))
    full = [r.order_id for r in df.orderBy(*search.ranked(df)).collect()]
    pages = []
    for p in range(1, 5):
        pages += [r.order_id for r in search.page(df, p, 7).collect()]
    assert pages == full


def test_pages_by_key_concatenate(spark):
    df = spark.range(23).select(F.col("id").cast("string").alias("order_id"),
                                F.lit("x").alias("order_detail_id"), (F.col("id") % 3).cast("double").alias("score"))
    full, last = [], None
    while rows := search.page_after(df, last, 7).collect():
        full += [r.order_id for r in rows]
        last = (rows[-1].score, rows[-1].order_id, rows[-1].order_detail_id)
    assert full == [r.order_id for r in df.orderBy(*search.ranked(df)).collect()]


def test_sale_report_parts_agree(spark):
    from shoplens.plans import registry as R
    sf = "/root/testdata/sf0.01"
    idx = R.sale_index(spark, sf)
    rep = search.sale_report(idx, R.SEARCH_DATE, R.SEARCH_KEYWORD, 2, 5, materialize="checkpoint")
    assert rep["total"].first()["total"] == 8
    assert rep["detail"].count() == 3
    assert sum(r.value for r in rep["gender"].collect()) == 8
    assert sum(r.value for r in rep["age"].collect()) == 8


def test_counts_from_startups_equal_counts_from_dau_table(spark):
    from shoplens.operators import dau as dau_ops
    from shoplens.sources import testdata as td
    st = td.startup_log(spark, "/root/testdata/sf0.001")
    table = dau_ops.daily_actives(st)
    pairs = [(dau_ops.dau_by_date(table), dau_ops.dau_by_date_from_startups(st)),
             (dau_ops.dau_by_hour(table), dau_ops.dau_by_hour_from_startups(st)),
             (dau_ops.new_devices_by_date(table), dau_ops.new_devices_from_startups(st)),
             (reports.kpi_panel(table, st.limit(0).select(F.lit("x").alias("create_date"),
                                                          F.lit("1").alias("total_amount"))),
              reports.kpi_panel_from_startups(st, st.limit(0).select(F.lit("x").alias("create_date"),
                                                                     F.lit("1").alias("total_amount"))))]
    for a, b in pairs:
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
