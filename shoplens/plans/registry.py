"""Runnable queries over the driver's tables: name -> (spark, sf_dir) -> DataFrame.

Each query reads whole tables; parameters (dates, keyword, window geometry)
are the ones that make results non-trivial on the test data.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.config import in_turn, scratch_path, shuffles_dropped, turns
from shoplens.functions import parse, timeparts
from shoplens.operators import alerts as alert_ops
from shoplens.operators import dau as dau_ops
from shoplens.operators import dedup
from shoplens.operators import orders as order_ops
from shoplens.operators import routing, sales, search
from shoplens.operators.joins import bounded_broadcast
from shoplens.operators.paging import RankedPages
from shoplens.operators.postings import SearchIndex
from shoplens.plans import reports
from shoplens.sources import testdata as td
from shoplens.streaming import sinks

# Parameters of the registered queries.
DAU_DATE = "2024-01-15"
ORDER_DATE = "1996-09-17"
ALERT_LENGTH, ALERT_SLIDE, ALERT_MIN_ACCOUNTS = "6 hours", "1 hour", 3
ALERT_THROTTLE = "1 day"
JOIN_BOUND = "30 days"
AS_OF = "2020-08-25"
USERS_CUT = "1995-06-01 00:00:00"
SEARCH_DATE, SEARCH_KEYWORD, SEARCH_PAGE, SEARCH_SIZE = "1996-09-17", "red", 1, 5
SEARCH_TWO_TOKENS, SEARCH_DEEP_PAGE = "red widget", 200
SHORT_LENGTH, SHORT_SLIDE, SHORT_MIN_ACCOUNTS, SHORT_THROTTLE = "5 minutes", "6 seconds", 2, "1 minute"

Query = Callable[[SparkSession, str], DataFrame]


# --- building blocks ---------------------------------------------------------

def dau_table(spark, sf) -> DataFrame:
    return dau_ops.daily_actives(td.startup_log(spark, sf))


def dau_table_for_days(spark, sf, first: str, last: str) -> DataFrame:
    """DAU rows of whole days only. ``log_date`` is the UTC date of
    ``event_time`` and part of the dedup key, so restricting the raw rows to
    those days is exact, and the range reaches the Parquet scan."""
    startups = td.startup_log(spark, sf).where(timeparts.day_range("event_time", first, last))
    return dau_ops.daily_actives(startups)


def order_table(spark, sf) -> DataFrame:
    return parse.ingest_orders(td.raw_order_info(spark, sf))


def _alert_args():
    return dict(length=ALERT_LENGTH, slide=ALERT_SLIDE)


def panes(spark, sf) -> DataFrame:
    return alert_ops.pane_table(td.event_log(spark, sf), ALERT_SLIDE)


def alert_table(spark, sf) -> DataFrame:
    return alert_ops.coupon_alerts(panes(spark, sf), min_accounts=ALERT_MIN_ACCOUNTS, **_alert_args())


def short_alert_table(spark, sf) -> DataFrame:
    """The reference's geometry: 50 windows an event."""
    parts = alert_ops.pane_table(td.event_log(spark, sf), SHORT_SLIDE)
    return alert_ops.coupon_alerts(parts, SHORT_LENGTH, SHORT_SLIDE, SHORT_MIN_ACCOUNTS)


def _alert_out(df: DataFrame) -> DataFrame:
    return df.select("mid", "window_start", "window_end", "coupon_accounts", "n_events")


def sale_index(spark, sf, bound=None) -> DataFrame:
    """The wide sales table the search runs over (every order line)."""
    return sales.sale_wide(order_table(spark, sf), td.order_detail(spark, sf),
                           td.user_info(spark, sf), AS_OF, bound=bound)


def sale_index_for_day(spark, sf, date: str) -> DataFrame:
    """The wide rows of one day: the order date's range reaches the scan."""
    info = td.raw_order_info(spark, sf).where(timeparts.day_range("order_ts", timeparts.previous_day(date), date))
    return sales.sale_wide(parse.ingest_orders(info), td.order_detail(spark, sf), td.user_info(spark, sf), AS_OF, bound=None)


#: Where this session has stored the wide table and its index, by application and input folder.
_STORED: dict[tuple[str, str], str] = {}


def stored_sales(spark, sf) -> tuple[DataFrame, SearchIndex]:
    """The wide table in order of day and its inverted index, written by the first query that asks and read by
    all of the session: a search neither joins nor sorts the sales again. Large tables are joined in turns by
    order, each in order of day, so that only one turn's shuffle files are on the disks."""
    key = (spark.sparkContext.applicationId, sf)
    path = _STORED.get(key)
    if path is None:
        path = scratch_path(spark, "sales")
        orders, details, users = order_table(spark, sf), td.order_detail(spark, sf), td.user_info(spark, sf)
        k = turns(orders, details)
        for i in range(k):
            table = sales.sale_wide(in_turn(orders, ["id"], i, k), in_turn(details, ["order_id"], i, k), users, AS_OF, bound=None)
            with shuffles_dropped(spark):
                table.repartitionByRange("dt").sortWithinPartitions("dt").write.mode("append").option("compression", "zstd").parquet(f"{path}/table")
        SearchIndex(spark, f"{path}/index").update(spark.read.schema(table.schema).parquet(f"{path}/table"), 0)
        _STORED[key] = path
    return spark.read.parquet(f"{path}/table"), SearchIndex(spark, f"{path}/index")


def _with_rows(spark, sf, hits: DataFrame) -> DataFrame:
    """The wide rows of a page's hits, looked up in the files of their days; a page is small."""
    table, _ = stored_sales(spark, sf)
    keys = spark.createDataFrame(hits.select("dt", *search.TIE_BREAK, "score").collect(), "dt string, order_id string, order_detail_id string, score double")
    days = [r[0] for r in keys.select("dt").distinct().collect()]
    return table.where(F.col("dt").isin(days)).join(bounded_broadcast(keys), ["dt", *search.TIE_BREAK]).select(*table.columns, "score")


def _search_matches(spark, sf) -> DataFrame:
    return search.search(sale_index_for_day(spark, sf, SEARCH_DATE), SEARCH_DATE, SEARCH_KEYWORD)


# --- queries -------------------------------------------------------------------

def q_dau_dedup(spark, sf):
    return dau_table(spark, sf)


def q_dau_total(spark, sf):
    return dau_ops.dau_by_date_from_startups(td.startup_log(spark, sf))


def q_dau_hourly(spark, sf):
    return dau_ops.dau_by_hour_from_startups(td.startup_log(spark, sf))


def q_dau_for_date(spark, sf):
    return dau_ops.dau_for_date(dau_table_for_days(spark, sf, DAU_DATE, DAU_DATE), DAU_DATE)


def q_new_devices(spark, sf):
    return dau_ops.new_devices_from_startups(td.startup_log(spark, sf))


def q_order_mask(spark, sf):
    return order_table(spark, sf).drop("order_ts")


def q_order_amount_total(spark, sf):
    return order_ops.amount_by_date(td.order_amounts(spark, sf))


def q_order_amount_hourly(spark, sf):
    return order_ops.amount_by_hour(td.order_amounts(spark, sf))


def q_order_amount_for_date(spark, sf):
    return order_ops.amount_for_date(td.order_amounts(spark, sf, ORDER_DATE, ORDER_DATE), ORDER_DATE)


def q_order_amount_empty_day(spark, sf):
    """A day without orders: 0, not null."""
    return order_ops.amount_for_date(td.order_amounts(spark, sf, DAU_DATE, DAU_DATE), DAU_DATE)


def q_sales_by_province(spark, sf):
    return order_ops.amount_by_province(order_table(spark, sf))


def q_hourly_compare_dau(spark, sf):
    days = dau_table_for_days(spark, sf, timeparts.previous_day(DAU_DATE), DAU_DATE)
    return reports.realtime_hour("dau", days, DAU_DATE)


def q_hourly_compare_amount(spark, sf):
    days = td.order_amounts(spark, sf, timeparts.previous_day(ORDER_DATE), ORDER_DATE)
    return reports.realtime_hour("order_amount", days, ORDER_DATE)


def q_kpi_panel(spark, sf):
    return reports.kpi_panel_from_startups(td.startup_log(spark, sf), td.order_amounts(spark, sf))


def _kpi_panel_of_day(spark, sf, date):
    startups = td.startup_log(spark, sf)
    one_day = startups.where(timeparts.day_range("event_time", date, date))
    return reports.kpi_panel_of_day(one_day, startups, td.order_amounts(spark, sf, date, date), date)


def q_kpi_panel_for_date(spark, sf):
    return _kpi_panel_of_day(spark, sf, DAU_DATE)


def q_kpi_panel_order_day(spark, sf):
    """A day that has orders."""
    return _kpi_panel_of_day(spark, sf, ORDER_DATE)


def q_coupon_alerts_5min(spark, sf):
    return _alert_out(short_alert_table(spark, sf))


def q_coupon_alerts_5min_throttled(spark, sf):
    t = alert_ops.throttle_alerts(short_alert_table(spark, sf), every=SHORT_THROTTLE)
    return t.select("doc_id", "mid", "window_start", "window_end", "coupon_accounts", "n_events")


def q_order_rejects(spark, sf):
    _, rejects = parse.order_infos(td.flawed_order_messages(spark, sf))
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


def q_coupon_alert_windows(spark, sf):
    w = alert_ops.alert_windows(panes(spark, sf), **_alert_args())
    return w.select("mid", "window_start", "window_end", "coupon_accounts", "n_events", "clicked")


def q_coupon_alerts(spark, sf):
    return _alert_out(alert_table(spark, sf))


def q_coupon_alerts_throttled(spark, sf):
    t = alert_ops.throttle_alerts(alert_table(spark, sf), every=ALERT_THROTTLE)
    return t.select("doc_id", "mid", "window_start", "window_end", "coupon_accounts", "n_events")


def q_coupon_alert_accounts(spark, sf):
    parts = panes(spark, sf)
    return alert_ops.alert_accounts(parts, alert_ops.coupon_alerts(parts, **_alert_args(), min_accounts=ALERT_MIN_ACCOUNTS), **_alert_args())


def q_coupon_alert_items(spark, sf):
    ev = td.event_log(spark, sf)
    return alert_ops.alert_items(ev, alert_table(spark, sf), **_alert_args()).withColumnRenamed("itemId", "item_id")


def q_coupon_alert_events(spark, sf):
    ev = td.event_log(spark, sf)
    return alert_ops.alert_events(ev, alert_table(spark, sf), **_alert_args()).withColumnRenamed("eventId", "event_name")


def q_sale_wide(spark, sf):
    return sale_index(spark, sf, bound=JOIN_BOUND)


def q_sale_wide_unbounded(spark, sf):
    return sale_index(spark, sf, bound=None)


def q_sale_wide_as_of(spark, sf):
    """Each line with the user's row that was valid when the order was created."""
    pairs = sales.sale_rows(sales.join_orders_details(order_table(spark, sf), td.order_detail(spark, sf), None))
    return sales.enrich_users_as_of(pairs, td.user_versions(spark, sf), AS_OF)


def q_sale_pairs_full(spark, sf):
    pairs = sales.full_pairs(order_table(spark, sf), td.order_detail(spark, sf), bound=None)
    return pairs.select(F.col("order_id"), F.col("detail_order_id"),
                        F.col("detail_id").alias("order_detail_id"))


def q_sale_search_total(spark, sf):
    return search.total(_search_matches(spark, sf))


def _hits(spark, sf, date=SEARCH_DATE) -> DataFrame:
    return stored_sales(spark, sf)[1].search(SEARCH_KEYWORD, date)


def _page_rows(spark, sf, hits) -> DataFrame:
    rows = _with_rows(spark, sf, hits).withColumn("score", F.round("score", 6))
    return rows


def q_sale_search_page(spark, sf):
    return _page_rows(spark, sf, search.page(_hits(spark, sf), SEARCH_PAGE, SEARCH_SIZE))


def q_sale_search_page2(spark, sf):
    """The second page, by the keys of the first page's last row."""
    m = _hits(spark, sf)
    first = search.page(m, 1, SEARCH_SIZE).collect()  # one page
    last = (first[-1].score, *[first[-1][c] for c in search.TIE_BREAK]) if len(first) == SEARCH_SIZE else None
    return _page_rows(spark, sf, search.page_after(m, last, SEARCH_SIZE) if last else m.limit(0))


def q_sale_search_deep_page(spark, sf):
    """A page far down, over all days: the files of the one or two ranges it lies in."""
    m = _hits(spark, sf, None)
    pages = RankedPages(m, search.ranked(m), scratch_path(spark, "ranked"))
    return pages.page(SEARCH_DEEP_PAGE, SEARCH_SIZE).select(*search.TIE_BREAK, "dt", "sku_name", F.round("score", 6).alias("score"))


def q_sale_search_two_tokens(spark, sf):
    m = search.search(sale_index_for_day(spark, sf, SEARCH_DATE), SEARCH_DATE, SEARCH_TWO_TOKENS)
    return m.select("order_id", "order_detail_id", "sku_name")


def q_sale_report_json(spark, sf):
    """The whole search answer as one JSON text; only its fixed parts are compared."""
    answer = search.report_json(search.sale_report(stored_sales(spark, sf)[0], SEARCH_DATE, SEARCH_KEYWORD, 1, SEARCH_SIZE))
    j = F.from_json("answer", "total long, stat array<struct<title:string,options:array<struct<name:string,value:long>>>>, "
                              "detail array<struct<order_id:string,order_detail_id:string>>")
    return answer.select(j.alias("j")).select(
        F.col("j.total").alias("total"), F.explode("j.stat").alias("s"),
        F.array_join(F.col("j.detail.order_detail_id"), ",").alias("detail_ids")).select(
        "total", "detail_ids", "s.title", F.explode("s.options").alias("o")).select("total", "detail_ids", "title", "o.name", "o.value")


def q_sale_search_bm25(spark, sf):
    """Every match with its score, from the postings alone."""
    return _hits(spark, sf, None).select("order_id", "order_detail_id", "dt", "sku_name", F.round("score", 6).alias("score"))


def q_sale_gender_stats(spark, sf):
    return search.gender_stats(_search_matches(spark, sf)).withColumn("share", F.round("share", 6))


def q_sale_age_stats(spark, sf):
    return search.age_stats(_search_matches(spark, sf)).withColumn("share", F.round("share", 6))


def q_age_terms_top(spark, sf):
    return search.terms(sale_index(spark, sf), "user_age", 100).withColumnRenamed("n", "value")


def q_cdc_insert_route(spark, sf):
    return routing.route_changes(td.change_feed(spark, sf))


def q_log_route_substring(spark, sf):
    """Routing by the text itself: lines that contain the word, in whatever field."""
    return routing.route_logs(td.raw_logs(spark, sf), mode="substring").groupBy("topic").agg(F.count("*").alias("n"))


def q_user_ages_today(spark, sf):
    """Ages as of the day the query runs."""
    users = parse.typed_users(td.user_info(spark, sf).withColumn("birthday", F.col("birthday").cast("string")))
    return users.select("id", sales.age_years(F.col("birthday"), None).alias("age"))


def q_append_generated_ids(spark, sf):
    """Alerts appended in two batches, the second one run twice, and a single document; each row has an id."""
    path = scratch_path(spark, "appended")
    write = sinks.batch_writer(path, transform=sinks.with_generated_id())
    rows = alert_table(spark, sf)
    half = F.pmod(F.xxhash64("mid", "w"), F.lit(2))
    write(rows.where(half == 0), 0)
    for _ in range(2):
        write(rows.where(half == 1), 1)
    write(rows.orderBy("mid", "w").limit(1), 2)
    return sinks.read_batches(spark, path).agg(F.count("*").alias("n_rows"), F.count_distinct("doc_id").alias("n_ids"))


def q_log_route(spark, sf):
    routed = routing.route_logs(td.raw_logs(spark, sf))
    j = F.from_json("value", "logType string, mid string, uid string, eventId string, itemId string, ts long")
    return routed.select("topic", "event_id", j.alias("j")).select(
        "topic", "event_id", "j.logType", "j.mid", "j.uid", "j.eventId", "j.itemId", "j.ts")


def q_upsert_latest(spark, sf):
    li = td.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    return dedup.keep_last(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


QUERIES: dict[str, Query] = {
    "dau_dedup": q_dau_dedup,
    "dau_total": q_dau_total,
    "dau_hourly": q_dau_hourly,
    "dau_for_date": q_dau_for_date,
    "new_devices": q_new_devices,
    "order_mask": q_order_mask,
    "order_amount_total": q_order_amount_total,
    "order_amount_hourly": q_order_amount_hourly,
    "order_amount_for_date": q_order_amount_for_date,
    "sales_by_province": q_sales_by_province,
    "hourly_compare_dau": q_hourly_compare_dau,
    "hourly_compare_amount": q_hourly_compare_amount,
    "kpi_panel": q_kpi_panel,
    "kpi_panel_for_date": q_kpi_panel_for_date,
    "kpi_panel_order_day": q_kpi_panel_order_day,
    "order_amount_empty_day": q_order_amount_empty_day,
    "order_rejects": q_order_rejects,
    "coupon_alerts_5min": q_coupon_alerts_5min,
    "coupon_alerts_5min_throttled": q_coupon_alerts_5min_throttled,
    "sale_search_page2": q_sale_search_page2,
    "sale_search_two_tokens": q_sale_search_two_tokens,
    "sale_report_json": q_sale_report_json,
    "coupon_alert_windows": q_coupon_alert_windows,
    "coupon_alerts": q_coupon_alerts,
    "coupon_alerts_throttled": q_coupon_alerts_throttled,
    "coupon_alert_accounts": q_coupon_alert_accounts,
    "coupon_alert_items": q_coupon_alert_items,
    "coupon_alert_events": q_coupon_alert_events,
    "sale_wide": q_sale_wide,
    "sale_wide_unbounded": q_sale_wide_unbounded,
    "sale_wide_as_of": q_sale_wide_as_of,
    "sale_search_deep_page": q_sale_search_deep_page,
    "log_route_substring": q_log_route_substring,
    "user_ages_today": q_user_ages_today,
    "append_generated_ids": q_append_generated_ids,
    "sale_pairs_full": q_sale_pairs_full,
    "sale_search_total": q_sale_search_total,
    "sale_search_page": q_sale_search_page,
    "sale_search_bm25": q_sale_search_bm25,
    "sale_gender_stats": q_sale_gender_stats,
    "sale_age_stats": q_sale_age_stats,
    "age_terms_top": q_age_terms_top,
    "cdc_insert_route": q_cdc_insert_route,
    "log_route": q_log_route,
    "upsert_latest": q_upsert_latest,
}
