"""The application's inputs expressed as views over the driver's tables.

``events`` stands in for the startup and event logs; ``orders`` joined with
``customer`` for order_info; ``lineitem`` joined with ``part`` for
order_detail; ``customer`` for user_info. Every expression exists in both
Spark and DuckDB, so the oracle SQL can build the same views.

Each view selects only the columns it needs, so the Parquet scan reads only
those (``ReadSchema`` in ``explain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.functions import timeparts

# --- fixed values: how ``events.event_type`` maps onto the event-log ids ---
EVENT_NAMES = [
    ("purchase", "coupon"),
    ("click", "clickItem"),
    ("view", "addCart"),
    ("signup", "addComment"),
    ("error", "addFavor"),
]
DEVICES_PER_ACCOUNT_GROUP = 25  # event_log: mid = 'mid_' || (user_id % 25)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _event_name(c) -> F.Column:
    expr = None
    for src, dst in EVENT_NAMES:
        expr = (F.when(F.col(c) == src, F.lit(dst)) if expr is None
                else expr.when(F.col(c) == src, F.lit(dst)))
    return expr


def startup_log_from(events: DataFrame) -> DataFrame:
    """Startup log rows: one per event; device = user."""
    return (events.select(
                "event_id",
                F.concat(F.lit("mid_"), _s("user_id")).alias("mid"),
                F.concat(F.lit("uid"), _s("user_id")).alias("uid"),
                F.lit("startup").alias("log_type"),
                timeparts.ntz_to_epoch_millis("ts").alias("ts"),
                F.col("ts").alias("event_time"))
            .withColumn("log_date", timeparts.date_string("event_time"))
            .withColumn("log_hour", timeparts.hour_string("event_time")))


def startup_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return startup_log_from(table(spark, sf_dir, "events"))


def event_log_from(events: DataFrame) -> DataFrame:
    """Event log rows: 25 shared devices, so accounts collide on devices."""
    return (events.select(
                "event_id",
                F.concat(F.lit("mid_"), _s(F.col("user_id") % DEVICES_PER_ACCOUNT_GROUP)).alias("mid"),
                F.concat(F.lit("uid"), _s("user_id")).alias("uid"),
                F.lit("event").alias("log_type"),
                _event_name("event_type").alias("eventId"),
                F.get_json_object("props", "$.k").alias("itemId"),
                timeparts.ntz_to_epoch_millis("ts").alias("ts"),
                F.col("ts").alias("event_time"))
            .withColumn("log_date", timeparts.date_string("event_time"))
            .withColumn("log_hour", timeparts.hour_string("event_time")))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log_from(table(spark, sf_dir, "events"))


def raw_order_info_from(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """order_info as it arrives on the change feed: all values strings.

    ``order_ts`` is the message's event time (the order date);
    ``create_time`` adds ``o_orderkey % 24`` hours so every hour occurs.
    """
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = customers.select("c_custkey", "c_name", "c_nationkey")
    created = F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate"))
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        _s("o_orderkey").alias("id"),
        _s("c_nationkey").alias("province_id"),
        F.col("c_name").alias("consignee"),
        F.concat(F.lit("13"), F.lpad(_s("c_custkey"), 9, "0")).alias("consignee_tel"),
        F.col("o_orderstatus").alias("order_status"),
        _s("o_custkey").alias("user_id"),
        _s(F.col("o_totalprice").cast(schemas.MONEY)).alias("total_amount"),
        F.date_format(created, "yyyy-MM-dd HH:mm:ss").alias("create_time"),
        F.col("o_orderdate").alias("order_ts"))


def order_amounts(spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """What amount reports need of the orders (id, total_amount, create_date,
    create_hour), without the customer. With ``first`` and ``last`` only orders
    created on these days: the order date lies less than a day before the
    creation, and its range reaches the scan."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    if first is not None:
        o = o.where(timeparts.day_range("o_orderdate", timeparts.previous_day(first), last))
    created = F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate"))
    out = o.select(_s("o_orderkey").alias("id"), F.col("o_totalprice").cast(schemas.MONEY).alias("total_amount"),
                   F.date_format(created, "yyyy-MM-dd").alias("create_date"), F.date_format(created, "HH").alias("create_hour"))
    return out if first is None else out.where(F.col("create_date").between(first, last))


def raw_order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_order_info_from(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def order_detail_from(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """order_detail rows, all strings; ``detail_ts`` = ship date.

    (orderkey, linenumber) is not unique in lineitem, so the detail id is
    orderkey:linenumber:partkey:suppkey.
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                         "l_quantity", "l_extendedprice", "l_shipdate")
    p = part.select("p_partkey", "p_name")
    return li.join(p, li.l_partkey == p.p_partkey, "inner").select(
        F.concat_ws(":", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey")).alias("id"),
        _s("l_orderkey").alias("order_id"),
        F.col("p_name").alias("sku_name"),
        _s("l_partkey").alias("sku_id"),
        _s(F.col("l_extendedprice").cast(schemas.MONEY)).alias("order_price"),
        _s(F.col("l_quantity").cast("int")).alias("sku_num"),
        F.col("l_shipdate").alias("detail_ts"))


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_detail_from(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"))


def user_info_from(customers: DataFrame) -> DataFrame:
    """user_info rows; gender M for even keys, birthday spread over ~55 years."""
    c = customers.select("c_custkey", "c_name", "c_mktsegment")
    return c.select(
        _s("c_custkey").alias("id"),
        F.col("c_name").alias("login_name"),
        F.col("c_mktsegment").alias("user_level"),
        F.date_add(F.lit("1955-01-01").cast("date"),
                   ((F.col("c_custkey") * 37) % 20000).cast("int")).alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"))


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_info_from(table(spark, sf_dir, "customer"))


def user_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User rows over time: as of 1992 with the customer's segment as level, and anew with the priority of
    each fourth order (by key) from that order on."""
    users = user_info(spark, sf_dir)
    first = users.withColumn("valid_from", F.lit("1992-01-01 00:00:00").cast("timestamp_ntz"))
    o = table(spark, sf_dir, "orders").where("o_orderkey % 4 = 0").select(
        _s("o_custkey").alias("id"), F.col("o_orderpriority").alias("_level"),
        F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate").cast("timestamp_ntz")).alias("valid_from"))
    changed = users.join(o, "id").withColumn("user_level", F.col("_level")).select(*first.columns)
    return first.unionByName(changed)


# --- messages as the topics carry them: (value, received_ts) ---------------------

def startup_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Startup logs as JSON with all fields; those without a source are derived
    from the user id."""
    u = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.to_json(F.struct(
            F.concat(F.lit("mid_"), _s(u)).alias("mid"), F.concat(F.lit("uid"), _s(u)).alias("uid"),
            F.lit("app").alias("appId"), F.concat(F.lit("area_"), _s(u % 34)).alias("area"),
            F.when(u % 2 == 0, "ios").otherwise("android").alias("os"), F.concat(F.lit("ch_"), _s(u % 10)).alias("channel"),
            F.lit("startup").alias("logType"), F.concat(F.lit("1."), _s(u % 5)).alias("version"),
            timeparts.ntz_to_epoch_millis("ts").alias("ts"))).alias("value"),
        timeparts.ntz_to_epoch_millis("ts").alias("received_ts"))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select(
        F.to_json(F.struct("mid", "uid", F.lit("event").alias("logType"), "eventId", "itemId", "ts")).alias("value"),
        F.col("ts").alias("received_ts"))


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_info rows as JSON; the message's time is the order date."""
    return raw_order_info(spark, sf_dir).select(
        F.to_json(F.struct(*ORDER_ROW_COLUMNS)).alias("value"), timeparts.ntz_to_epoch_millis("order_ts").alias("received_ts"))


def detail_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_detail rows as JSON; the message's time is the ship date."""
    d = order_detail(spark, sf_dir)
    fields = [c for c in d.columns if c != "detail_ts"]
    return d.select(F.to_json(F.struct(*fields)).alias("value"), timeparts.ntz_to_epoch_millis("detail_ts").alias("received_ts"))


def flawed_order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order messages of which some are spoilt, by order key modulo 50."""
    k = F.col("id").cast("long") % 50
    o = raw_order_info(spark, sf_dir)
    o = (o.withColumn("k", k).withColumn("total_amount", F.when(F.col("k") == 0, "abc").otherwise(F.col("total_amount")))
         .withColumn("create_time", F.when(F.col("k") == 1, "2020").otherwise(F.col("create_time")))
         .withColumn("consignee", F.when(F.col("k") != 2, F.col("consignee"))))
    text = F.to_json(F.struct(*ORDER_ROW_COLUMNS))
    text = F.when(F.col("k") == 3, F.substring(text, 1, 20)).when(F.col("k") == 4, F.lit(None)).otherwise(text)
    return o.select(text.alias("value"), F.lit(0).cast("long").alias("received_ts"))


ORDER_ROW_COLUMNS = ["id", "province_id", "consignee", "consignee_tel", "order_status", "user_id",
                     "total_amount", "create_time"]


def _pairs(*name_cols) -> F.Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), c.alias("value")).cast(schemas.COLUMN_VALUE)
                     for n, c in name_cols])


def change_feed_from(orders: DataFrame, lineitem: DataFrame, customers: DataFrame) -> DataFrame:
    """A binlog-style change feed derived from the tables.

    Every order is an INSERT of ``order_info`` carrying the full row image
    (the columns of ``raw_order_info``); fulfilled orders ('F') also
    carry an UPDATE and pending ones ('P') a DELETE; each order also closes a
    transaction (a non-row entry). Every line is an INSERT of
    ``order_detail``; every customer an INSERT of ``user_info`` (a table the
    router ignores); returned lines ('R') add an INSERT with no rows.
    """
    info = raw_order_info_from(orders, customers)
    order_row = _pairs(*[(c, F.col(c)) for c in ORDER_ROW_COLUMNS])
    ops = F.array(
        F.struct(F.lit("ROWDATA").alias("entry_type"), F.lit("INSERT").alias("op"), F.lit(True).alias("has_rows")),
        F.when(F.col("o_orderstatus") == "F", F.struct(
            F.lit("ROWDATA").alias("entry_type"), F.lit("UPDATE").alias("op"), F.lit(True).alias("has_rows"))),
        F.when(F.col("o_orderstatus") == "P", F.struct(
            F.lit("ROWDATA").alias("entry_type"), F.lit("DELETE").alias("op"), F.lit(True).alias("has_rows"))),
        F.struct(F.lit("TRANSACTIONEND").alias("entry_type"), F.lit(None).cast("string").alias("op"),
                 F.lit(False).alias("has_rows")))
    empty_rows = F.array().cast("array<array<struct<name:string,value:string>>>")
    order_entries = (info.select(order_row.alias("row"), F.col("order_status").alias("o_orderstatus"))
                     .select("row", F.explode(ops).alias("e"))
                     .where(F.col("e").isNotNull())
                     .select(F.lit("order_info").alias("table"),
                             F.col("e.entry_type").alias("entry_type"), F.col("e.op").alias("op"),
                             F.when(F.col("e.has_rows"), F.array(F.col("row"))).otherwise(empty_rows).alias("rows")))
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         "l_extendedprice", "l_quantity", "l_returnflag")
    detail_row = _pairs(
        ("id", F.concat_ws(":", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"), _s("l_suppkey"))),
        ("order_id", _s("l_orderkey")), ("sku_id", _s("l_partkey")),
        ("order_price", _s(F.col("l_extendedprice").cast(schemas.MONEY))),
        ("sku_num", _s(F.col("l_quantity").cast("int"))))
    detail_entries = li.select(
        F.lit("order_detail").alias("table"), F.lit("ROWDATA").alias("entry_type"),
        F.lit("INSERT").alias("op"), F.array(detail_row).alias("rows"))
    returned_empty = li.where(F.col("l_returnflag") == "R").select(
        F.lit("order_detail").alias("table"), F.lit("ROWDATA").alias("entry_type"),
        F.lit("INSERT").alias("op"), empty_rows.alias("rows"))
    c = customers.select("c_custkey", "c_name")
    user_entries = c.select(
        F.lit("user_info").alias("table"), F.lit("ROWDATA").alias("entry_type"), F.lit("INSERT").alias("op"),
        F.array(_pairs(("id", _s("c_custkey")), ("login_name", F.col("c_name")))).alias("rows"))
    return order_entries.unionByName(detail_entries).unionByName(returned_empty).unionByName(user_entries)


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_feed_from(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
                            table(spark, sf_dir, "customer"))


def raw_logs_from(events: DataFrame) -> DataFrame:
    """Client log lines as the collector receives them (no ``ts`` yet): one
    startup line and one event line per event row, plus ``received_ts``, the
    arrival time the collector stamps (the event's own time)."""
    st = startup_log_from(events).select(
        F.to_json(F.struct(F.col("log_type").alias("logType"), "mid", "uid")).alias("value"),
        F.col("ts").alias("received_ts"), "event_id")
    ev = event_log_from(events).select(
        F.to_json(F.struct(F.col("log_type").alias("logType"), "mid", "uid",
                           "eventId", F.col("itemId").cast("int").alias("itemId"))).alias("value"),
        F.col("ts").alias("received_ts"), "event_id")
    return st.unionByName(ev)


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_logs_from(table(spark, sf_dir, "events"))
