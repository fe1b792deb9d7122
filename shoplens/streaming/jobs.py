"""Streaming jobs: DAU, order ingestion, coupon alerts, sales wide table,
change-feed routing and log collection.

A job's state is its stored tables (``state.DayTable``), not a watermark: each micro-batch is
compared with what earlier batches stored for the days it touches, so no row
is dropped however late or in whatever order it arrives. A batch writes only
its own folders (overwritten by a replay), reads only batches below its own, and
opens the files of its days only. Batches are written out first and joined from there with
the job's own session, where AQE splits hot keys. Messages that cannot be parsed go to a
rejects folder. ``layout``: arguments of the job's tables (``span``, ``fold_every``, ``grace``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoplens import schemas
from shoplens.functions import parse
from shoplens.functions.timeparts import bucket_index, interval_micros, ntz_to_epoch_micros
from shoplens.operators import alerts as alert_ops
from shoplens.operators import dau as dau_ops
from shoplens.operators import routing, sales
from shoplens.operators.dedup import keep_first, keep_last
from shoplens.sources.tables import lookup_by_ids
from shoplens.streaming import counters, sinks
from shoplens.streaming.counters import count_store
from shoplens.streaming.state import DayTable

DEFAULT_TRIGGER = {"processingTime": "3 seconds"}
#: Called with the messages and ``keep`` (see ``parse``).
Parser = Callable[..., tuple[DataFrame, DataFrame]]


def _write_rejects(rejects: DataFrame, path: str, batch_id: int) -> None:
    rejects.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


@contextmanager
def _parsed(parser: Parser, messages: DataFrame) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Rows and rejects of ``messages``, which are read and parsed once, whatever reads the two. They are kept on the
    executors' disks: a batch may be large, and the memory is for the sorts of what reads it."""
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist(StorageLevel.DISK_ONLY))
        return kept[-1]

    try:
        yield parser(messages, keep=keep)
    finally:
        for df in kept:
            df.unpersist()


def _start(raw: DataFrame, write, checkpoint: str, trigger: dict | None, name: str) -> StreamingQuery:
    return sinks.start_foreach(raw, write, checkpoint, "append", trigger or DEFAULT_TRIGGER, name)


# --- daily actives -----------------------------------------------------------

def dau_store(spark: SparkSession, path: str, **layout) -> DayTable:
    return DayTable(spark, path, "LOG_DATE", lambda t: keep_first(t, ["LOG_DATE", "MID"], ["TS"]), ["LOG_DATE", "MID"], **layout)


def start_dau(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
              parser: Parser = parse.startup_logs, keep: str = "arrival", layout: dict | None = None,
              counts: bool = False) -> StreamingQuery:
    """Keep one startup per (date, device) in the 11-column table, names upper-cased.

    A batch is reduced to its earliest row per key (a partial aggregate, so a
    busy device is one row per task) and compared with the stored rows of its
    days. ``keep='arrival'`` adds keys not stored yet; ``keep='earliest'`` also
    adds a row earlier than the stored one, which ``read_dau`` then returns.
    ``counts``: also keep the counts by day and hour (``dau_counts``).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        store = dau_store(batch.sparkSession, path, **(layout or {}))
        with _parsed(parser, batch) as (rows, rejects):
            _write_rejects(rejects, f"{path}_rejects", batch_id)
            table = rows.select(*[F.col(c).alias(c.upper()) for c in schemas.DAU_TABLE])
            first = keep_first(table, store.keys, ["TS"]).persist()
            stored = store.rows(store.days(first), before=batch_id)
            out = first.withColumn("_hour", F.lit(None).cast("string"))
            if stored is not None:
                earliest = F.min(F.struct("TS", "LOG_HOUR"))
                known = stored.groupBy(*store.keys).agg(earliest.alias("_k")).select(*store.keys, F.col("_k.TS").alias("_ts"), F.col("_k.LOG_HOUR").alias("_hour"))
                new = F.col("_ts").isNull()
                out = first.join(known, store.keys, "left").where(new | (F.col("TS") < F.col("_ts")) if keep == "earliest" else new)
            if counts:
                out = out.persist()
            store.write(out.select(*first.columns), batch_id)
            if counts:
                counters.add(count_store(batch.sparkSession, path, **(layout or {})), store, counters.first_rows(out), batch_id,
                             "LOG_DATE", "LOG_HOUR")
                out.unpersist()
            first.unpersist()
    return _start(raw, write, checkpoint, trigger, "dau")


def read_dau(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """The DAU table (of ``days``) with lower-case names, one row per (date, device)."""
    return dau_store(spark, path).read(days).select(*[F.col(c.upper()).alias(c) for c in schemas.DAU_TABLE])


def dau_counts(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame | None:
    """(log_date, log_hour, dau) as kept by the job; None while they are behind the table."""
    found = counters.read(count_store(spark, path), dau_store(spark, path), days)
    return None if found is None else found.select(F.col("day").alias("log_date"), F.col("hour").alias("log_hour"), F.col("n").alias("dau"))


# --- orders ------------------------------------------------------------------

#: Which of an order's versions stands: the last change, then the last delivery.
ORDER_VERSION = ["operate_time", "create_time"]


def order_store(spark: SparkSession, path: str, **layout) -> DayTable:
    version = [*(c.upper() for c in ORDER_VERSION), "batch_id"]
    return DayTable(spark, path, "CREATE_DATE", lambda t: keep_last(t, ["ID"], version), ["ID"], **layout)


def start_orders(raw_orders: DataFrame, path: str, rejects_path: str, checkpoint: str,
                 trigger: dict | None = None, layout: dict | None = None, counts: bool = False) -> StreamingQuery:
    """Order ingestion: parse, mask, derive date/hour into the 20-column table,
    names upper-cased; malformed rows to a rejects folder in the same batch.
    The table's key is the order id (``read_orders``): a redelivery replaces, an older version does not.
    ``counts``: also keep the amounts by day and hour (``order_counts``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        with _parsed(parse.order_infos, batch) as (rows, rejects):
            rows = keep_last(rows.select(*schemas.ORDER_TABLE), ["id"], ORDER_VERSION)
            upper = rows.select(*[F.col(c).alias(c.upper()) for c in schemas.ORDER_TABLE])
            store = order_store(batch.sparkSession, path, **(layout or {}))
            mine = store.write(upper, batch_id)
            if counts:
                old = store.rows(store.days(mine), before=batch_id)
                version = [*(c.upper() for c in ORDER_VERSION), "batch_id"]
                counters.add(count_store(batch.sparkSession, path, **(layout or {})), store, counters.order_versions(mine, old, version, batch_id),
                             batch_id, "CREATE_DATE", "CREATE_HOUR", "TOTAL_AMOUNT")
            _write_rejects(rejects, rejects_path, batch_id)
    return _start(raw_orders, write, checkpoint, trigger, "orders")


def read_orders(spark: SparkSession, path: str, days: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """The order table (of ``days``; an order's creation day does not change) with lower-case names (those of
    ``columns``): the latest version of each id. A batch has one version of an id, so no other column chooses."""
    names = columns or schemas.ORDER_TABLE
    store = order_store(spark, path)
    return store.read(days, columns=[c.upper() for c in {"id": 1} | dict.fromkeys(ORDER_VERSION) | dict.fromkeys(names)]).select(
        *[F.col(c.upper()).alias(c) for c in names])


def order_counts(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame | None:
    """(create_date, create_hour, order_amount) as kept by the job; None while they are behind the table."""
    found = counters.read(count_store(spark, path), order_store(spark, path), days)
    return None if found is None else found.select(F.col("day").alias("create_date"), F.col("hour").alias("create_hour"),
                                                   F.col("amount").alias("order_amount"))


# --- coupon alerts ---------------------------------------------------------------

def _sum_panes(t: DataFrame) -> DataFrame:
    return t.groupBy("mid", "pane", "uid", "day").agg(F.sum("n").alias("n"), F.max("clicked").alias("clicked"), F.max("batch_id").alias("batch_id"))


def pane_store(spark: SparkSession, path: str, **layout) -> DayTable:
    return DayTable(spark, f"{path}/panes", "day", _sum_panes, ["mid"], **layout)


def alert_store(spark: SparkSession, path: str, **layout) -> DayTable:
    """A window's latest state; those that no longer alert are not part of the table."""
    return DayTable(spark, f"{path}/alerts", "day", lambda t: keep_last(t, ["mid", "w"], ["batch_id"]).where("alerting"), ["mid"], **layout)


def start_alerts(raw: DataFrame, path: str, checkpoint: str, length: str = "5 minutes",
                 slide: str = "6 seconds", min_accounts: int = 3, every: str = "1 minute",
                 trigger: dict | None = None, parser: Parser = parse.event_logs,
                 show: int = 0, layout: dict | None = None) -> StreamingQuery:
    """Alerts, and no other windows, in ``{path}/alerts``; pane partials in ``{path}/panes``.

    A batch adds its pane partials, not its events times the windows they are
    in. Of the devices and panes it touched the windows are worked out again
    from all stored panes of those days, whichever batch brought them. A window that no
    longer alerts (a click came late) is written with ``alerting`` false.
    ``show``: also print so many of the batch's alerts.
    """
    L, S, k = alert_ops._geometry(length, slide)
    per_day = 86_400_000_000 // S

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        panes_of, alerts_of = pane_store(spark, path, **(layout or {})), alert_store(spark, path, **(layout or {}))
        with _parsed(parser, batch) as (events, rejects):
            _write_rejects(rejects, f"{path}/rejects", batch_id)
            new = alert_ops._pane_partials(events, S, "event_time")
            mine = panes_of.write(new.withColumn("day", F.floor(F.col("pane") / per_day).cast("int")), batch_id)
        reach = -(-k // per_day)
        near = sorted({d + i for d in panes_of.days(mine) for i in range(-reach, reach + 1)})
        old = panes_of.rows(near, before=batch_id)
        stored = mine if old is None else mine.unionByName(old.drop("batch_id"))
        # panes that share a window with a touched pane of the device: by device
        # and block of k panes, then merged over batches
        block = F.floor(F.col("pane") / k)
        touched = mine.select("mid", F.explode(F.array(block - 1, block, block + 1)).alias("block")).distinct()
        panes = (stored.withColumn("block", block).join(touched, ["mid", "block"], "left_semi")
                 .groupBy("mid", "pane", "uid").agg(F.sum("n").alias("n"), F.max("clicked").alias("clicked")))
        alerts = alert_ops.in_windows_of(alert_ops.coupon_alerts(panes, length, slide, min_accounts), mine, k)
        alerts = alerts.withColumn("alerting", F.lit(True))
        before = alerts_of.rows(near, before=batch_id)
        if before is not None:
            over = (alert_ops.in_windows_of(alerts_of.fold(before), mine, k).join(alerts, ["mid", "w"], "left_anti")
                    .drop("batch_id", "doc_id", "day").withColumn("alerting", F.lit(False)))
            alerts = alerts.unionByName(over)
        step = interval_micros(every)
        keyed = alerts.withColumn("doc_id", F.concat_ws(
            ":", "mid", bucket_index(ntz_to_epoch_micros("window_end"), step).cast("string")))
        mine = alerts_of.write(keyed.withColumn("day", F.floor(F.col("w") / per_day).cast("int")), batch_id)
        if show:
            mine.where("alerting").drop("day").show(show, truncate=False)
    return _start(raw, write, checkpoint, trigger, "alerts")


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The windows that alert, by their latest state."""
    return alert_store(spark, path).read().drop("alerting", "batch_id", "day")


def read_throttled_alerts(spark: SparkSession, path: str) -> DataFrame:
    """One alert per ``doc_id`` ('mid:bucket'): the latest window wins."""
    return keep_last(read_alerts(spark, path), ["doc_id"], ["window_end", "window_start"])


# --- sales wide table ------------------------------------------------------------

def order_and_detail_messages(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Both topics as one stream of (kind, value, received_ts), so that a
    micro-batch sees orders and lines together."""
    return (orders.select(F.lit("order").alias("kind"), "value", "received_ts")
            .unionByName(details.select(F.lit("detail").alias("kind"), "value", "received_ts")))


#: Pairs whose user is unknown wait in so many parts, by user.
WAITING_PARTS = 64


def _versions(keys: list[str], version: list[str]):
    return lambda t: keep_last(t, keys, [*version, "batch_id"])


def sale_stores(spark: SparkSession, path: str, **layout) -> dict[str, DayTable]:
    """Orders and lines by the day of their event time, wide rows by order day, waiting pairs by part.
    A redelivered message at another time is a version of its own, since it may be in another bound."""
    def waiting(t: DataFrame) -> DataFrame:
        return keep_last(t, ["order_id", "order_detail_id"], ["batch_id", "found"]).where("not found")

    return {
        "orders": DayTable(spark, f"{path}/orders", "day", _versions(["id", "order_ts"], ORDER_VERSION), ["id"], **layout),
        "details": DayTable(spark, f"{path}/details", "day", _versions(["id", "order_id", "detail_ts"], []), ["order_id"], **layout),
        "sales": DayTable(spark, f"{path}/sales", "dt", _versions(["doc_id"], []), ["doc_id"], **layout),
        "waiting": DayTable(spark, f"{path}/waiting", "part", waiting, ["order_id"], **layout | {"span": 1}),
    }


def start_sales(messages: DataFrame, path: str, checkpoint: str,
                read_users: Callable[[DataFrame], DataFrame], as_of: str | None = None,
                bound: str = "30 minutes", trigger: dict | None = None,
                order_time: Column | None = None, detail_time: Column | None = None,
                layout: dict | None = None) -> StreamingQuery:
    """Pairs of orders and lines at most ``bound`` apart, in either order of arrival.

    New orders meet stored and new lines, new lines meet stored orders, of the
    days the bound reaches. ``read_users`` is called once for each batch with the
    pairs to enrich and returns their users as they are then; they are written, and
    all that follows reads that table, so a change of the dimension in between
    loses no pair. With a ``valid_from`` they are versions, of which the one valid when the order was
    created counts. Ages are as of the day of the batch unless ``as_of`` is given.

    Pairs whose user is unknown yet wait in ``{path}/waiting``, in parts by user. A batch tries
    the parts of its own users and one more in turn, so what waits is not read whole by every batch.
    Event time is the message's unless a column of the bound fields is given.
    """
    reach = -(-interval_micros(bound) // 86_400_000_000)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stores = sale_stores(spark, path, **(layout or {}))

        def store(kind: str, rows: DataFrame, time: Column | None) -> DataFrame:
            ts = F.timestamp_millis("received_ts") if time is None else time
            out = rows.withColumn(f"{kind}_ts", ts.cast("timestamp_ntz")).withColumn("day", F.to_date(f"{kind}_ts"))
            return stores[f"{kind}s"].write(out, batch_id)

        with (_parsed(parse.order_infos, batch.where("kind = 'order'").drop("kind")) as (orders, bad_orders),
              _parsed(parse.order_details, batch.where("kind = 'detail'").drop("kind")) as (details, bad_details)):
            new_o, new_d = store("order", orders, order_time), store("detail", details, detail_time)
            _write_rejects(bad_orders.unionByName(bad_details), f"{path}/rejects", batch_id)

        def stored(kind: str, of: DataFrame) -> DataFrame | None:
            """Earlier rows of the days that the bound reaches from those of ``of``."""
            days = {d + dt.timedelta(i) for d in stores[kind].days(of) for i in range(-reach, reach + 1)}
            rows = stores[kind].rows(days, before=batch_id)
            return None if rows is None else rows.drop("batch_id")

        old_d, old_o = stored("details", new_o), stored("orders", new_d)
        pairs = sales.sale_rows(sales.join_orders_details(new_o, new_d if old_d is None else new_d.unionByName(old_d), bound))
        if old_o is not None:
            pairs = pairs.unionByName(sales.sale_rows(sales.join_orders_details(old_o, new_d, bound)))
        part = F.pmod(F.xxhash64("user_id"), F.lit(WAITING_PARTS)).cast("int")
        pairs = _written(pairs.withColumn("part", part), f"{path}/pairs/batch_id={batch_id}")
        parts = {*stores["waiting"].days(pairs), batch_id % WAITING_PARTS}
        waiting = stores["waiting"].rows(parts, before=batch_id)
        tried = pairs
        if waiting is not None:
            waiting = stores["waiting"].fold(waiting).drop("batch_id", "found")
            tried = _written(pairs.unionByName(waiting), f"{path}/tried/batch_id={batch_id}")
        users = _written(read_users(tried), f"{path}/users/batch_id={batch_id}")
        enrich = sales.enrich_users_as_of if "valid_from" in users.columns else sales.enrich_users
        wide = enrich(tried.drop("part"), users, as_of)
        stores["sales"].write(sinks.with_doc_id(sales.SALE_KEY, trailing=":")(wide), batch_id)
        known = users.select(F.col("id").alias("user_id")).distinct()
        still = pairs.join(known, "user_id", "left_anti").withColumn("found", F.lit(False))
        if waiting is not None:
            still = still.unionByName(waiting.join(known, "user_id", "left_semi").withColumn("found", F.lit(True)).select(*still.columns))
        stores["waiting"].write(still.select(*pairs.columns, "found"), batch_id)
    return _start(messages, write, checkpoint, trigger, "sales")


def _written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written (a replay overwrites) and read back: evaluated once, whatever reads it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dimension_lookup(read: Callable[[], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Re-read a dimension for each batch, restricted to the batch's users."""
    return lambda pairs: lookup_by_ids(read(), pairs)


#: Users are kept in so many parts by id.
USER_PARTS = 64


def user_store(spark: SparkSession, path: str, **layout) -> DayTable:
    """Versions of user rows, each once."""
    return DayTable(spark, path, "part", _versions(["id", "valid_from", "user_level", "gender", "birthday"], []), ["id"], **layout | {"span": 1})


def start_users(changes: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, layout: dict | None = None) -> StreamingQuery:
    """Keep every version of the user dimension: rows of ``changes`` (id, login_name, user_level, birthday, gender,
    valid_from), in any order. Rows without an id or a time are rejects."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            whole = F.col("id").isNotNull() & F.col("valid_from").isNotNull()
            typed = parse.typed_users(batch.where(whole)).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(USER_PARTS)).cast("int"))
            user_store(batch.sparkSession, path, **(layout or {})).write(typed, batch_id)
            _write_rejects(batch.where(~whole), f"{path}_rejects", batch_id)
        finally:
            batch.unpersist()
    return _start(changes, write, checkpoint, trigger, "users")


def version_lookup(spark: SparkSession, path: str) -> Callable[[DataFrame], DataFrame]:
    """The stored versions of the users of a batch; only the parts that those ids are in are opened."""
    def lookup(pairs: DataFrame) -> DataFrame:
        store = user_store(spark, path)
        ids = pairs.select("user_id", F.pmod(F.xxhash64("user_id"), F.lit(USER_PARTS)).cast("int").alias("part"))
        return lookup_by_ids(store.read(store.days(ids)), pairs)
    return lookup


def read_sales(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """The wide table (of ``days``): the latest row of each (order, line), however often delivered."""
    return sale_stores(spark, path)["sales"].read(days).select(*[f.name for f in schemas.SALE_DETAIL.fields])


#: What the launcher's ``compact`` folds, by job.
STORES = {
    "dau": lambda spark, path: [count_store(spark, path), dau_store(spark, path)],
    "orders": lambda spark, path: [count_store(spark, path), order_store(spark, path)],
    "alerts": lambda spark, path: [pane_store(spark, path), alert_store(spark, path)],
    "sales": lambda spark, path: list(sale_stores(spark, path).values()),
}


# --- change feed and logs ----------------------------------------------------------

def start_change_router(feed: DataFrame, checkpoint: str, fmt: str = "kafka",
                        path: str | None = None, bootstrap_servers: str | None = None,
                        trigger: dict | None = None) -> StreamingQuery:
    return sinks.topic_sink(routing.route_changes(feed), checkpoint, fmt, bootstrap_servers,
                            path, trigger)


def start_log_collector(raw: DataFrame, checkpoint: str, archive_path: str,
                        fmt: str = "kafka", path: str | None = None,
                        bootstrap_servers: str | None = None,
                        trigger: dict | None = None) -> StreamingQuery:
    """Stamp server time once, archive the line by day, route it to its topic.
    Lines that are no JSON object are archived too, as rejects."""
    def write(batch: DataFrame, batch_id: int) -> None:
        stamped = routing.stamp_logs(batch).persist()
        try:
            good = stamped.where(F.col("value").isNotNull())
            day = F.date_format(F.timestamp_millis("received_ts"), "yyyy-MM-dd")
            good.select("value", day.alias("dt")).write.mode("overwrite").partitionBy("dt").text(
                f"{archive_path}/batch_id={batch_id}")
            stamped.where(F.col("value").isNull()).select("raw", "received_ts").write.mode("overwrite").parquet(
                f"{archive_path}_rejects/batch_id={batch_id}")
            sinks.write_topics(good, batch_id, fmt, bootstrap_servers, path)
        finally:
            stamped.unpersist()
    return _start(raw, write, checkpoint, trigger, "collector")
