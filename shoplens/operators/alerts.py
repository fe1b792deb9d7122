"""Coupon-abuse alerts over sliding event-time windows.

Rule (per device and window): at least ``min_accounts`` distinct accounts
took a coupon, and no account on the device clicked an item.

A sliding window of length L and slide S puts every event into k = L/S
windows (50 for 5 min / 6 s). Nothing is copied k times here:

1. events are reduced per (device, pane), a pane being one slide-long bucket, to their
   number, a click flag and the distinct coupon accounts (map-side combined hash aggregates);
2. a pane lies in the windows p-k+1 .. p, an interval. Of each account the intervals are merged,
   and where one begins or ends a mark +1 or -1 is set; events and clicks are marked likewise. A
   sweep over a device's marks adds them up, which gives runs of windows with equal counts.
   Only runs that raise an alert are written out as windows.

Both sorts are cut into chunks of ``CHUNK`` window lengths, intervals being split at their edges, so a
device or account with a third of all rows is spread over its chunks.

Accounts, items and events of an alert are returned as long-form tables, not
nested arrays, so no unbounded group is collected into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.config import scratch_path
from shoplens.constants import CLICK_EVENT, COUPON_EVENT
from shoplens.functions.timeparts import (bucket_index, epoch_micros_to_ntz,
                                          interval_micros, ntz_to_epoch_micros)
from shoplens.operators.dedup import keep_last


#: Window lengths that share a chunk of the sweep.
CHUNK = 64


def _geometry(length: str, slide: str) -> tuple[int, int, int]:
    L, S = interval_micros(length), interval_micros(slide)
    if L <= 0 or S <= 0 or L % S:
        raise ValueError(f"window length {length!r} must be a positive multiple of slide {slide!r}")
    return L, S, L // S


def _with_pane(events: DataFrame, S: int, time_col: str) -> DataFrame:
    return events.withColumn("pane", bucket_index(ntz_to_epoch_micros(time_col), S))


def _pane_partials(events: DataFrame, S: int, time_col: str) -> DataFrame:
    """Per (device, pane, coupon account): event count and click flag, the
    account being set only for coupon events (null otherwise). Every per-pane
    input of the alert derives from this one definition; Catalyst prunes and
    pushes each branch's filter (e.g. coupon events only) toward the scan."""
    base = _with_pane(events.select("mid", "uid", "eventId", time_col), S, time_col)
    coupon_uid = F.when(F.col("eventId") == COUPON_EVENT, F.col("uid"))
    return base.groupBy("mid", "pane", coupon_uid.alias("uid")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max((F.col("eventId") == CLICK_EVENT).cast("int")).alias("clicked"))


def _window_bounds(df: DataFrame, S: int, L: int) -> DataFrame:
    start_us = F.col("w") * F.lit(S)
    return (df.withColumn("window_start", epoch_micros_to_ntz(start_us))
              .withColumn("window_end", epoch_micros_to_ntz(start_us + F.lit(L))))


def _cut(panes: DataFrame, k: int) -> DataFrame:
    """Each pane's interval of windows as ``lo`` .. ``hi``, split where a chunk ends."""
    size = CHUNK * k
    first, last = F.floor((F.col("pane") - (k - 1)) / size), F.floor(F.col("pane") / size)
    cut = panes.withColumn("chunk", F.explode(F.array_distinct(F.array(first, last))))
    return cut.withColumn("lo", F.greatest(F.col("pane") - (k - 1), F.col("chunk") * size)) \
              .withColumn("hi", F.least(F.col("pane"), (F.col("chunk") + 1) * size - 1))


def _mark(at: Column, accounts: Column, events: Column, clicks: Column) -> Column:
    return F.struct(at.alias("at"), accounts.cast("long").alias("accounts"), events.cast("long").alias("events"),
                    clicks.cast("long").alias("clicks"))


def window_runs(parts: DataFrame, k: int) -> DataFrame:
    """Runs ``lo`` .. ``hi`` of a device's windows that hold the same numbers of coupon accounts, events and
    panes with a click; windows without events are left out."""
    none, size = F.lit(0), CHUNK * k
    panes = _cut(parts.groupBy("mid", "pane").agg(F.sum("n").alias("n"), F.max("clicked").alias("clicked")), k)
    panes = panes.select("mid", "chunk", F.explode(F.array(
        _mark(F.col("lo"), none, F.col("n"), F.col("clicked")), _mark(F.col("hi") + 1, none, -F.col("n"), -F.col("clicked")))).alias("m"))
    mine = Window.partitionBy("mid", "uid", "chunk").orderBy("lo", "hi")
    merged = _cut(parts.where(F.col("uid").isNotNull()).select("mid", "uid", "pane"), k) \
        .withColumn("before", F.lag("hi").over(mine)).withColumn("after", F.lead("lo").over(mine))
    begins = F.col("before").isNull() | (F.col("lo") > F.col("before") + 1)
    ends = F.col("after").isNull() | (F.col("after") > F.col("hi") + 1)
    accounts = merged.where(begins | ends).select("mid", "chunk", F.explode(F.array_compact(F.array(
        F.when(begins, _mark(F.col("lo"), F.lit(1), none, none)), F.when(ends, _mark(F.col("hi") + 1, F.lit(-1), none, none))))).alias("m"))
    marks = panes.unionByName(accounts).select("mid", "chunk", "m.*")
    order = Window.partitionBy("mid", "chunk").orderBy("at")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = marks.select("mid", "chunk", F.col("at").alias("lo"), F.lead("at").over(order).alias("next"),
                         *[F.sum(c).over(so_far).alias(c) for c in ("accounts", "events", "clicks")])
    # of marks at one place the last has the sum of all
    runs = swept.where(F.col("next").isNull() | (F.col("next") > F.col("lo"))).where((F.col("events") > 0) & (F.col("lo") < (F.col("chunk") + 1) * size))
    end = (F.col("chunk") + 1) * size
    return runs.select("mid", "lo", (F.least(F.coalesce(F.col("next"), end), end) - 1).alias("hi"), "accounts", "events", "clicks")


def _windows(runs: DataFrame, S: int, L: int) -> DataFrame:
    each = runs.withColumn("w", F.explode(F.sequence("lo", "hi")))
    return _window_bounds(each, S, L).select("mid", "window_start", "window_end", "w", F.col("accounts").alias("coupon_accounts"),
                                             F.col("events").alias("n_events"), (F.col("clicks") > 0).alias("clicked"))


def in_windows_of(windows: DataFrame, panes: DataFrame, k: int) -> DataFrame:
    """The rows (mid, w, ...) of ``windows`` that hold one of ``panes`` (mid, pane). In a block of k windows
    a device's panes reach the windows up to the last pane of the block and from k - 1 before the
    first of the next on, so two numbers a block say all."""
    block = F.floor(F.col("pane") / k)
    here = panes.select("mid", block.alias("_block"), F.col("pane").alias("_upto"), F.lit(None).cast("long").alias("_from"))
    next_one = panes.select("mid", (block - 1).alias("_block"), F.lit(None).cast("long").alias("_upto"), (F.col("pane") - (k - 1)).alias("_from"))
    reach = here.unionByName(next_one).groupBy(F.col("mid").alias("_mid"), "_block").agg(F.max("_upto").alias("_upto"), F.min("_from").alias("_from"))
    inside = F.coalesce(F.col("w") <= F.col("_upto"), F.lit(False)) | F.coalesce(F.col("w") >= F.col("_from"), F.lit(False))
    return windows.join(reach, (F.col("mid") == F.col("_mid")) & (F.floor(F.col("w") / k) == F.col("_block")) & inside, "left_semi")


def pane_table(events: DataFrame, slide: str = "6 seconds", time_col: str = "event_time") -> DataFrame:
    """The pane partials of ``events`` (mid, uid, eventId and an NTZ
    ``time_col``) written once to the shared folder: one pass over the events,
    whatever number of branches read the panes afterwards."""
    spark = events.sparkSession
    path = scratch_path(spark, "panes")
    parts = _pane_partials(events, interval_micros(slide), time_col)
    parts.write.parquet(path)
    return spark.read.schema(parts.schema).parquet(path)


def alert_windows(parts: DataFrame, length: str = "5 minutes", slide: str = "6 seconds") -> DataFrame:
    """Per (device, window) of a pane table: coupon_accounts, n_events, clicked."""
    L, S, k = _geometry(length, slide)
    return _windows(window_runs(parts, k), S, L)


def coupon_alerts(parts: DataFrame, length: str = "5 minutes", slide: str = "6 seconds",
                  min_accounts: int = 3) -> DataFrame:
    """Windows of a pane table that raise an alert: ``min_accounts`` accounts and no click. Runs that do
    not are dropped before any window is written out."""
    L, S, k = _geometry(length, slide)
    runs = window_runs(parts, k).where((F.col("accounts") >= min_accounts) & (F.col("clicks") == 0))
    return _windows(runs, S, L).drop("clicked")


def throttle_alerts(alerts: DataFrame, every: str = "1 minute", on: str = "window_end") -> DataFrame:
    """At most one alert per device per ``every`` interval of ``on``; the
    latest window wins. ``doc_id`` = 'mid:bucket' (bucket = epoch minutes for
    a one-minute interval), the key a keyed sink overwrites on."""
    step = interval_micros(every)
    keyed = alerts.withColumn("bucket", bucket_index(ntz_to_epoch_micros(on), step))
    latest = keep_last(keyed, ["mid", "bucket"], [on, "window_start"])
    return latest.withColumn("doc_id", F.concat_ws(":", F.col("mid"), F.col("bucket").cast("string")))


def _alert_panes(alerts: DataFrame, k: int) -> DataFrame:
    """The panes of each alert's window; alerts are few."""
    keys = alerts.select("mid", "w", "window_start", "window_end")
    return keys.select("*", F.explode(F.sequence(F.col("w"), F.col("w") + (k - 1))).alias("pane"))


def alert_accounts(parts: DataFrame, alerts: DataFrame, length: str = "5 minutes", slide: str = "6 seconds") -> DataFrame:
    """(alert window, account) pairs: the coupon accounts behind each alert, from the pane table."""
    L, S, k = _geometry(length, slide)
    accounts = parts.where(F.col("uid").isNotNull()).select("mid", "pane", "uid")
    return accounts.join(_alert_panes(alerts, k), ["mid", "pane"]).select("mid", "window_start", "window_end", "uid").distinct()


def alert_items(events: DataFrame, alerts: DataFrame, length: str = "5 minutes",
                slide: str = "6 seconds", time_col: str = "event_time") -> DataFrame:
    """(alert window, item) pairs: items whose coupons were taken."""
    L, S, k = _geometry(length, slide)
    it = (_with_pane(events.where(F.col("eventId") == COUPON_EVENT)
                     .select("mid", "itemId", time_col), S, time_col)
          .select("mid", "pane", "itemId").distinct())
    return it.join(_alert_panes(alerts, k), ["mid", "pane"]).select("mid", "window_start", "window_end", "itemId").distinct()


def alert_events(events: DataFrame, alerts: DataFrame, length: str = "5 minutes",
                 slide: str = "6 seconds", time_col: str = "event_time",
                 cols: tuple[str, ...] = ("event_id", "ts", "eventId")) -> DataFrame:
    """Every event of every alert window, one row each (duplicates kept).

    The alert keys are expanded to their k panes and joined to the events by
    (device, pane), so only events of alerting windows are touched.
    """
    L, S, k = _geometry(length, slide)
    ev = _with_pane(events.select("mid", time_col, *[c for c in cols if c != time_col]), S, time_col)
    return ev.join(_alert_panes(alerts, k), ["mid", "pane"], "inner").select(
        "mid", "window_start", "window_end", *cols)
