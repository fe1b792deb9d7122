"""Daily active devices: keep the first startup per (date, device), then count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators.dedup import keep_first

DAU_KEYS = ["log_date", "mid"]


def daily_actives(startups: DataFrame, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """The DAU table: the earliest startup row of each device on each day.

    Batch twin of the streaming keep-first (which keeps the first to arrive).
    """
    order = [c for c in order if c in startups.columns]
    return keep_first(startups, DAU_KEYS, order)


def dau_by_date(dau: DataFrame) -> DataFrame:
    """count(*) of the DAU table per log_date."""
    return dau.groupBy("log_date").agg(F.count(F.lit(1)).alias("dau"))


def dau_by_hour(dau: DataFrame) -> DataFrame:
    """count(*) of the DAU table per (log_date, log_hour)."""
    return dau.groupBy("log_date", "log_hour").agg(F.count(F.lit(1)).alias("dau"))


def dau_for_date(dau: DataFrame, date: str) -> DataFrame:
    """The reference's ``getDau(date)``: one row, 0 when the day is empty."""
    return dau.where(F.col("log_date") == date).agg(F.count(F.lit(1)).alias("dau")) \
        .select(F.lit(date).alias("log_date"), "dau")


def new_devices_by_date(dau: DataFrame) -> DataFrame:
    """Devices whose first-ever active date is that date (our definition of
    the panel's new-device KPI, which the reference leaves as a constant)."""
    first = dau.groupBy("mid").agg(F.min("log_date").alias("log_date"))
    return first.groupBy("log_date").agg(F.count(F.lit(1)).alias("new_mid"))


# --- counts straight from startup rows ------------------------------------------
# The counts need neither whole rows nor a sort: every aggregate below keeps a
# fixed-width buffer, so Spark plans hash aggregation with map-side combine.

def date_device_pairs(startups: DataFrame) -> DataFrame:
    """Distinct (date, device) pairs: the DAU keys without the rows."""
    return startups.select(*DAU_KEYS).distinct()


def dau_by_date_from_startups(startups: DataFrame) -> DataFrame:
    """Distinct (date, device) pairs per date: equal to ``dau_by_date`` of the
    DAU table."""
    return date_device_pairs(startups).groupBy("log_date").agg(F.count(F.lit(1)).alias("dau"))


def first_hours(startups: DataFrame) -> DataFrame:
    """(log_date, mid, log_hour) of each device's earliest startup that day.

    The hour is a function of ``ts``, so ``min(ts * 100 + hour)`` picks the
    earliest startup and carries its hour in one long (fixed-width buffer)."""
    packed = F.col("ts") * F.lit(100) + F.col("log_hour").cast("int")
    first = startups.groupBy(*DAU_KEYS).agg(F.min(packed).alias("_p"))
    return first.select(*DAU_KEYS, F.lpad(F.pmod(F.col("_p"), F.lit(100)).cast("string"), 2, "0")
                        .alias("log_hour"))


def dau_by_hour_from_startups(startups: DataFrame) -> DataFrame:
    """Equal to ``dau_by_hour`` of the DAU table."""
    return first_hours(startups).groupBy("log_date", "log_hour").agg(F.count(F.lit(1)).alias("dau"))


def new_devices_from_startups(startups: DataFrame) -> DataFrame:
    """Equal to ``new_devices_by_date`` of the DAU table (a device's first day
    is the same whichever of its startups is kept). ``min`` ignores
    duplicates, so Catalyst drops the distinct below it and aggregates the
    startups directly; the partial ``min`` per task collapses a busy device to
    one row per task before the shuffle."""
    first = date_device_pairs(startups).groupBy("mid").agg(F.min(F.to_date("log_date")).alias("_d"))
    return first.groupBy(F.date_format("_d", "yyyy-MM-dd").alias("log_date")) \
        .agg(F.count(F.lit(1)).alias("new_mid"))
