"""Dashboard reports: KPI panel, today-vs-yesterday hourly series, search."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.constants import KPI_DAU, KPI_NEW_MID, KPI_ORDER_AMOUNT
from shoplens.functions.timeparts import previous_day
from shoplens.operators import dau as dau_ops
from shoplens.operators import orders as order_ops
from shoplens.operators.joins import bounded_broadcast


def kpi_panel(dau: DataFrame, orders: DataFrame) -> DataFrame:
    """Per date: three rows (id, name, value) - daily actives, new devices,
    order amount - values as strings, zero for a metric with no rows that day.
    ``dau`` is the DAU table (one row per date and device)."""
    return kpi_panel_of(dau_ops.dau_by_date(dau), dau_ops.new_devices_by_date(dau),
                        order_ops.amount_by_date(orders))


def kpi_panel_from_startups(startups: DataFrame, orders: DataFrame) -> DataFrame:
    """The same panel counted straight from startup rows (hash aggregates
    only, no DAU rows materialised)."""
    return kpi_panel_of(dau_ops.dau_by_date_from_startups(startups),
                        dau_ops.new_devices_from_startups(startups),
                        order_ops.amount_by_date(orders))


def kpi_panel_of(dau_per_date: DataFrame, new_per_date: DataFrame,
                 amount_per_date: DataFrame) -> DataFrame:
    """Metrics are stacked as one long table and summed per date (one small
    shuffle over pre-aggregated rows), then unpivoted; no joins."""
    zero = F.lit(0).cast("long")
    zero_amt = F.lit(0).cast(schemas.MONEY)
    a = dau_per_date.select("log_date", F.col("dau"), zero.alias("new_mid"),
                            zero_amt.alias("order_amount"))
    b = new_per_date.select("log_date", zero.alias("dau"), "new_mid", zero_amt.alias("order_amount"))
    c = amount_per_date.select(F.col("create_date").alias("log_date"), zero.alias("dau"),
                               zero.alias("new_mid"), "order_amount")
    per_date = a.unionByName(b).unionByName(c).groupBy("log_date").agg(
        F.sum("dau").alias("dau"), F.sum("new_mid").alias("new_mid"),
        F.sum("order_amount").cast(schemas.MONEY).alias("order_amount"))
    rows = F.array(
        F.struct(F.lit(KPI_DAU[0]).alias("id"), F.lit(KPI_DAU[1]).alias("name"),
                 F.col("dau").cast("string").alias("value")),
        F.struct(F.lit(KPI_NEW_MID[0]).alias("id"), F.lit(KPI_NEW_MID[1]).alias("name"),
                 F.col("new_mid").cast("string").alias("value")),
        F.struct(F.lit(KPI_ORDER_AMOUNT[0]).alias("id"), F.lit(KPI_ORDER_AMOUNT[1]).alias("name"),
                 F.col("order_amount").cast("string").alias("value")))
    return per_date.select("log_date", F.inline(rows))


def kpi_panel_for_date(dau: DataFrame, orders: DataFrame, date: str) -> DataFrame:
    """The panel of one date from the DAU and order tables; all three rows exist
    even for an empty day. The date prunes the day's actives and orders; new
    devices need each device's whole history."""
    new = dau_ops.new_devices_by_date(dau).where(F.col("log_date") == date)
    panel = kpi_panel_of(dau_ops.dau_by_date(dau.where(F.col("log_date") == date)), new,
                         order_ops.amount_by_date(orders.where(F.col("create_date") == date)))
    return _dense_panel(panel, date)


def kpi_panel_of_day(startups: DataFrame, history: DataFrame, orders: DataFrame, date: str) -> DataFrame:
    """The same from raw startup rows: those of the day, those of all days, and
    the day's orders."""
    new = dau_ops.new_devices_from_startups(history).where(F.col("log_date") == date)
    return _dense_panel(kpi_panel_of(dau_ops.dau_by_date_from_startups(startups), new, order_ops.amount_by_date(orders)), date)


def _dense_panel(panel: DataFrame, date: str) -> DataFrame:
    # the panel of one date has three rows
    return _kpi_spine(panel.sparkSession, date).join(bounded_broadcast(panel.select("id", "value")), "id", "left").select(
        "log_date", "id", "name", F.coalesce("value", F.lit("0")).alias("value"))


def _kpi_spine(spark, date: str) -> DataFrame:
    rows = [(date, i, n) for i, n in (KPI_DAU, KPI_NEW_MID, KPI_ORDER_AMOUNT)]
    return spark.createDataFrame(rows, "log_date string, id string, name string")


def hour_spine(spark) -> DataFrame:
    """'00'..'23' as 24 rows."""
    return spark.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("hour"))


def today_vs_yesterday(hourly: DataFrame, date: str, date_col: str, hour_col: str,
                       value_col: str, zero=None) -> DataFrame:
    """Dense 24-hour series: (hour, today, yesterday), zero-filled.

    Conditional aggregation over the two dates gives at most 24 rows, joined
    to the fixed 24-hour spine (both sides bounded by 24 rows).
    """
    zero = F.lit(0) if zero is None else zero
    yday = previous_day(date)
    two_days = hourly.where(F.col(date_col).isin(date, yday))
    per_hour = two_days.groupBy(F.col(hour_col).alias("hour")).agg(
        F.sum(F.when(F.col(date_col) == date, F.col(value_col))).alias("today"),
        F.sum(F.when(F.col(date_col) == yday, F.col(value_col))).alias("yesterday"))
    spine = hour_spine(hourly.sparkSession)
    return bounded_broadcast(spine).join(bounded_broadcast(per_hour), "hour", "left").select(
        "hour", F.coalesce("today", zero).alias("today"),
        F.coalesce("yesterday", zero).alias("yesterday"))


def hourly_dau_compare(dau: DataFrame, date: str) -> DataFrame:
    return today_vs_yesterday(dau_ops.dau_by_hour(dau), date, "log_date", "log_hour", "dau",
                              F.lit(0).cast("long"))


def hourly_amount_compare(orders: DataFrame, date: str) -> DataFrame:
    return today_vs_yesterday(order_ops.amount_by_hour(orders), date, "create_date",
                              "create_hour", "order_amount", F.lit(0).cast(schemas.MONEY))


def hourly_compare_of_counts(metric_id: str, counts: DataFrame, date: str) -> DataFrame:
    """The same series from counts the jobs keep by day and hour."""
    if metric_id == "dau":
        return today_vs_yesterday(counts, date, "log_date", "log_hour", "dau", F.lit(0).cast("long"))
    if metric_id == "order_amount":
        return today_vs_yesterday(counts, date, "create_date", "create_hour", "order_amount", F.lit(0).cast(schemas.MONEY))
    raise ValueError(f"unknown metric {metric_id!r}; known: {sorted(HOURLY_METRICS)}")


def kpi_panel_of_counts(dau_counts: DataFrame, dau: DataFrame, order_counts: DataFrame, date: str) -> DataFrame:
    """The panel of one date from the jobs' counts; only new devices, which need each device's whole
    history, are counted from the DAU table."""
    actives = dau_counts.where(F.col("log_date") == date).groupBy("log_date").agg(F.sum("dau").alias("dau"))
    amounts = order_counts.where(F.col("create_date") == date).groupBy("create_date").agg(F.sum("order_amount").alias("order_amount"))
    new = dau_ops.new_devices_by_date(dau).where(F.col("log_date") == date)
    return _dense_panel(kpi_panel_of(actives, new, amounts), date)


HOURLY_METRICS: dict[str, Callable[[DataFrame, str], DataFrame]] = {
    "dau": hourly_dau_compare,
    "order_amount": hourly_amount_compare,
}


def realtime_hour(metric_id: str, source: DataFrame, date: str) -> DataFrame:
    """Metric selector: 'dau' over the DAU table, 'order_amount' over orders."""
    try:
        fn = HOURLY_METRICS[metric_id]
    except KeyError:
        raise ValueError(f"unknown metric {metric_id!r}; known: {sorted(HOURLY_METRICS)}") from None
    return fn(source, date)
