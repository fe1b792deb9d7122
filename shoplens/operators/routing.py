"""Change-feed and log routing: filter, flatten and pick a topic per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.constants import (CDC_INSERT, CDC_ROUTES, CDC_ROWDATA, EVENT_LOG_TOPIC,
                                STARTUP_LOG_TOPIC)
from shoplens.functions.parse import columns_to_json, stamp_ts


def _route_expr(c: Column, routes: dict[str, str]) -> Column:
    expr = None
    for table, topic in routes.items():
        expr = F.when(c == table, F.lit(topic)) if expr is None else expr.when(c == table, F.lit(topic))
    return expr


def route_changes(feed: DataFrame, routes: dict[str, str] | None = None,
                  op: str = CDC_INSERT) -> DataFrame:
    """Row-data entries of the routed tables with operation ``op`` and at
    least one row -> one (topic, table, value) per changed row, value being
    the row's after-image as a JSON object."""
    routes = routes or CDC_ROUTES
    kept = feed.where((F.col("entry_type") == CDC_ROWDATA) & (F.col("op") == op)
                      & F.col("table").isin(list(routes)))
    # explode emits nothing for an empty or null row list, which is the
    # non-empty test; a separate size() predicate would build the list twice
    rows = kept.select("table", F.explode("rows").alias("columns"))
    return rows.select(_route_expr(F.col("table"), routes).alias("topic"), "table",
                       columns_to_json("columns").alias("value"))


def log_topic(value: Column, mode: str = "field") -> Column:
    """Topic of a raw log line: startup logs to the startup topic, everything
    else to the event topic. ``mode='field'`` reads ``logType``;
    ``mode='substring'`` reproduces the collector's test for the text
    'startup' anywhere in the line."""
    if mode == "substring":
        is_startup = value.contains("startup")
    elif mode == "field":
        is_startup = F.get_json_object(value, "$.logType") == F.lit("startup")
    else:
        raise ValueError("mode is 'field' or 'substring'")
    return F.when(is_startup, F.lit(STARTUP_LOG_TOPIC)).otherwise(F.lit(EVENT_LOG_TOPIC))


def stamp_logs(raw: DataFrame, value_col: str = "value", received_col: str = "received_ts",
               mode: str = "field") -> DataFrame:
    """Collector path: stamp the server time as ``ts`` (overwriting any client
    value) and pick the topic; a line that is no JSON object has neither
    (``value`` null) and keeps its text in ``raw``."""
    rest = [c for c in raw.columns if c != value_col]
    stamped = raw.select(F.col(value_col).alias("raw"),
                         stamp_ts(F.col(value_col), F.col(received_col)).alias("value"), *rest)
    return stamped.withColumn("topic", F.when(F.col("value").isNotNull(), log_topic(F.col("raw"), mode)))


def route_logs(raw: DataFrame, value_col: str = "value", received_col: str = "received_ts",
               mode: str = "field") -> DataFrame:
    """The stamped lines that have a topic (``stamp_logs`` has the others too)."""
    return stamp_logs(raw, value_col, received_col, mode).where(F.col("value").isNotNull()).drop("raw")
