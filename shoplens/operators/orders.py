"""Order amounts per day and hour over the ingested (masked) order table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens import schemas


def _amount(c: str = "total_amount"):
    return F.sum(F.col(c).cast(schemas.MONEY))


def amount_by_date(orders: DataFrame) -> DataFrame:
    return orders.groupBy("create_date").agg(_amount().alias("order_amount"))


def amount_by_hour(orders: DataFrame) -> DataFrame:
    return orders.groupBy("create_date", "create_hour").agg(_amount().alias("order_amount"))


def amount_for_date(orders: DataFrame, date: str) -> DataFrame:
    """The reference's ``getTotalAmount(date)``: null (no orders) becomes 0."""
    total = orders.where(F.col("create_date") == date).agg(_amount().alias("s"))
    return total.select(F.lit(date).alias("create_date"),
                        F.coalesce(F.col("s"), F.lit(0).cast(schemas.MONEY)).alias("order_amount"))


def amount_by_province(orders: DataFrame) -> DataFrame:
    """Sales per (date, province): the data behind the province map."""
    return orders.groupBy("create_date", "province_id").agg(
        _amount().alias("order_amount"), F.count(F.lit(1)).alias("orders"))
