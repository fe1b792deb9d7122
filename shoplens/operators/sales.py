"""The sales wide table: order x order-line within a time bound, enriched
with user attributes.

The reference pairs the two streams through a per-batch full outer join plus
an external cache with TTL; its net result is an inner join of orders and
lines whose arrivals are at most the TTL apart, each pair emitted once. Here
that is one equi-join on the order id with a range condition on the two event
times: a sort-merge join whose hot order ids AQE splits at run time; in
streaming the same condition bounds the join state through watermarks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens import schemas
from shoplens.operators.dimension import as_of_join

SALE_KEY = ["order_id", "order_detail_id"]


def _bound(interval: str) -> Column:
    return F.expr(f"INTERVAL {interval}")


def join_orders_details(orders: DataFrame, details: DataFrame, bound: str | None = "30 minutes",
                        how: str = "inner", order_time: str = "order_ts",
                        detail_time: str = "detail_ts") -> DataFrame:
    """Pairs of (order, line) on ``orders.id = details.order_id`` whose event
    times are at most ``bound`` apart (either order of arrival).

    ``bound=None`` drops the time condition; ``how='full'`` exposes unmatched
    orders and lines (the per-batch building block).
    """
    o = orders.alias("o")
    d = details.alias("d")
    cond = F.col("o.id") == F.col("d.order_id")
    if bound is not None:
        lo = F.col(f"o.{order_time}") - _bound(bound)
        hi = F.col(f"o.{order_time}") + _bound(bound)
        cond = cond & F.col(f"d.{detail_time}").between(lo, hi)
    return o.join(d, cond, how)


def full_pairs(orders: DataFrame, details: DataFrame, bound: str | None = "30 minutes",
               order_cols: tuple[str, ...] = ("id",), detail_cols: tuple[str, ...] = ("order_id", "id"),
               order_time: str = "order_ts", detail_time: str = "detail_ts") -> DataFrame:
    """Full outer pairing of orders and lines as flat columns ``order_<c>``
    and ``detail_<c>``: matched pairs, orders without a line, lines without an
    order.

    A full outer join's skewed partition cannot be split by AQE, so this is
    (a) lines LEFT JOIN orders - matched pairs and order-less lines, with the
    lines (where a hot order's rows are) on the splittable side - plus (b)
    orders LEFT ANTI the lines' keys, where the lines are first reduced to
    distinct keys (a hot order collapses to one row map-side).
    """
    o_keep = sorted({"id", *order_cols} | ({order_time} if bound else set()))
    d_keep = sorted({"order_id", *detail_cols} | ({detail_time} if bound else set()))
    o = orders.select(*o_keep).alias("o")
    d = details.select(*d_keep).alias("d")
    cond = F.col("d.order_id") == F.col("o.id")
    if bound is not None:
        cond = cond & F.col(f"d.{detail_time}").between(
            F.col(f"o.{order_time}") - _bound(bound), F.col(f"o.{order_time}") + _bound(bound))
    o_out = [F.col(f"o.{c}").alias(f"order_{c}") for c in order_cols]
    d_out = [F.col(f"d.{c}").alias(f"detail_{c}") for c in detail_cols]
    d_null = [F.lit(None).cast(details.schema[c].dataType).alias(f"detail_{c}") for c in detail_cols]
    lines = d.join(o, cond, "left").select(*o_out, *d_out)
    line_keys = details.select(*(["order_id", detail_time] if bound else ["order_id"])).distinct().alias("d")
    lonely_orders = o.join(line_keys, cond, "left_anti").select(*o_out, *d_null)
    return lines.unionByName(lonely_orders)


def sale_rows(pairs: DataFrame) -> DataFrame:
    """Order and line columns of the wide row; price as DECIMAL(16,2),
    ``dt`` = date part of create_time."""
    return pairs.select(
        F.col("d.id").alias("order_detail_id"),
        F.col("o.id").alias("order_id"),
        F.col("o.order_status").alias("order_status"),
        F.col("o.create_time").alias("create_time"),
        F.col("o.user_id").alias("user_id"),
        F.col("d.sku_id").alias("sku_id"),
        F.col("d.sku_name").alias("sku_name"),
        F.col("d.order_price").try_cast(schemas.MONEY).alias("sku_price"),
        F.substring(F.col("o.create_time"), 1, 10).alias("dt"))


def age_years(birthday: Column, as_of: str | None) -> Column:
    """Whole 365-day years between birthday and ``as_of`` (integer division
    of the day difference, like the reference's millisecond arithmetic); None
    is the day the query runs."""
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    days = F.datediff(day, birthday.cast("date"))
    return F.when(days >= 0, F.floor(days / F.lit(365))).otherwise(F.ceil(days / F.lit(365))).cast("int")


def enrich_users(sales: DataFrame, users: DataFrame, as_of: str | None, how: str = "inner") -> DataFrame:
    """Join the user dimension on user_id (inner by default: sales of unknown
    users drop out, as in the reference; ``how='left'`` keeps them).

    The dimension is not hinted: when it is small Spark broadcasts it from its
    size estimate, and AQE converts the join at run time from the measured
    shuffle size; when it is large the join stays a shuffle join.
    """
    u = users.select(F.col("id").alias("_uid"), F.col("gender").alias("user_gender"),
                     age_years(F.col("birthday"), as_of).alias("user_age"),
                     F.col("user_level"))
    joined = sales.join(u, sales.user_id == u._uid, how).drop("_uid")
    return joined.select(*[f.name for f in schemas.SALE_DETAIL.fields])


def enrich_users_as_of(sales: DataFrame, versions: DataFrame, as_of: str | None) -> DataFrame:
    """As ``enrich_users``, with the user's row that was valid when the order was created; ``versions`` are
    user rows with ``valid_from``."""
    timed = sales.withColumn("_ordered", F.try_to_timestamp("create_time", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"))
    joined = as_of_join(timed, versions, "user_id", "_ordered", "id", "valid_from", ["gender", "birthday", "user_level"])
    wide = joined.withColumn("user_gender", F.col("gender")).withColumn("user_age", age_years(F.col("birthday"), as_of))
    return wide.select(*[f.name for f in schemas.SALE_DETAIL.fields])


def sale_wide(orders: DataFrame, details: DataFrame, users: DataFrame, as_of: str,
              bound: str | None = "30 minutes", user_how: str = "inner") -> DataFrame:
    pairs = join_orders_details(orders, details, bound)
    return enrich_users(sale_rows(pairs), users, as_of, user_how)
