"""Serving tables and the user dimension.

The jobs write each batch sorted by day; the launcher's ``compact`` folds a job's
batches into a table partitioned by day (``log_date`` for DAU, ``create_date``
for orders, ``dt`` for sales), so a report for one day reads one partition: the
date predicate prunes partitions at planning time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions import parse


def read_serving_table(spark: SparkSession, path: str, date_col: str | None = None,
                       dates: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """A serving table, optionally restricted to some days (partition pruning)."""
    df = spark.read.format(fmt).option("basePath", path).load(path)
    if date_col and dates:
        df = df.where(F.col(date_col).isin(dates))
    return df


def read_dimension(spark: SparkSession, fmt: str = "jdbc", options: dict[str, str] | None = None,
                   path: str | None = None) -> DataFrame:
    """The user dimension from JDBC (``options`` carry url/dbtable/user...)
    or from files; typed like UserInfo."""
    reader = spark.read.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    raw = reader.load(path) if path else reader.load()
    return parse.typed_users(raw)


def jdbc_lookup(spark: SparkSession, options: dict[str, str], dim_key: str = "id", groups: int = 16):
    """A lookup for ``start_sales``: users of a batch from a database, the ids
    pushed down as ranges.

    The batch's numeric ids are cut at quantiles, computed by Spark, into at
    most ``groups`` ranges, each a predicate (and a partition) of the read, so
    the database returns the ranges in use and not the whole table. Only the
    ``groups + 1`` bounds come to the driver.
    """
    def lookup(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("user_id").cast("long").alias("i")).where("i is not null").distinct()
        cuts = ids.agg(F.percentile_approx("i", [x / groups for x in range(groups + 1)])).first()[0] or []
        bounds = sorted(set(cuts))
        ranges = [f"{dim_key} between {a} and {b}" for a, b in zip(bounds, bounds[1:])] or [f"{dim_key} = {b}" for b in bounds] or ["1 = 0"]
        # neighbouring ranges share a bound: the second starts after it
        ranges = [r if i == 0 else r.replace("between", ">", 1).replace(" and ", f" and {dim_key} <= ", 1) for i, r in enumerate(ranges)]
        raw = spark.read.jdbc(options["url"], options["dbtable"], predicates=ranges,
                              properties={k: v for k, v in options.items() if k not in ("url", "dbtable")})
        return lookup_by_ids(parse.typed_users(raw), pairs)
    return lookup


def lookup_by_ids(dimension: DataFrame, ids: DataFrame, dim_key: str = "id",
                  id_col: str = "user_id") -> DataFrame:
    """Dimension rows whose key occurs in ``ids`` - the ``IN (id list)``
    lookup as a left-semi join, so the id list is never collected to the
    driver; for JDBC the semi-join runs after the read (Spark pushes simple
    filters, not joins, into the database)."""
    keys = ids.select(F.col(id_col).alias(dim_key)).distinct()
    return dimension.join(keys, dim_key, "left_semi")
