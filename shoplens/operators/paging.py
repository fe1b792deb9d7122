"""Any page of a ranking at the cost of the first.

The rows are dealt once into ranges of the rank order and written in order; the ranges' counts tell
which of them a page lies in, and only those files are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.config import shuffles_dropped


class RankedPages:
    def __init__(self, rows: DataFrame, order: list[Column], path: str, ranges: int | None = None):
        """Write ``rows`` under ``path`` in ``order``, which should tell all rows apart (a rank shared by many
        rows would make one range long)."""
        spark = rows.sparkSession
        dealt = rows.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)
        with shuffles_dropped(spark):
            dealt.withColumn("_range", F.spark_partition_id()).withColumn("_place", F.monotonically_increasing_id()).write.mode(
                "overwrite").option("compression", "zstd").partitionBy("_range").parquet(path)
        self.columns = rows.columns
        self.spark, self.path, self.schema = spark, path, rows.schema.add("_place", "long")
        #: Rows of each range: as many numbers as there are ranges.
        self.counts = sorted((r["_range"], r["count"]) for r in spark.read.parquet(path).groupBy("_range").count().collect())

    def page(self, number: int, size: int) -> DataFrame:
        """Page ``number`` (from 1) of ``size`` rows, in order; empty beyond the last."""
        if number < 1 or size < 0:
            raise ValueError("page numbers start at 1 and size must be >= 0")
        first, at, inside, skip = (number - 1) * size, 0, [], 0
        for name, count in self.counts:
            if at < first + size and at + count > first:
                if not inside:
                    skip = first - at
                inside.append(name)
            at += count
        if not inside:
            return self.spark.createDataFrame([], self.schema).select(*self.columns)
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/_range={name}" for name in inside])
        return rows.orderBy("_place").offset(skip).limit(size).select(*self.columns)
