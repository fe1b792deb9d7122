"""A versioned dimension: rows joined with the version that was valid at their time.

``as_of_join`` puts rows and versions side by side in order of time and carries the last version
forward. Time is cut into buckets, and what a bucket needs from earlier ones is the last version of each
earlier bucket, one row a key and bucket; so a key with a third of all rows is sorted bucket by
bucket, in as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.timeparts import bucket_index, interval_micros, ntz_to_epoch_micros


def as_of_join(rows: DataFrame, versions: DataFrame, key: str, time: str, version_key: str, version_time: str,
               columns: list[str], bucket: str = "1 day") -> DataFrame:
    """``rows`` with ``columns`` of the version of their ``key`` that is the latest at their ``time``; a version
    holds from its own instant on, and the first one before it too. Of versions of one instant the
    largest by ``columns`` holds. Rows whose key has no version, or without a time, are left out
    (as an inner join does). Times are NTZ timestamps."""
    step = interval_micros(bucket)

    def bucket_of(c) -> Column:
        return bucket_index(ntz_to_epoch_micros(c), step)

    v = versions.select(F.col(version_key).alias("_k"), F.col(version_time).alias("_t"), F.struct(*columns).alias("_v")).where("_k is not null and _t is not null")
    v = v.withColumn("_b", bucket_of("_t"))
    keyed = rows.withColumn("_k", F.col(key)).withColumn("_t", F.col(time)).where("_k is not null and _t is not null").withColumn("_b", bucket_of("_t"))
    # per key and bucket the last version in it; where rows ask, what was last before the bucket
    last = v.groupBy("_k", "_b").agg(F.max(F.struct("_t", "_v")).alias("_last"))
    asked = keyed.select("_k", "_b").distinct().select("_k", "_b", F.lit(None).cast(last.schema["_last"].dataType).alias("_last"), F.lit(1).alias("_asks"))
    spine = last.withColumn("_asks", F.lit(0)).unionByName(asked).groupBy("_k", "_b").agg(F.max("_last").alias("_last"), F.max("_asks").alias("_asks"))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    spine = spine.withColumn("_carry", F.last("_last", True).over(before)).where("_asks = 1")
    # and before its first version a key has that one
    first = v.groupBy("_k").agg(F.min("_t").alias("_t")).join(v, ["_k", "_t"]).groupBy("_k").agg(F.max("_v").alias("_first"))
    carried = spine.join(first, "_k").select("_k", "_b", F.lit(None).cast("timestamp_ntz").alias("_t"), F.coalesce("_carry._v", "_first").alias("_v"))
    # carried versions come first (no time), then in order of time versions before rows
    packed = F.struct(*rows.columns)
    seen = carried.unionByName(v.select("_k", "_b", "_t", "_v")).withColumn("_row", F.lit(None).cast(keyed.select(packed.alias("r")).schema["r"].dataType))
    both = seen.unionByName(keyed.select("_k", "_b", "_t", F.lit(None).cast(v.schema["_v"].dataType).alias("_v"), packed.alias("_row")))
    now = Window.partitionBy("_k", "_b").orderBy(F.col("_t").asc_nulls_first(), F.col("_row").isNotNull(), F.col("_v").asc_nulls_first())
    held = both.withColumn("_v", F.last("_v", True).over(now.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return held.where(F.col("_row").isNotNull() & F.col("_v").isNotNull()).select("_row.*", *[F.col(f"_v.{c}").alias(c) for c in columns])
