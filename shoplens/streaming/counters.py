"""Dashboard counts that the jobs keep up: signed deltas by day and hour.

A batch adds what it changes. A new active device or order is +1 in its hour; a row that replaces
another takes the old one away in the old one's hour and adds itself in its own. So an earlier
startup, a corrected amount or a redelivery leaves the counts equal to a recount of the table, and
a report reads a few rows an hour instead of the day's devices and orders.

The deltas are a ``DayTable`` beside the job's table, a replayed batch overwrites its own. If the
counts miss batches (the job ran without them for a while) the next batch writes what is missing,
from one recount. Until then, and between the two writes of a batch, ``read`` says that they are behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens import schemas
from shoplens.streaming.state import DayTable

#: A sum of amounts, as Spark types it.
TOTAL = T.DecimalType(schemas.MONEY.precision + 10, schemas.MONEY.scale)


def _sums(rows: DataFrame, *more) -> DataFrame:
    return rows.groupBy("day", "hour").agg(F.sum("n").cast("long").alias("n"), F.sum("amount").cast(TOTAL).alias("amount"), *more)


def count_store(spark: SparkSession, path: str, **layout) -> DayTable:
    """(day, hour, n, amount) of the table at ``path``."""
    return DayTable(spark, f"{path.rstrip('/')}_counts", "day", lambda t: _sums(t, F.max("batch_id").alias("batch_id")), ["day", "hour"], **layout)


def signed(rows: DataFrame, day: str, hour: str, n, amount=None) -> DataFrame:
    """``rows`` as deltas: ``n`` is +1 or -1 a row, ``amount`` (null: 0) is counted with that sign."""
    amount = F.lit(0) if amount is None else F.coalesce(F.col(amount).cast(schemas.MONEY), F.lit(0))
    return rows.select(F.col(day).alias("day"), F.col(hour).alias("hour"), n.cast("long").alias("n"), (amount * n).cast(TOTAL).alias("amount"))


def first_rows(out: DataFrame) -> DataFrame:
    """Deltas of rows written to the DAU table, with the hour ``_hour`` of the stored row each replaces (null: none)."""
    one = F.lit(1)
    return signed(out, "LOG_DATE", "LOG_HOUR", one).unionByName(signed(out.where("_hour IS NOT NULL"), "LOG_DATE", "_hour", -one))


def order_versions(mine: DataFrame, stored: DataFrame | None, version: list[str], batch_id: int) -> DataFrame:
    """Deltas of a batch of orders: of each order the version that stood before goes, the one that stands now comes.

    ``stored``: earlier rows of the batch's days. One aggregate over the batch and the stored rows of
    its orders. An order's creation day does not change, as for all readers by day.
    """
    cols = ["ID", "CREATE_DATE", "CREATE_HOUR", "TOTAL_AMOUNT", *(c for c in version if c != "batch_id")]
    rows = mine.select(*cols).withColumn("batch_id", F.lit(batch_id).cast("long"))
    if stored is not None:
        rows = rows.unionByName(stored.select(*cols, "batch_id").join(mine.select("ID"), "ID", "left_semi"))
    row = F.struct(*version, "CREATE_DATE", "CREATE_HOUR", "TOTAL_AMOUNT")
    stands = rows.groupBy("ID").agg(F.max(row).alias("now"), F.max(F.when(F.col("batch_id") < batch_id, row)).alias("was"))
    both = [stands.where(f"{c} IS NOT NULL").select(f"{c}.*", F.lit(sign).alias("sign")) for c, sign in (("now", 1), ("was", -1))]
    return signed(both[0].unionByName(both[1]), "CREATE_DATE", "CREATE_HOUR", F.col("sign"), "TOTAL_AMOUNT")


def recount(table: DataFrame, day: str, hour: str, amount: str | None = None) -> DataFrame:
    """The counts of a whole table."""
    return signed(table, day, hour, F.lit(1), amount)


def add(store: DayTable, table: DayTable, deltas: DataFrame, batch_id: int, day: str, hour: str, amount: str | None = None) -> None:
    """Write a batch's deltas, after its rows were written to ``table``."""
    before, counted = table.manifest(batch_id), store.manifest(batch_id)
    if before is not None and (counted is None or counted["batch"] != before["batch"]):
        deltas = deltas.unionByName(recount(table.read(before=batch_id), day, hour, amount))
        if counted is not None:
            deltas = deltas.unionByName(store.read(before=batch_id).select("day", "hour", (-F.col("n")).alias("n"), (-F.col("amount")).cast(TOTAL).alias("amount")))
    store.write(_sums(deltas).where("n <> 0 OR amount <> 0"), batch_id)


def read(store: DayTable, table: DayTable, days: list[str] | None = None) -> DataFrame | None:
    """(day, hour, n, amount) of ``days``, hours without rows left out; None while the counts are behind the table."""
    counted, now = store.manifest(), table.manifest()
    if counted is None or now is None or counted["batch"] != now["batch"]:
        return None
    return store.read(days).where("n <> 0").select("day", "hour", "n", "amount")
