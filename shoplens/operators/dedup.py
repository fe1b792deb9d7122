"""Keep-first / keep-last per key as aggregates.

``min``/``max`` over a struct whose leading fields are the ordering keys
picks one whole row per key. Being an aggregate, it is combined map-side
(partial aggregation) before the shuffle, so a key holding a third of all rows
is reduced to one row per map task instead of being sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list[str], fn) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest]).alias("_row")
    picked = df.groupBy(*keys).agg(fn(packed).alias("_row"))
    out = picked.select(*keys, *[F.col(f"_row.o{i}").alias(c) for i, c in enumerate(order)],
                        *[F.col(f"_row.{c}") for c in rest])
    return out.select(*df.columns)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (lexicographic)."""
    return _pick(df, keys, order, F.min)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``: the largest by ``order`` (last write wins)."""
    return _pick(df, keys, order, F.max)
