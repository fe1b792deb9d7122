"""JSON binding and enrichment of raw messages.

A message is parsed once: the parsed object comes out of an ``explode`` of one element, since of a plain
column the optimizer puts a copy of the parsing into each condition on a field. ``keep`` gets the
parsed messages, from which rows and rejects both come, and returns them (persisted, say).

``from_json`` binds fields by name like the reference's bean binding; numbers
bound to string fields keep their text ("38"). Rows whose JSON is malformed or
lacks a required field go to a rejects output instead of failing the batch.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens import schemas
from shoplens.functions import masking, timeparts

_CORRUPT = "_corrupt_record"
Keep = Callable[[DataFrame], DataFrame]


def bind_json(df: DataFrame, schema: T.StructType, value_col: str = "value",
              required: tuple[str, ...] = (), keep: Keep | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse ``value_col`` into the fields of ``schema``.

    Returns ``(rows, rejects)``: rejects keep the raw text plus a reason.
    Other input columns (e.g. the message's ``received_ts``) are carried
    along with the parsed fields.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    field_names = {f.name for f in schema.fields}
    carried = [c for c in df.columns if c != value_col and c not in field_names]
    parsed = df.select(
        F.col(value_col).alias("_raw"),
        F.explode(F.array(F.from_json(F.col(value_col), with_corrupt,
                                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))).alias("_j"),
        *carried)
    missing = [F.when(F.col(f"_j.{f}").isNull(), F.lit(f)) for f in required]
    reason = F.when(F.col("_raw").isNull(), F.lit("null message")) \
        .when(F.col("_j").isNull() | F.col(f"_j.{_CORRUPT}").isNotNull(), F.lit("malformed json"))
    if missing:
        reason = reason.otherwise(
            F.when(F.concat_ws(",", *missing) != "", F.concat(F.lit("missing: "), F.concat_ws(",", *missing))))
    tagged = parsed.withColumn("_reason", reason)
    if keep is not None:
        # the text only of rejects
        text = F.when(F.col("_reason").isNotNull(), F.col("_raw"))
        tagged = keep(tagged.withColumn("_raw", text))
    rows = tagged.where(F.col("_reason").isNull()).select("_j.*", *carried).drop(_CORRUPT)
    rejects = tagged.where(F.col("_reason").isNotNull()).select(
        F.col("_raw").alias("value"), F.col("_reason").alias("reason"))
    return rows, rejects


def startup_logs(raw: DataFrame, value_col: str = "value", tz: str | None = "UTC", keep: Keep | None = None):
    rows, rejects = bind_json(raw, schemas.STARTUP_LOG, value_col, required=("mid", "ts"), keep=keep)
    return timeparts.with_log_parts(rows, "ts", tz), rejects


def event_logs(raw: DataFrame, value_col: str = "value", tz: str | None = "UTC", keep: Keep | None = None):
    rows, rejects = bind_json(raw, schemas.EVENT_LOG, value_col, required=("mid", "ts"), keep=keep)
    return timeparts.with_log_parts(rows, "ts", tz), rejects


_CREATE_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}"


def _split(rows: DataFrame, rejects: DataFrame, reason: Column, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """Move the rows with a ``reason`` to the rejects, as JSON of their fields."""
    tagged = rows.withColumn("_reason", reason)
    bad = tagged.where(F.col("_reason").isNotNull()).select(
        F.to_json(F.struct(*fields)).alias("value"), F.col("_reason").alias("reason"))
    return tagged.where(F.col("_reason").isNull()).drop("_reason"), rejects.unionByName(bad)


def _not_money(c: str) -> Column:
    return F.col(c).isNotNull() & F.col(c).try_cast(schemas.MONEY).isNull()


def order_infos(raw: DataFrame, value_col: str = "value", keep: Keep | None = None):
    """JSON order rows -> masked, typed order rows (see ``ingest_orders``). An
    amount that is no number and a ``create_time`` without date and hour are
    rejects."""
    rows, rejects = bind_json(raw, schemas.ORDER_INFO, value_col,
                              required=("id", "create_time", "consignee"), keep=keep)
    reason = (F.when(_not_money("total_amount"), F.lit("bad total_amount"))
              .when(~F.col("create_time").rlike(_CREATE_TIME), F.lit("bad create_time")))
    rows, rejects = _split(rows, rejects, reason, schemas.ORDER_INFO_FIELDS)
    return ingest_orders(rows), rejects


def order_details(raw: DataFrame, value_col: str = "value", keep: Keep | None = None):
    rows, rejects = bind_json(raw, schemas.ORDER_DETAIL, value_col, required=("id", "order_id"), keep=keep)
    return _split(rows, rejects, F.when(_not_money("order_price"), F.lit("bad order_price")),
                  schemas.ORDER_DETAIL_FIELDS)


def ingest_orders(orders: DataFrame) -> DataFrame:
    """Order ingestion: date and hour by substring of ``create_time``, amount
    as DECIMAL(16,2), consignee name and phone masked."""
    return (orders
            .withColumn("total_amount", F.col("total_amount").try_cast(schemas.MONEY))
            .withColumn("create_date", F.substring("create_time", 1, 10))
            .withColumn("create_hour", F.substring("create_time", 12, 2))
            .withColumn("consignee", masking.mask_name("consignee"))
            .withColumn("consignee_tel", masking.mask_phone("consignee_tel")))


def typed_users(users: DataFrame) -> DataFrame:
    """Row -> typed user rows: string columns, birthday as DATE (null where
    the text is no date, so the user's age is unknown); of versions also
    ``valid_from``."""
    since = [F.col("valid_from").cast("timestamp_ntz")] if "valid_from" in users.columns else []
    return users.select(*since,
        *[F.col(f).cast("string").alias(f) for f in schemas.USER_INFO_FIELDS if f != "birthday"],
        F.col("birthday").cast("string").try_cast("date").alias("birthday"))


def is_json_object(value: Column) -> Column:
    """Whether the text is one JSON object without repeated keys."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT"), F.lit(False))


def stamp_ts(value: Column, ts: Column) -> Column:
    """A JSON object's text with ``ts`` set to the server's time; null when the
    text is no JSON object. A line without a client ``ts`` keeps its text and
    gains the field at the end; otherwise the fields are written anew, nested
    values as they were."""
    added = F.regexp_replace(value, r"\}\s*$", F.concat(F.lit(',"ts":'), ts.cast("string"), F.lit("}")))
    fields = F.from_json(value, "map<string,variant>")
    kept = F.map_filter(fields, lambda k, v: k != "ts")
    anew = F.to_json(F.map_concat(kept, F.create_map(F.lit("ts"), ts.cast("long").cast("variant"))))
    # an object with a field and without the text "ts" in it
    simple = ~value.contains('"ts"') & value.rlike(r'^\s*\{\s*"')
    return F.when(is_json_object(value), F.when(simple, added).otherwise(anew))


def columns_to_json(columns) -> Column:
    """array<struct<name,value>> of one changed row -> JSON object text."""
    c = F.col(columns) if isinstance(columns, str) else columns
    return F.to_json(F.map_from_entries(c))
