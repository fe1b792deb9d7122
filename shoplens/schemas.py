"""Row shapes of the data model (StartupLog, EventLog, OrderInfo, ...).

All business fields arrive as strings; event time arrives as epoch
milliseconds. Money is kept as DECIMAL(16,2) once parsed.
"""

from pyspark.sql import types as T

S = T.StringType()

# --- fixed values: field names and their order ------------------------------
STARTUP_LOG = T.StructType([
    T.StructField("mid", S), T.StructField("uid", S), T.StructField("appId", S),
    T.StructField("area", S), T.StructField("os", S), T.StructField("channel", S),
    T.StructField("logType", S), T.StructField("version", S),
    T.StructField("ts", T.LongType()),
])

# JSON numbers (itemId, pageId) bind to string fields: from_json keeps "38".
EVENT_LOG = T.StructType([
    T.StructField("mid", S), T.StructField("uid", S), T.StructField("appId", S),
    T.StructField("area", S), T.StructField("os", S), T.StructField("logType", S),
    T.StructField("eventId", S), T.StructField("pageId", S), T.StructField("nextPageId", S),
    T.StructField("itemId", S), T.StructField("ts", T.LongType()),
])

ORDER_INFO_FIELDS = [
    "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status",
    "payment_way", "user_id", "img_url", "total_amount", "expire_time", "delivery_address",
    "create_time", "operate_time", "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
]
ORDER_INFO = T.StructType([T.StructField(f, S) for f in ORDER_INFO_FIELDS])

# columns that ingestion adds to the bound fields of the serving tables
DAU_TABLE = [f.name for f in STARTUP_LOG.fields] + ["log_date", "log_hour"]
ORDER_TABLE = ORDER_INFO_FIELDS + ["create_date", "create_hour"]

ORDER_DETAIL_FIELDS = ["id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num"]
ORDER_DETAIL = T.StructType([T.StructField(f, S) for f in ORDER_DETAIL_FIELDS])

USER_INFO_FIELDS = ["id", "login_name", "user_level", "birthday", "gender"]
USER_INFO = T.StructType([T.StructField(f, S) for f in USER_INFO_FIELDS])

SALE_DETAIL = T.StructType([
    T.StructField("order_detail_id", S), T.StructField("order_id", S),
    T.StructField("order_status", S), T.StructField("create_time", S),
    T.StructField("user_id", S), T.StructField("sku_id", S),
    T.StructField("user_gender", S), T.StructField("user_age", T.IntegerType()),
    T.StructField("user_level", S), T.StructField("sku_price", T.DecimalType(16, 2)),
    T.StructField("sku_name", S), T.StructField("dt", S),
])

COLUMN_VALUE = T.StructType([T.StructField("name", S), T.StructField("value", S)])

# One change-feed entry: a table, the entry kind, the row operation and the
# after-image of each changed row as (column name, string value) pairs.
CHANGE_ENTRY = T.StructType([
    T.StructField("table", S),
    T.StructField("entry_type", S),
    T.StructField("op", S),
    T.StructField("rows", T.ArrayType(T.ArrayType(COLUMN_VALUE))),
])

MONEY = T.DecimalType(16, 2)
