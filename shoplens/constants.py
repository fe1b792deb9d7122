"""Fixed values that must equal the reference application's for equal output."""

# --- fixed values: topic names -------------------------------------------
STARTUP_LOG_TOPIC = "startup_log_topic"
EVENT_LOG_TOPIC = "event_log_topic"
ORDER_INFO_TOPIC = "order_info_topic"
ORDER_DETAIL_TOPIC = "order_detail_topic"

# --- fixed values: event names used by the coupon alert -------------------
COUPON_EVENT = "coupon"
CLICK_EVENT = "clickItem"

# --- fixed values: KPI panel rows (id, display name) ----------------------
KPI_DAU = ("dau", "新增日活")
KPI_NEW_MID = ("new_mid", "新增设备")
KPI_ORDER_AMOUNT = ("order_amount", "新增交易额")

# --- fixed values: search report titles and labels ------------------------
GENDER_TITLE = "用户性别占比"
GENDER_MALE_LABEL = "男"
GENDER_OTHER_LABEL = "女"
AGE_TITLE = "用户年龄占比"
AGE_BANDS = [("20岁以下", None, 20), ("20岁到30岁", 20, 30), ("30岁及以上", 30, None)]
AGE_TERMS_SIZE = 100

# --- fixed values: change-feed filter --------------------------------------
CDC_ROUTES = {"order_info": ORDER_INFO_TOPIC, "order_detail": ORDER_DETAIL_TOPIC}
CDC_ROWDATA = "ROWDATA"
CDC_INSERT = "INSERT"
