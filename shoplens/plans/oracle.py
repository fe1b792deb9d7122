"""DuckDB SQL twins of the registered queries (the correctness oracle).

The views are rebuilt in SQL from the same driver tables; each query is
written independently of the Spark plan (window functions, range joins,
``time_bucket`` + ``unnest`` for sliding windows).
"""

from __future__ import annotations

from shoplens import schemas
from shoplens.plans import registry as R

_EVENT_NAME = ("CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem' "
               "WHEN 'view' THEN 'addCart' WHEN 'signup' THEN 'addComment' "
               "WHEN 'error' THEN 'addFavor' END")

_TOK = (r"list_filter(regexp_split_to_array(regexp_replace(lower(sku_name), '(\p{Han})', ' \1 ', 'g'), "
        r"'[^\p{L}\p{N}]+'), lambda x: x <> '')")

_AS_OF = """
SELECT s.* REPLACE (coalesce((
  SELECT arg_max(o.o_orderpriority, (o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)), o.o_orderpriority)) FROM orders o
  WHERE CAST(o.o_custkey AS VARCHAR) = s.user_id AND o.o_orderkey % 4 = 0
    AND o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) <= CAST(s.create_time AS TIMESTAMP)), s.user_level) AS user_level)
FROM {} s"""

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "startup_log": ((), """
  SELECT event_id, 'mid_' || CAST(user_id AS VARCHAR) AS mid, 'uid' || CAST(user_id AS VARCHAR) AS uid,
         'startup' AS log_type, epoch_us(ts) // 1000 AS ts, ts AS event_time,
         strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour
  FROM events"""),
    "dau": (("startup_log",), """
  SELECT event_id, mid, uid, log_type, ts, event_time, log_date, log_hour FROM (
    SELECT *, row_number() OVER (PARTITION BY log_date, mid ORDER BY ts, event_id) AS rn
    FROM startup_log) WHERE rn = 1"""),
    "event_log": ((), f"""
  SELECT event_id, 'mid_' || CAST(user_id % 25 AS VARCHAR) AS mid, 'uid' || CAST(user_id AS VARCHAR) AS uid,
         'event' AS log_type, {_EVENT_NAME} AS event_name,
         json_extract_string(props, '$.k') AS item_id, epoch_us(ts) // 1000 AS ts, ts AS event_time,
         strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour
  FROM events"""),
    "raw_order_info": ((), """
  SELECT CAST(o.o_orderkey AS VARCHAR) AS id, CAST(c.c_nationkey AS VARCHAR) AS province_id,
         c.c_name AS consignee, '13' || lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') AS consignee_tel,
         o.o_orderstatus AS order_status, CAST(o.o_custkey AS VARCHAR) AS user_id,
         CAST(CAST(o.o_totalprice AS DECIMAL(16,2)) AS VARCHAR) AS total_amount,
         strftime(o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS create_time,
         o.o_orderdate AS order_ts
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""),
    "order_info": (("raw_order_info",), r"""
  SELECT id, province_id, substr(consignee, 1, 1) || '**' AS consignee,
         regexp_replace(consignee_tel, '(\d{3})\d{4}(\d{4})', '\1****\2', 'g') AS consignee_tel,
         order_status, user_id, CAST(total_amount AS DECIMAL(16,2)) AS total_amount, create_time, order_ts,
         substr(create_time, 1, 10) AS create_date, substr(create_time, 12, 2) AS create_hour
  FROM raw_order_info"""),
    "order_detail": ((), """
  SELECT CAST(l.l_orderkey AS VARCHAR) || ':' || CAST(l.l_linenumber AS VARCHAR) || ':' ||
         CAST(l.l_partkey AS VARCHAR) || ':' || CAST(l.l_suppkey AS VARCHAR) AS id,
         CAST(l.l_orderkey AS VARCHAR) AS order_id, p.p_name AS sku_name, CAST(l.l_partkey AS VARCHAR) AS sku_id,
         CAST(CAST(l.l_extendedprice AS DECIMAL(16,2)) AS VARCHAR) AS order_price,
         CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS sku_num, l.l_shipdate AS detail_ts
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""),
    "user_info": ((), """
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name, c_mktsegment AS user_level,
         CAST(DATE '1955-01-01' + CAST((c_custkey * 37) % 20000 AS INTEGER) AS DATE) AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM customer"""),
}


def _sale_view(bound: str | None) -> tuple[tuple[str, ...], str]:
    cond = ""
    if bound:
        n, unit = bound.split()
        unit = unit.rstrip("s").upper()
        cond = (f" AND d.detail_ts BETWEEN o.order_ts - INTERVAL {n} {unit} "
                f"AND o.order_ts + INTERVAL {n} {unit}")
    return (("order_info", "order_detail", "user_info"), f"""
  SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
         u.gender AS user_gender,
         CAST(trunc(datediff('day', u.birthday, DATE '{R.AS_OF}') / 365) AS INTEGER) AS user_age,
         u.user_level, CAST(d.order_price AS DECIMAL(16,2)) AS sku_price, d.sku_name,
         substr(o.create_time, 1, 10) AS dt
  FROM order_info o JOIN order_detail d ON o.id = d.order_id{cond}
  JOIN user_info u ON o.user_id = u.id""")


VIEWS["sale"] = _sale_view(None)
VIEWS["sale_bounded"] = _sale_view(R.JOIN_BOUND)
VIEWS["sale_tok"] = (("sale",), f"SELECT *, {_TOK} AS tok FROM sale")
VIEWS["matches"] = (("sale_tok",), f"""
  SELECT * FROM sale_tok WHERE dt = '{R.SEARCH_DATE}' AND list_contains(tok, '{R.SEARCH_KEYWORD}')""")
VIEWS["bm25"] = (("sale_tok",), f"""
  SELECT t.*, ln(1.0::DOUBLE + (s.n - s.df + 0.5::DOUBLE) / (s.df + 0.5::DOUBLE)) * t.tf * 2.2::DOUBLE
         / (t.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * CAST(len(t.tok) AS DOUBLE) / s.avgdl)) AS score
  FROM (SELECT *, CAST(len(list_filter(tok, lambda x: x = '{R.SEARCH_KEYWORD}')) AS DOUBLE) AS tf FROM sale_tok) t,
       (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(avg(len(tok)) AS DOUBLE) AS avgdl,
               CAST(count(*) FILTER (WHERE list_contains(tok, '{R.SEARCH_KEYWORD}')) AS DOUBLE) AS df
        FROM sale_tok) s""")

_LEN_H = int(R.ALERT_LENGTH.split()[0])
VIEWS["alert_windows"] = (("event_log",), f"""
  SELECT mid, window_start, window_start + INTERVAL {_LEN_H} HOUR AS window_end,
         count(DISTINCT uid) FILTER (WHERE event_name = 'coupon') AS coupon_accounts,
         count(*) AS n_events, bool_or(event_name = 'clickItem') AS clicked
  FROM (SELECT mid, uid, event_name, time_bucket(INTERVAL 1 HOUR, event_time) - to_hours(j) AS window_start
        FROM event_log, unnest(range(0, {_LEN_H})) AS r(j))
  GROUP BY mid, window_start""")
VIEWS["alerts"] = (("alert_windows",), f"""
  SELECT * FROM alert_windows WHERE coupon_accounts >= {R.ALERT_MIN_ACCOUNTS} AND NOT clicked""")
VIEWS["short_windows"] = (("event_log",), """
  SELECT mid, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
         count(DISTINCT uid) FILTER (WHERE event_name = 'coupon') AS coupon_accounts,
         count(*) AS n_events, bool_or(event_name = 'clickItem') AS clicked
  FROM (SELECT mid, uid, event_name, time_bucket(INTERVAL 6 SECOND, event_time) - to_seconds(6 * j) AS window_start
        FROM event_log, unnest(range(0, 50)) AS r(j))
  GROUP BY mid, window_start""")
VIEWS["short_alerts"] = (("short_windows",), f"""
  SELECT * FROM short_windows WHERE coupon_accounts >= {R.SHORT_MIN_ACCOUNTS} AND NOT clicked""")
VIEWS["alert_hits"] = (("alerts", "event_log"), """
  SELECT a.mid, a.window_start, a.window_end, e.event_id, e.uid, e.item_id, e.ts, e.event_name
  FROM alerts a JOIN event_log e
    ON e.mid = a.mid AND e.event_time >= a.window_start AND e.event_time < a.window_end""")


def _with(names: tuple[str, ...], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


def _hourly(src: str, date_col: str, hour_col: str, value: str, date: str, zero: str) -> str:
    from shoplens.functions.timeparts import previous_day
    y = previous_day(date)
    return f"""
SELECT h.hour, coalesce(t.v, {zero}) AS today, coalesce(y.v, {zero}) AS yesterday
FROM (SELECT lpad(CAST(i AS VARCHAR), 2, '0') AS hour FROM range(24) t(i)) h
LEFT JOIN (SELECT {hour_col} AS hour, {value} AS v FROM {src} WHERE {date_col} = '{date}' GROUP BY 1) t USING (hour)
LEFT JOIN (SELECT {hour_col} AS hour, {value} AS v FROM {src} WHERE {date_col} = '{y}' GROUP BY 1) y USING (hour)"""


_KPI_BASE = """
SELECT log_date, 'dau' AS id, '新增日活' AS name, CAST(dau AS VARCHAR) AS value FROM kpi_p
UNION ALL SELECT log_date, 'new_mid', '新增设备', CAST(new_mid AS VARCHAR) FROM kpi_p
UNION ALL SELECT log_date, 'order_amount', '新增交易额', CAST(order_amount AS VARCHAR) FROM kpi_p"""

VIEWS["kpi_p"] = (("dau", "order_info"), """
  SELECT d.log_date, coalesce(a.dau, 0) AS dau, coalesce(n.new_mid, 0) AS new_mid,
         coalesce(m.order_amount, CAST(0 AS DECIMAL(38,2))) AS order_amount
  FROM (SELECT log_date FROM dau UNION SELECT create_date FROM order_info) d
  LEFT JOIN (SELECT log_date, count(*) AS dau FROM dau GROUP BY 1) a USING (log_date)
  LEFT JOIN (SELECT log_date, count(*) AS new_mid FROM
               (SELECT mid, min(log_date) AS log_date FROM dau GROUP BY mid) GROUP BY 1) n USING (log_date)
  LEFT JOIN (SELECT create_date AS log_date, sum(total_amount) AS order_amount
             FROM order_info GROUP BY 1) m USING (log_date)""")

_ALERT_COLS = "mid, window_start, window_end, coupon_accounts, n_events"
_DAY_US = 86_400_000_000

SQL: dict[str, str] = {
    "dau_dedup": _with(("dau",), "SELECT * FROM dau"),
    "dau_total": _with(("dau",), "SELECT log_date, count(*) AS dau FROM dau GROUP BY 1"),
    "dau_hourly": _with(("dau",), "SELECT log_date, log_hour, count(*) AS dau FROM dau GROUP BY 1, 2"),
    "dau_for_date": _with(("dau",), f"""
SELECT '{R.DAU_DATE}' AS log_date, count(*) AS dau FROM dau WHERE log_date = '{R.DAU_DATE}'"""),
    "new_devices": _with(("dau",), """
SELECT log_date, count(*) AS new_mid FROM (SELECT mid, min(log_date) AS log_date FROM dau GROUP BY mid)
GROUP BY 1"""),
    "order_mask": _with(("order_info",), "SELECT * EXCLUDE (order_ts) FROM order_info"),
    "order_amount_total": _with(("order_info",), """
SELECT create_date, sum(total_amount) AS order_amount FROM order_info GROUP BY 1"""),
    "order_amount_hourly": _with(("order_info",), """
SELECT create_date, create_hour, sum(total_amount) AS order_amount FROM order_info GROUP BY 1, 2"""),
    "order_amount_for_date": _with(("order_info",), f"""
SELECT '{R.ORDER_DATE}' AS create_date, coalesce(sum(total_amount), 0) AS order_amount
FROM order_info WHERE create_date = '{R.ORDER_DATE}'"""),
    "order_amount_empty_day": _with(("order_info",), f"""
SELECT '{R.DAU_DATE}' AS create_date, coalesce(sum(total_amount), 0) AS order_amount
FROM order_info WHERE create_date = '{R.DAU_DATE}'"""),
    "order_rejects": """
SELECT CASE o_orderkey % 50 WHEN 0 THEN 'bad total_amount' WHEN 1 THEN 'bad create_time' WHEN 2 THEN 'missing: consignee'
            WHEN 3 THEN 'malformed json' ELSE 'null message' END AS reason, count(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 50 < 5 GROUP BY 1""",
    "sales_by_province": _with(("order_info",), """
SELECT create_date, province_id, sum(total_amount) AS order_amount, count(*) AS orders
FROM order_info GROUP BY 1, 2"""),
    "hourly_compare_dau": _with(("dau",), _hourly("dau", "log_date", "log_hour", "count(*)",
                                                  R.DAU_DATE, "0")),
    "hourly_compare_amount": _with(("order_info",), _hourly(
        "order_info", "create_date", "create_hour", "sum(total_amount)", R.ORDER_DATE,
        "CAST(0 AS DECIMAL(38,2))")),
    "kpi_panel": _with(("kpi_p",), _KPI_BASE),
    "kpi_panel_for_date": _with(("kpi_p",), f"""
SELECT * FROM ({_KPI_BASE}) WHERE log_date = '{R.DAU_DATE}'"""),
    "kpi_panel_order_day": _with(("kpi_p",), f"""
SELECT '{R.ORDER_DATE}' AS log_date, s.id, s.name, coalesce(k.value, '0') AS value
FROM (VALUES ('dau', '新增日活'), ('new_mid', '新增设备'), ('order_amount', '新增交易额')) AS s(id, name)
LEFT JOIN (SELECT * FROM ({_KPI_BASE}) WHERE log_date = '{R.ORDER_DATE}') k ON s.id = k.id"""),
    "coupon_alerts_5min": _with(("short_alerts",), f"SELECT {_ALERT_COLS} FROM short_alerts"),
    "coupon_alerts_5min_throttled": _with(("short_alerts",), f"""
SELECT mid || ':' || CAST(epoch_us(window_end) // 60000000 AS VARCHAR) AS doc_id, {_ALERT_COLS}
FROM (SELECT *, row_number() OVER (PARTITION BY mid, epoch_us(window_end) // 60000000
                                   ORDER BY window_end DESC, window_start DESC) AS rn FROM short_alerts)
WHERE rn = 1"""),
    "coupon_alert_windows": _with(("alert_windows",), f"SELECT {_ALERT_COLS}, clicked FROM alert_windows"),
    "coupon_alerts": _with(("alerts",), f"SELECT {_ALERT_COLS} FROM alerts"),
    "coupon_alerts_throttled": _with(("alerts",), f"""
SELECT mid || ':' || CAST(epoch_us(window_end) // {_DAY_US} AS VARCHAR) AS doc_id, {_ALERT_COLS}
FROM (SELECT *, row_number() OVER (PARTITION BY mid, epoch_us(window_end) // {_DAY_US}
                                   ORDER BY window_end DESC, window_start DESC) AS rn FROM alerts)
WHERE rn = 1"""),
    "coupon_alert_accounts": _with(("alert_hits",), """
SELECT DISTINCT mid, window_start, window_end, uid FROM alert_hits
WHERE event_name = 'coupon' AND uid IS NOT NULL"""),
    "coupon_alert_items": _with(("alert_hits",), """
SELECT DISTINCT mid, window_start, window_end, item_id FROM alert_hits WHERE event_name = 'coupon'"""),
    "coupon_alert_events": _with(("alert_hits",), """
SELECT mid, window_start, window_end, event_id, ts, event_name FROM alert_hits"""),
    "sale_wide": _with(("sale_bounded",), "SELECT * FROM sale_bounded"),
    "sale_wide_unbounded": _with(("sale",), "SELECT * FROM sale"),
    "sale_wide_as_of": _with(("sale",), _AS_OF.format("sale")),
    "sale_pairs_full": _with(("order_info", "order_detail"), """
SELECT o.id AS order_id, d.order_id AS detail_order_id, d.id AS order_detail_id
FROM order_info o FULL OUTER JOIN order_detail d ON o.id = d.order_id"""),
    "sale_search_total": _with(("matches",), "SELECT count(*) AS total FROM matches"),
    "sale_search_page": _with(("bm25",), f"""
SELECT * EXCLUDE (tok, tf, score), round(score, 6) AS score FROM bm25
WHERE dt = '{R.SEARCH_DATE}' AND list_contains(tok, '{R.SEARCH_KEYWORD}')
ORDER BY bm25.score DESC, order_id, order_detail_id
LIMIT {R.SEARCH_SIZE} OFFSET {(R.SEARCH_PAGE - 1) * R.SEARCH_SIZE}"""),
    "sale_search_page2": _with(("bm25",), f"""
SELECT * EXCLUDE (tok, tf, score), round(score, 6) AS score FROM bm25
WHERE dt = '{R.SEARCH_DATE}' AND list_contains(tok, '{R.SEARCH_KEYWORD}')
ORDER BY bm25.score DESC, order_id, order_detail_id LIMIT {R.SEARCH_SIZE} OFFSET {R.SEARCH_SIZE}"""),
    "sale_search_deep_page": _with(("bm25",), f"""
SELECT order_id, order_detail_id, dt, sku_name, round(score, 6) AS score FROM bm25
WHERE list_contains(tok, '{R.SEARCH_KEYWORD}')
ORDER BY bm25.score DESC, order_id, order_detail_id LIMIT {R.SEARCH_SIZE} OFFSET {(R.SEARCH_DEEP_PAGE - 1) * R.SEARCH_SIZE}"""),
    "log_route_substring": """
SELECT 'startup_log_topic' AS topic, count(*) AS n FROM events UNION ALL SELECT 'event_log_topic', count(*) FROM events""",
    "user_ages_today": _with(("user_info",), """
SELECT id, CAST(date_diff('day', birthday, current_date) // 365 AS INTEGER) AS age FROM user_info"""),
    "append_generated_ids": _with(("alerts",), "SELECT count(*) + 1 AS n_rows, count(*) + 1 AS n_ids FROM alerts"),
    "stream_log_archive": """
SELECT strftime(ts, '%Y-%m-%d') AS dt, k AS "logType", 'mid_' || CASE WHEN k = 'startup' THEN user_id ELSE user_id % 25 END AS mid,
       epoch_us(ts) // 1000 AS ts FROM events, (VALUES ('startup'), ('event')) AS kinds(k)""",
    "stream_consumer_group": """
SELECT CAST(epoch_us(ts) // 1000000 % 2 + 1 AS INTEGER) AS run, 'event' AS "logType", 'mid_' || user_id % 25 AS mid,
       epoch_us(ts) // 1000 AS ts FROM events""",
    "sale_search_two_tokens": _with(("sale_tok",), f"""
SELECT order_id, order_detail_id, sku_name FROM sale_tok WHERE dt = '{R.SEARCH_DATE}'
AND {" AND ".join(f"list_contains(tok, '{t}')" for t in R.SEARCH_TWO_TOKENS.split())}"""),
    "sale_search_bm25": _with(("bm25",), f"""
SELECT order_id, order_detail_id, dt, sku_name, round(score, 6) AS score FROM bm25
WHERE list_contains(tok, '{R.SEARCH_KEYWORD}')"""),
    "sale_gender_stats": _with(("matches",), """
SELECT '用户性别占比' AS title, CASE WHEN user_gender = 'M' THEN '男' ELSE '女' END AS name, n AS value,
       round(n / sum(n) OVER (), 6) AS share
FROM (SELECT user_gender, count(*) AS n FROM matches WHERE user_gender IS NOT NULL GROUP BY 1)"""),
    "sale_age_stats": _with(("matches",), """
SELECT '用户年龄占比' AS title, b.band_order, b.name, CAST(coalesce(p.value, 0) AS BIGINT) AS value,
       round(CASE WHEN sum(coalesce(p.value, 0)) OVER () > 0
                  THEN coalesce(p.value, 0) / sum(coalesce(p.value, 0)) OVER () ELSE 0 END, 6) AS share
FROM (VALUES (0, '20岁以下'), (1, '20岁到30岁'), (2, '30岁及以上')) AS b(band_order, name)
LEFT JOIN (SELECT CASE WHEN user_age < 20 THEN 0 WHEN user_age < 30 THEN 1 ELSE 2 END AS band_order,
                  sum(n) AS value
           FROM (SELECT user_age, count(*) AS n FROM matches WHERE user_age IS NOT NULL GROUP BY 1)
           GROUP BY 1) p USING (band_order)"""),
    "age_terms_top": _with(("sale",), """
SELECT user_age, count(*) AS value FROM sale WHERE user_age IS NOT NULL
GROUP BY 1 ORDER BY value DESC, user_age LIMIT 100"""),
    "cdc_insert_route": _with(("raw_order_info",), """
SELECT 'order_info_topic' AS topic, 'order_info' AS "table",
       CAST(json_object('id', id, 'province_id', province_id, 'consignee', consignee,
                        'consignee_tel', consignee_tel, 'order_status', order_status, 'user_id', user_id,
                        'total_amount', total_amount, 'create_time', create_time) AS VARCHAR) AS value
FROM raw_order_info
UNION ALL
SELECT 'order_detail_topic', 'order_detail',
       CAST(json_object('id', CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' ||
                              CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR),
                        'order_id', CAST(l_orderkey AS VARCHAR), 'sku_id', CAST(l_partkey AS VARCHAR),
                        'order_price', CAST(CAST(l_extendedprice AS DECIMAL(16,2)) AS VARCHAR),
                        'sku_num', CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)) AS VARCHAR)
FROM lineitem"""),
    "log_route": f"""
SELECT 'startup_log_topic' AS topic, event_id, 'startup' AS logType,
       'mid_' || CAST(user_id AS VARCHAR) AS mid, 'uid' || CAST(user_id AS VARCHAR) AS uid,
       CAST(NULL AS VARCHAR) AS eventId, CAST(NULL AS VARCHAR) AS itemId, epoch_us(ts) // 1000 AS ts
FROM events
UNION ALL
SELECT 'event_log_topic', event_id, 'event', 'mid_' || CAST(user_id % 25 AS VARCHAR),
       'uid' || CAST(user_id AS VARCHAR), {_EVENT_NAME}, json_extract_string(props, '$.k'), epoch_us(ts) // 1000
FROM events""",
    "stream_dau": """
SELECT 'mid_' || user_id AS mid, 'uid' || user_id AS uid, 'app' AS "appId", 'area_' || (user_id % 34) AS area,
       CASE WHEN user_id % 2 = 0 THEN 'ios' ELSE 'android' END AS os, 'ch_' || (user_id % 10) AS channel,
       'startup' AS "logType", '1.' || (user_id % 5) AS version, epoch_us(min(ts)) // 1000 AS ts,
       strftime(min(ts), '%Y-%m-%d') AS log_date, strftime(min(ts), '%H') AS log_hour
FROM events GROUP BY user_id, strftime(ts, '%Y-%m-%d')""",
    "stream_alerts": _with(("alerts",), f"SELECT {_ALERT_COLS} FROM alerts"),
    "stream_sale_wide": _with(("sale_bounded",), "SELECT * FROM sale_bounded"),
    "stream_sale_as_of": _with(("sale_bounded",), _AS_OF.format("sale_bounded")),
    "stream_alerts_throttled": None,
    "upsert_latest": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
}

SQL["stream_alerts_throttled"] = SQL["coupon_alerts_throttled"]
SQL["stream_dau_hourly"] = SQL["dau_hourly"]
SQL["stream_dau_counts"] = SQL["dau_hourly"]
SQL["stream_order_counts"] = SQL["order_amount_hourly"]
SQL["stream_alerts_from_logs"] = SQL["stream_alerts"]
SQL["stream_order_ingest"] = _with(("order_info",), "SELECT " + ", ".join(
    c if c in ("id", "province_id", "consignee", "consignee_tel", "order_status", "user_id", "total_amount", "create_time",
               "create_date", "create_hour") else f"CAST(NULL AS VARCHAR) AS {c}" for c in schemas.ORDER_TABLE) + " FROM order_info")
SQL["stream_order_redelivery"] = SQL["order_amount_total"]
SQL["sale_report_json"] = _with(("matches", "bm25"), f"""
SELECT (SELECT count(*) FROM matches) AS total,
       (SELECT coalesce(string_agg(order_detail_id, ',' ORDER BY score DESC, order_id, order_detail_id), '') FROM (
          SELECT score, order_id, order_detail_id FROM bm25 WHERE dt = '{R.SEARCH_DATE}' AND list_contains(tok, '{R.SEARCH_KEYWORD}')
          ORDER BY score DESC, order_id, order_detail_id LIMIT {R.SEARCH_SIZE})) AS detail_ids, title, name, value
FROM (SELECT '用户性别占比' AS title, CASE WHEN user_gender = 'M' THEN '男' ELSE '女' END AS name, count(*) AS value
      FROM matches WHERE user_gender IS NOT NULL GROUP BY 2
      UNION ALL
      SELECT '用户年龄占比', b.name, CAST(coalesce(p.value, 0) AS BIGINT)
      FROM (VALUES (0, '20岁以下'), (1, '20岁到30岁'), (2, '30岁及以上')) AS b(band_order, name)
      LEFT JOIN (SELECT CASE WHEN user_age < 20 THEN 0 WHEN user_age < 30 THEN 1 ELSE 2 END AS band_order, count(*) AS value
                 FROM matches WHERE user_age IS NOT NULL GROUP BY 1) p USING (band_order))""")
