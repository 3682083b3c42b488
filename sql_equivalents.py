"""The registered queries as SQL on the raw tables, for cross-checking."""

from __future__ import annotations

from visitlens.sources.dimensions import AREA_LEVELS, CITIES, OTHER_LEVEL

_TASK = "'task-1' AS taskid"

# The shop tables, derived from events, customer and part.
_ACTIONS = """
base AS (
  SELECT event_id, ts, user_id, event_type, date_trunc('second', ts) AS sec,
         strftime(ts, '%Y-%m-%d') AS day,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
actions AS (
  SELECT day AS date, user_id, user_id || '_' || day AS session_id, k % 10 AS page_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time, sec,
         CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN (k % 20) || ',' || ((k + 7) % 20) END
           AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN (k % 20) || ',' || ((k + 3) % 20) END
           AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_product_ids,
         user_id % 10 AS city_id, event_id
  FROM base
  WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2025-01-01')
"""
_USERS = """
users AS (
  SELECT c_custkey AS user_id, CAST(10 + c_custkey % 60 AS INTEGER) AS age,
         c_mktsegment AS professional, 'city' || c_nationkey AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer)
"""
_PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         CASE WHEN p_size % 2 = 0 THEN 'Self' ELSE 'Third Party' END AS product_status
  FROM part)
"""
_CITIES = "cities(city_id, city_name, area) AS (VALUES {})".format(
    ", ".join(f"({city_id}, '{name}', '{area}')" for city_id, name, area in CITIES)
)
_CLICKS = """
clicks AS (
  SELECT make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts, epoch_us(ts) // 1000 AS ts_millis,
         CAST(user_id % 10 AS VARCHAR) AS province, CAST(user_id % 10 AS VARCHAR) AS city,
         user_id, k % 20 AS ad_id
  FROM (SELECT ts, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events WHERE event_type = 'click'))
"""

# ---- areas

_AREA_CLICKS = """
area_clicks AS (
  SELECT city_id, click_product_id FROM actions
  WHERE click_product_id <> -1 AND click_product_id IS NOT NULL)
"""
_AREA_BASIC = """
area_basic AS (
  SELECT a.city_id, c.city_name, c.area, a.click_product_id AS product_id
  FROM area_clicks a JOIN cities c ON a.city_id = c.city_id)
"""
_AREA_COUNTS = """
area_counts AS (
  SELECT area, product_id, count(*) AS click_count,
         string_agg(DISTINCT city_id || ':' || city_name, ',' ORDER BY city_id || ':' || city_name)
           AS city_infos
  FROM area_basic GROUP BY area, product_id)
"""
_AREA_INFO = """
area_info AS (
  SELECT a.area, a.city_infos, a.product_id, a.click_count, p.product_name, p.product_status
  FROM area_counts a JOIN products p ON a.product_id = p.product_id)
"""
_LEVELS = "levels(area, area_level) AS (VALUES {})".format(
    ", ".join(f"('{area}', '{name}')" for name, areas in AREA_LEVELS.items() for area in areas)
)
_AREA_TOP = f"""
area_top AS (
  SELECT area, coalesce(area_level, '{OTHER_LEVEL}') AS area_level,
         product_id, city_infos, click_count, product_name, product_status
  FROM (SELECT *, rank() OVER (PARTITION BY area ORDER BY click_count DESC) AS r FROM area_info)
  LEFT JOIN levels USING (area)
  WHERE r <= 3)
"""
_AREA = [
    _ACTIONS, _CITIES, _PRODUCTS, _LEVELS, _AREA_CLICKS, _AREA_BASIC, _AREA_COUNTS, _AREA_INFO,
    _AREA_TOP,
]

# ---- page flow

_STEPS = """
flow(step, a, b) AS (VALUES (1, 1, 2), (2, 2, 3), (3, 3, 4), (4, 4, 5), (5, 5, 6), (6, 6, 7)),
pairs AS (
  SELECT page_id AS a,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY sec, event_id) AS b
  FROM actions),
counted AS (
  SELECT f.step, f.a, f.b, count(p.a) AS pair_count
  FROM flow f LEFT JOIN pairs p ON f.a = p.a AND f.b = p.b GROUP BY f.step, f.a, f.b),
steps AS (
  SELECT CAST(step AS INTEGER) AS step, a || '_' || b AS page_pair, pair_count,
         CAST(pair_count AS DOUBLE) / nullif(
           coalesce(lag(pair_count) OVER (ORDER BY step),
                    (SELECT count(*) FROM actions WHERE page_id = 1)), 0) AS rate
  FROM counted)
"""

# ---- sessions

_SESSIONS = """
sessions AS (
  SELECT s.*, u.age, u.professional, u.city, u.sex
  FROM (
    SELECT session_id, min(user_id) AS user_id, min(sec) AS start_ts,
           strftime(min(sec), '%Y-%m-%d %H:%M:%S') AS start_time,
           CAST(epoch(max(sec)) - epoch(min(sec)) AS BIGINT) AS visit_length,
           count(*) AS step_length,
           coalesce(list_sort(list(DISTINCT search_keyword)
             FILTER (WHERE search_keyword IS NOT NULL AND search_keyword <> '')), []) AS words,
           coalesce(list_sort(list(DISTINCT click_category_id)
             FILTER (WHERE click_category_id <> -1)), []) AS clicked
    FROM actions GROUP BY session_id) s
  JOIN users u ON s.user_id = u.user_id)
"""
_SESSION_COLUMNS = "session_id, user_id, start_time, visit_length, step_length"
_LISTS = """array_to_string(words, ',') AS search_keywords,
            array_to_string(clicked, ',') AS click_category_ids"""
_USER_COLUMNS = "age, professional, city, sex"
_SEARCHERS = """
  professional IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')
  AND list_has_any(words, ['kw1', 'kw2', 'kw3', 'kw4', 'kw5'])
  AND list_has_any(clicked, CAST([1, 2, 3, 4, 5, 6, 7, 8, 9] AS BIGINT[]))
"""
_MATCHING = """
matching AS (SELECT * FROM sessions WHERE age BETWEEN 20 AND 50 AND sex = 'male')
"""
_DETAIL = """
detail AS (SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM matching))
"""
_SESSION = [_ACTIONS, _USERS, _SESSIONS, _MATCHING, _DETAIL]


def _share(column: str, low: int, high: int | None, name: str) -> str:
    inside = f"{column} >= {low}" + ("" if high is None else f" AND {column} <= {high}")
    n = f"count(*) FILTER (WHERE {inside})"
    # HALF_UP to two decimals in whole numbers.
    return f"((200 * {n} + count(*)) // (2 * count(*))) / 100.0 AS {name}_ratio"


_RATIOS = ",\n".join(
    [
        _share("visit_length", 1, 3, "visit_length_1s_3s"),
        _share("visit_length", 4, 6, "visit_length_4s_6s"),
        _share("visit_length", 7, 9, "visit_length_7s_9s"),
        _share("visit_length", 10, 30, "visit_length_10s_30s"),
        _share("visit_length", 31, 60, "visit_length_30s_60s"),
        _share("visit_length", 61, 180, "visit_length_1m_3m"),
        _share("visit_length", 181, 600, "visit_length_3m_10m"),
        _share("visit_length", 601, 1800, "visit_length_10m_30m"),
        _share("visit_length", 1801, None, "visit_length_30m"),
        _share("step_length", 1, 3, "step_length_1_3"),
        _share("step_length", 4, 6, "step_length_4_6"),
        _share("step_length", 7, 9, "step_length_7_9"),
        _share("step_length", 10, 30, "step_length_10_30"),
        _share("step_length", 31, 60, "step_length_30_60"),
        _share("step_length", 61, None, "step_length_60"),
    ]
)

_QUOTA = """
hours AS (
  SELECT strftime(start_ts, '%Y-%m-%d') AS date, strftime(start_ts, '%H') AS hour,
         count(*) AS session_count
  FROM sessions GROUP BY ALL),
day_counts AS (
  SELECT date, sum(session_count) AS day_count FROM hours GROUP BY date),
quota AS (
  SELECT h.date, h.hour, h.session_count, CAST(d.day_count AS BIGINT) AS day_count,
         CAST(least(h.session_count,
           floor(CAST(h.session_count AS DOUBLE) / CAST(d.day_count AS DOUBLE)
                 * (3000 // (SELECT count(*) FROM day_counts)))) AS BIGINT) AS quota
  FROM hours h JOIN day_counts d ON h.date = d.date)
"""
_SAMPLE = """
ordered AS (
  SELECT s.*, strftime(start_ts, '%Y-%m-%d') AS date, strftime(start_ts, '%H') AS hour,
         row_number() OVER (
           PARTITION BY strftime(start_ts, '%Y-%m-%d'), strftime(start_ts, '%H')
           ORDER BY md5('7:' || session_id), session_id) AS position
  FROM sessions s),
sampled AS (
  SELECT o.* FROM ordered o JOIN quota q ON o.date = q.date AND o.hour = q.hour
  WHERE o.position <= q.quota)
"""

# ---- categories

_EVENTS_OF = """
category_events AS (
  SELECT session_id, 'click' AS kind, click_category_id AS category_id
  FROM detail WHERE click_category_id <> -1
  UNION ALL
  SELECT session_id, 'order', CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT)
  FROM detail WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT session_id, 'pay', CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT)
  FROM detail WHERE pay_category_ids IS NOT NULL)
"""
_TOTALS = """
totals AS (
  SELECT category_id, count(*) FILTER (WHERE kind = 'click') AS click_count,
         count(*) FILTER (WHERE kind = 'order') AS order_count,
         count(*) FILTER (WHERE kind = 'pay') AS pay_count
  FROM category_events GROUP BY category_id)
"""
_TOP_CATEGORIES = """
top_categories AS (
  SELECT * FROM totals
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10)
"""
_CATEGORY = [*_SESSION, _EVENTS_OF, _TOTALS, _TOP_CATEGORIES]


def _kind_count(kind: str) -> str:
    return (
        f"SELECT category_id, count(*) AS {kind}_count FROM category_events "
        f"WHERE kind = '{kind}' GROUP BY category_id"
    )


# ---- ads

_DAILY = """
daily AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id AS userid, ad_id AS adid,
         count(*) AS "clickCount"
  FROM clicks GROUP BY ALL),
blacklist AS (
  SELECT min(date) AS date, userid FROM daily WHERE "clickCount" >= 2 GROUP BY userid)
"""
_STAT = """
stat AS (
  SELECT strftime(ts, '%Y%m%d') AS date, province, city, ad_id AS adid,
         count(*) AS "clickCount"
  FROM clicks GROUP BY ALL),
per_ad AS (
  SELECT date, province, adid, CAST(sum("clickCount") AS BIGINT) AS "clickCount"
  FROM stat GROUP BY date, province, adid)
"""
_MINUTES = """
minutes AS (
  SELECT date_trunc('minute', ts) AS m, ad_id AS adid, count(*) AS "clickCount"
  FROM clicks GROUP BY ALL)
"""
_TREND_COLUMNS = """strftime(m, '%Y%m%d') AS date, strftime(m, '%H') AS hour,
  strftime(m, '%M') AS minute, adid, "clickCount" """
_AD = [_CLICKS, _DAILY, _STAT, _MINUTES]


def _province_top(partition: str) -> str:
    return f"""SELECT date, province, adid, "clickCount" FROM (
      SELECT *, row_number() OVER (
        PARTITION BY {partition} ORDER BY "clickCount" DESC, adid, date) AS r
      FROM per_ad) WHERE r <= 3"""


# ---- merges

_HALVES = """
early AS (SELECT * FROM clicks WHERE ts < TIMESTAMP '2024-01-16'),
late AS (SELECT * FROM clicks WHERE ts >= TIMESTAMP '2024-01-16')
"""


def _with(parts: list[str], body: str) -> str:
    return "WITH " + ",".join(parts) + body


SQL_EQUIVALENTS = {
    "area_top3_products": _with(_AREA, "SELECT * FROM area_top"),
    "area_click_actions": _with(_AREA, "SELECT * FROM area_clicks"),
    "area_product_basic": _with(_AREA, "SELECT * FROM area_basic"),
    "area_product_click_count": _with(_AREA, "SELECT * FROM area_counts"),
    "area_product_info": _with(_AREA, "SELECT * FROM area_info"),
    "area_top3_sql": _with(_AREA, "SELECT * FROM area_top"),
    "area_top3_product_result": _with(
        _AREA,
        f"""SELECT {_TASK}, area, area_level AS "areaLevel", product_id AS productid,
            city_infos AS "cityInfos", click_count AS "clickCount",
            product_name AS "productName", product_status AS "productStatus" FROM area_top""",
    ),
    "page_flow_steps": _with([_ACTIONS, _STEPS], "SELECT * FROM steps"),
    "page_flow_conversion": _with(
        [_ACTIONS, _STEPS],
        f"""SELECT {_TASK}, string_agg(page_pair || '=' || coalesce(CAST(rate AS VARCHAR), 'null'),
            '|' ORDER BY step) AS "rateStr" FROM steps""",
    ),
    "session_aggregate": _with(
        _SESSION, f"SELECT {_SESSION_COLUMNS}, {_LISTS}, {_USER_COLUMNS} FROM sessions"
    ),
    "session_terms_long": _with(
        [_ACTIONS],
        """SELECT DISTINCT session_id, 'word' AS kind, search_keyword AS value
           FROM actions WHERE search_keyword <> ''
           UNION ALL
           SELECT DISTINCT session_id, 'category', CAST(click_category_id AS VARCHAR)
           FROM actions WHERE click_category_id <> -1""",
    ),
    "session_filter": _with(
        _SESSION,
        f"SELECT {_SESSION_COLUMNS}, {_LISTS}, {_USER_COLUMNS} FROM sessions WHERE {_SEARCHERS}",
    ),
    "matching_sessions": _with(
        _SESSION, f"SELECT {_SESSION_COLUMNS}, {_USER_COLUMNS} FROM sessions WHERE {_SEARCHERS}"
    ),
    "sessions_of_cities": _with(
        _SESSION,
        f"""SELECT {_SESSION_COLUMNS}, {_USER_COLUMNS} FROM sessions
            WHERE city IN ('city1', 'city3', 'city7', 'city12')""",
    ),
    "session_bucket_ratios": _with(
        _SESSION, f"SELECT {_TASK}, count(*) AS session_count, {_RATIOS} FROM matching"
    ),
    "filtered_session_detail": _with(_SESSION, "SELECT * EXCLUDE (sec) FROM detail"),
    "session_sample_quota": _with([*_SESSION, _QUOTA], "SELECT * FROM quota"),
    "session_stratified_sample": _with(
        [*_SESSION, _QUOTA, _SAMPLE],
        f"""SELECT {_TASK}, session_id AS sessionid, start_time AS "startTime",
            array_to_string(words, ',') AS "searchKeywords",
            array_to_string(clicked, ',') AS "clickCategoryIds" FROM sampled""",
    ),
    "category_click_count": _with(_CATEGORY, _kind_count("click")),
    "category_order_count": _with(_CATEGORY, _kind_count("order")),
    "category_pay_count": _with(_CATEGORY, _kind_count("pay")),
    "session_category_counts": _with(
        _CATEGORY,
        """SELECT session_id, category_id, count(*) FILTER (WHERE kind = 'click') AS click_count,
           count(*) FILTER (WHERE kind = 'order') AS order_count,
           count(*) FILTER (WHERE kind = 'pay') AS pay_count
           FROM category_events GROUP BY session_id, category_id""",
    ),
    "category_full_counts": _with(_CATEGORY, "SELECT * FROM totals"),
    "top_categories": _with(
        _CATEGORY,
        f"""SELECT {_TASK}, category_id AS categoryid, click_count AS "clickCount",
            order_count AS "orderCount", pay_count AS "payCount" FROM top_categories""",
    ),
    "top_sessions_per_category": _with(
        _CATEGORY,
        f"""SELECT {_TASK}, category_id AS categoryid, session_id AS sessionid,
            n AS "clickCount" FROM (
              SELECT category_id, session_id, count(*) AS n,
                     row_number() OVER (PARTITION BY category_id
                                        ORDER BY count(*) DESC, session_id) AS r
              FROM category_events
              WHERE kind = 'click' AND category_id IN (SELECT category_id FROM top_categories)
              GROUP BY category_id, session_id) WHERE r <= 10""",
    ),
    "parse_ad_log": _with(
        _AD, "SELECT ts_millis, province, city, user_id, ad_id FROM clicks"
    ),
    "ad_user_daily_clicks": _with(_AD, "SELECT * FROM daily"),
    "ad_blacklist_update": _with(_AD, "SELECT * FROM blacklist"),
    "ad_blacklist_filter": _with(
        _AD,
        """SELECT ts_millis, province, city, user_id, ad_id FROM clicks
           WHERE user_id NOT IN (SELECT userid FROM blacklist)""",
    ),
    "ad_realtime_stat": _with(_AD, "SELECT * FROM stat"),
    "ad_province_top3": _with(_AD, _province_top("date, province")),
    "ad_province_top3_overall": _with(_AD, _province_top("province")),
    "ad_minute_counts": _with(_AD, f"SELECT {_TREND_COLUMNS} FROM minutes"),
    "ad_click_trend": _with(
        _AD,
        f"""SELECT {_TREND_COLUMNS} FROM minutes
            WHERE m >= (SELECT date_trunc('minute', max(ts)) FROM clicks) - INTERVAL 59 MINUTE""",
    ),
    "ad_click_trend_days": _with(
        _AD,
        f"""SELECT {_TREND_COLUMNS} FROM minutes
            WHERE m >= (SELECT date_trunc('minute', max(ts)) FROM clicks)
                - INTERVAL {5 * 24 * 60 - 1} MINUTE""",
    ),
    "ad_trend_windows": _with(
        _AD,
        f"""SELECT strftime(seen, '%Y%m%d%H%M') AS window_end, {_TREND_COLUMNS}
            FROM (SELECT *, m + to_minutes(unnest(range(1, 61))) AS seen FROM minutes)""",
    ),
    "upsert_add": _with(
        [_CLICKS, _HALVES],
        """SELECT user_id AS userid, ad_id AS adid, count(*) AS "clickCount"
           FROM clicks GROUP BY ALL""",
    ),
    "upsert_replace": _with(
        [_CLICKS, _HALVES],
        """, e AS (SELECT strftime(ts, '%H') AS hour, ad_id AS adid, count(*) AS n
                   FROM early GROUP BY ALL),
             l AS (SELECT strftime(ts, '%H') AS hour, ad_id AS adid, count(*) AS n
                   FROM late GROUP BY ALL)
           SELECT hour, adid, coalesce(l.n, e.n) AS "clickCount"
           FROM e FULL JOIN l USING (hour, adid)""",
    ),
    "replace_group": _with(
        [_CLICKS, _HALVES],
        """, e AS (SELECT strftime(ts, '%H') AS hour, user_id AS userid, ad_id AS adid,
                          count(*) AS "clickCount" FROM early GROUP BY ALL),
             l AS (SELECT strftime(ts, '%H') AS hour, user_id AS userid, ad_id AS adid,
                          count(*) AS "clickCount" FROM late GROUP BY ALL)
           SELECT * FROM l
           UNION ALL
           SELECT * FROM e
           WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.hour = e.hour AND l.userid = e.userid)""",
    ),
    "insert_new": _with(
        [_CLICKS, _HALVES],
        """SELECT user_id AS userid, strftime(min(ts), '%Y-%m-%d') AS date
           FROM clicks GROUP BY user_id""",
    ),
}

# The streams hold the same as the batch forms.
for _stream, _batch in {
    "stream_realtime_stat": "ad_realtime_stat",
    "stream_user_daily_clicks": "ad_user_daily_clicks",
    "stream_blacklist_update": "ad_blacklist_update",
    "stream_click_trend": "ad_minute_counts",
    "stream_province_top3": "ad_province_top3",
}.items():
    SQL_EQUIVALENTS[_stream] = SQL_EQUIVALENTS[_batch]


# ---- streams of many batches: the part of the time of arrival is the batch

_PARTS = 6
_LATE = "CASE WHEN user_id % 9 = 0 THEN 8 * 86400000 ELSE 0 END"


def _parts(delay: str) -> str:
    return f"""
parts AS (
  SELECT *, (arrival - min(arrival) OVER ()) * {_PARTS}
            // (max(arrival) OVER () - min(arrival) OVER () + 1) AS part
  FROM (SELECT *, ts_millis + {delay} AS arrival FROM clicks))
"""


# A user is listed by the first part after which some (day, ad) has two clicks; until then
# no click of the user is filtered, so the raw running counts tell that part.
_FEEDBACK = """
by_part AS (
  SELECT part, strftime(ts, '%Y-%m-%d') AS date, user_id, ad_id, count(*) AS n
  FROM parts GROUP BY ALL),
running AS (
  SELECT *, sum(n) OVER (PARTITION BY date, user_id, ad_id ORDER BY part) AS total FROM by_part),
listed AS (
  SELECT user_id, min(part) AS since, arg_min(date, (part, date)) AS date
  FROM running WHERE total >= 2 GROUP BY user_id),
kept AS (
  SELECT parts.* FROM parts LEFT JOIN listed USING (user_id)
  WHERE since IS NULL OR part <= since),
kept_stat AS (
  SELECT strftime(ts, '%Y%m%d') AS date, province, city, ad_id AS adid, count(*) AS n
  FROM kept GROUP BY ALL)
"""
_FEEDBACK_PARTS = [_CLICKS, _parts("0"), _FEEDBACK]
SQL_EQUIVALENTS |= {
    "stream_feedback_blacklist": _with(
        _FEEDBACK_PARTS, "SELECT date, user_id AS userid FROM listed"
    ),
    "stream_feedback_stat": _with(
        _FEEDBACK_PARTS, 'SELECT date, province, city, adid, n AS "clickCount" FROM kept_stat'
    ),
    "stream_feedback_top3": _with(
        _FEEDBACK_PARTS,
        """SELECT date, province, adid, sum(n)::BIGINT AS "clickCount"
           FROM kept_stat GROUP BY date, province, adid
           QUALIFY row_number() OVER (
             PARTITION BY date, province ORDER BY sum(n) DESC, adid) <= 3""",
    ),
    "stream_feedback_trend": _with(
        _FEEDBACK_PARTS,
        """SELECT strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour,
                  strftime(ts, '%M') AS minute, ad_id AS adid, count(*) AS "clickCount"
           FROM kept GROUP BY ALL""",
    ),
}
for _name in ("stat", "blacklist"):  # a restart changes nothing
    SQL_EQUIVALENTS[f"stream_restart_{_name}"] = SQL_EQUIVALENTS[f"stream_feedback_{_name}"]


def _closing(unit: str) -> list[str]:
    """Batches of the closing streams: a run over parts 0 to 2 ends with a batch without
    clicks that closes what its watermark allows; so does the one over the others.

    A batch works with the newest click of all batches before it, less two days, as
    watermark. It drops clicks of units that ended by the watermark of the batch before.
    """
    return [
        _CLICKS,
        _parts(_LATE),
        f"""
newest AS (SELECT part + CASE WHEN part >= 3 THEN 1 ELSE 0 END AS batch, max(ts_millis) AS newest
           FROM parts GROUP BY part),
batches AS (
  SELECT b.batch, max(n.newest) - 2 * 86400000 AS watermark
  FROM (SELECT unnest(range({_PARTS} + 2)) AS batch) b LEFT JOIN newest n ON n.batch < b.batch
  GROUP BY b.batch),
marked AS (
  SELECT p.*, date_trunc('{unit}', p.ts) AS unit,
         epoch_ms(date_trunc('{unit}', p.ts) + INTERVAL 1 {unit})
           <= coalesce(w.watermark, -1) AS late
  FROM parts p LEFT JOIN batches w
    ON w.batch = part + CASE WHEN part >= 3 THEN 1 ELSE 0 END - 1),
final AS (SELECT make_timestamp(max(watermark) * 1000) AS watermark FROM batches)
""",
    ]


SQL_EQUIVALENTS |= {
    "stream_closed_windows": _with(
        _closing("minute"),
        """SELECT strftime(seen, '%Y%m%d%H%M') AS window_end, strftime(unit, '%Y%m%d') AS date,
                  strftime(unit, '%H') AS hour, strftime(unit, '%M') AS minute, adid, "clickCount"
           FROM (SELECT unit, ad_id AS adid, count(*) AS "clickCount",
                        unit + to_minutes(unnest(range(1, 61))) AS seen
                 FROM marked WHERE NOT late GROUP BY unit, ad_id)
           WHERE seen <= (SELECT watermark FROM final)""",
    ),
    "stream_late_clicks": _with(
        _closing("minute"),
        "SELECT ts_millis, province, city, user_id, ad_id FROM marked WHERE late",
    ),
    "stream_closed_days": _with(
        _closing("day"),
        """SELECT strftime(unit, '%Y%m%d') AS date, province, city, ad_id AS adid,
                  count(*) AS "clickCount"
           FROM marked WHERE NOT late AND unit + INTERVAL 1 DAY <= (SELECT watermark FROM final)
           GROUP BY ALL""",
    ),
}


# ---- tables of the catalog, and whole jobs over them

SQL_EQUIVALENTS |= {
    "catalog_actions": _with(
        [_ACTIONS],
        """SELECT event_id, date, user_id, session_id, page_id, action_time FROM actions
           WHERE date BETWEEN '2024-01-15' AND '2024-01-17'""",
    ),
    "bucketed_sessions_of_users": _with(
        _SESSION, f"SELECT {_SESSION_COLUMNS}, {_USER_COLUMNS} FROM sessions"
    ),
    "bucketed_user_lookup": _with(
        [_ACTIONS],
        """SELECT session_id, min(user_id) AS user_id,
                  strftime(min(sec), '%Y-%m-%d %H:%M:%S') AS start_time,
                  CAST(epoch(max(sec)) - epoch(min(sec)) AS BIGINT) AS visit_length,
                  count(*) AS step_length
           FROM actions GROUP BY session_id HAVING min(user_id) IN (1, 7, 11)""",
    ),
    "category_users": _with(
        [_ACTIONS],
        """SELECT category_id, chunk, count(*) AS n_values,
                  string_agg(user_id::VARCHAR, ',' ORDER BY user_id) AS text
           FROM (SELECT *, (row_number() OVER (
                          PARTITION BY category_id ORDER BY user_id) - 1) // 25 AS chunk
                 FROM (SELECT DISTINCT click_category_id AS category_id, user_id
                       FROM actions WHERE click_category_id <> -1))
           GROUP BY category_id, chunk""",
    ),
}
for _again, _first in {
    "session_bucket_ratios_observed": "session_bucket_ratios",
    "partition_writes": "ad_user_daily_clicks",
    "stream_partition_writes": "parse_ad_log",
    "job_session_aggr_stat": "session_bucket_ratios",
    "job_session_random_extract": "session_stratified_sample",
    "job_top10_session": "top_sessions_per_category",
    "job_page_split": "page_flow_conversion",
    "job_area_top3": "area_top3_product_result",
}.items():
    SQL_EQUIVALENTS[_again] = SQL_EQUIVALENTS[_first]
