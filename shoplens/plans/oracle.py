"""Independent DuckDB SQL for every catalogue key.

Each statement starts from the driver's views (``events``, ``customer``, ``part``) and rebuilds
the adapter tables as CTEs, then states the operator's result declaratively.
"""

from __future__ import annotations

# Fixed values, written out here so that a wrong value in the operators shows: cities, area levels, buckets.
_CITY_VALUES = """(0::BIGINT, '北京', '华北'), (1, '上海', '华东'), (2, '南京', '华东'), (3, '广州', '华南'),
  (4, '三亚', '华南'), (5, '武汉', '华中'), (6, '长沙', '华中'), (7, '西安', '西北'), (8, '成都', '西南'),
  (9, '哈尔滨', '东北')"""
_LEVEL_VALUES = """('华北', 'A_Level'), ('华东', 'A_Level'), ('华中', 'B_Level'), ('华南', 'B_Level'),
  ('西南', 'C_Level'), ('西北', 'C_Level')"""
VISIT_BUCKETS = [("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30), ("30s_60s", 31, 60),
                 ("1m_3m", 61, 180), ("3m_10m", 181, 600), ("10m_30m", 601, 1800), ("30m", 1801, None)]
STEP_BUCKETS = [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 31, 60), ("60", 61, None)]

ADAPTERS = f"""
base AS (
  SELECT e.event_id, e.user_id, e.event_type,
         CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) AS k,
         CASE e.user_id % 3 WHEN 0 THEN day(e.ts)
              WHEN 1 THEN CAST(floor((day(e.ts) - 1) / 7) AS INTEGER) * 7 + 1 ELSE 1 END AS d0,
         (e.user_id % 22) * 3600
           + CAST(floor(e.value * (CASE e.user_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 10 END)) AS BIGINT) AS sec
  FROM events e),
user_visit_action AS (
  SELECT CAST(make_date(2024, 1, d0) AS VARCHAR) AS date,
         user_id,
         concat('u', CAST(user_id AS VARCHAR), '-d', CAST(d0 AS VARCHAR)) AS session_id,
         event_id % 10 AS page_id,
         CAST(make_date(2024, 1, d0) AS TIMESTAMP) + to_seconds(sec) AS action_time,
         CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 12 AS VARCHAR)) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN (event_id * 13) % 120 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'signup'
              THEN concat(CAST(k AS VARCHAR), ',', CAST((k * 7 + 1) % 100 AS VARCHAR)) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 120 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id % 120 AS VARCHAR) END AS pay_product_ids,
         event_id % 10 AS city_id
  FROM base),
user_info AS (
  SELECT c_custkey AS user_id, concat('user', CAST(c_custkey AS VARCHAR)) AS username, c_name AS name,
         CAST((c_custkey * 7) % 60 AS INTEGER) AS age,
         concat('professional', CAST(c_custkey % 100 AS VARCHAR)) AS professional,
         concat('city', CAST(c_nationkey AS VARCHAR)) AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         concat('{{"product_status": ', CAST(p_size % 2 AS VARCHAR), '}}') AS extend_info
  FROM part),
ad_log AS (
  SELECT concat(CAST(epoch_us(ts) // 1000 AS VARCHAR), ' ', CAST(user_id % 5 AS VARCHAR), ' ',
                CAST(user_id % 10 AS VARCHAR), ' ',
                CAST(CASE WHEN event_id % 4 = 0 THEN user_id % 3 ELSE user_id END AS VARCHAR), ' ',
                CAST(CASE WHEN event_id % 4 = 0 THEN 0
                          ELSE CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 20 END AS VARCHAR)) AS value
  FROM events WHERE event_type IN ('click', 'view')),
city_area AS (
  SELECT * FROM (VALUES {_CITY_VALUES}) t(city_id, city_name, area)),
actions AS (SELECT * FROM user_visit_action),
dated AS (SELECT * FROM user_visit_action WHERE date BETWEEN '2024-01-01' AND '2024-01-20')"""


def sql(ctes: str, select: str) -> str:
    more = (",\n" + ctes.strip().rstrip(",")) if ctes.strip() else ""
    return f"WITH {ADAPTERS.strip()}{more}\n{select.strip()}"


ORACLE: dict[str, str] = {}


def oracle(name: str, ctes: str, select: str) -> None:
    ORACLE[name] = sql(ctes, select)


# ---------------------------------------------------------------- scans / area top-3
oracle("action_scan", "", "SELECT * FROM dated")
oracle("click_scan", "", "SELECT city_id, click_product_id FROM dated WHERE click_product_id <> -1")

_AREA_CTES = f"""
clicked AS (
  SELECT city_id, city_name, area, click_product_id AS pid, city_id::VARCHAR || ':' || city_name AS city
  FROM actions JOIN city_area USING (city_id) WHERE click_product_id <> -1),
sold AS (
  SELECT area, pid, count(*) AS click_count, array_to_string(list_sort(list_distinct(list(city))), ',') AS city_infos
  FROM clicked GROUP BY ALL),
goods AS (
  SELECT product_id AS pid, product_name,
         CASE json_extract_string(extend_info, '$.product_status') WHEN '0' THEN 'Self' ELSE 'Third Party' END
           AS product_status
  FROM product_info),
known AS (SELECT * FROM sold JOIN goods USING (pid)),
leaders AS (
  SELECT area, coalesce(level, 'D_Level') AS area_level, pid, city_infos, click_count, product_name, product_status
  FROM known LEFT JOIN (VALUES {_LEVEL_VALUES}) levels(area, level) USING (area)
  QUALIFY row_number() OVER (PARTITION BY area ORDER BY click_count DESC, pid) <= 3)"""

oracle("area_click_basic", _AREA_CTES, "SELECT city_id, city_name, area, pid FROM clicked")
oracle("area_click_count", _AREA_CTES, "SELECT area, pid, click_count, city_infos FROM sold")
oracle("group_concat_distinct", _AREA_CTES, """
SELECT area, array_to_string(list_sort(list_distinct(list(city))), ',') AS city_infos FROM clicked GROUP BY area""")
oracle("area_product_info", _AREA_CTES,
       "SELECT area, city_infos, pid, product_name, product_status, click_count FROM known")
oracle("area_top3", _AREA_CTES, "SELECT * FROM leaders")
oracle("area_top3_sql", _AREA_CTES, "SELECT * FROM leaders")


# ---------------------------------------------------------------- sessions
def _bucket_case(col: str, buckets) -> str:
    parts = []
    for name, lo, hi in buckets:
        cond = f"{col} >= {lo}" if hi is None else f"{col} BETWEEN {lo} AND {hi}"
        parts.append(f"WHEN {cond} THEN '{name}'")
    return "CASE " + " ".join(parts) + " END"


_VISIT = _bucket_case("visit_length", VISIT_BUCKETS)
_STEP = _bucket_case("step_length", STEP_BUCKETS)

_SESSION_CTES = """
summary AS (
  SELECT session_id, min(user_id) AS user_id, min(action_time) AS start_time,
         CAST(date_diff('second', min(action_time), max(action_time)) AS BIGINT) AS visit_length,
         count(*) AS step_length,
         string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword)
           FILTER (WHERE search_keyword <> '') AS search_keywords,
         nullif(array_to_string(list_sort(list_distinct(
           list(click_category_id) FILTER (WHERE click_category_id <> -1))), ','), '') AS click_category_ids,
         list_distinct(list(search_keyword) FILTER (WHERE search_keyword <> '')) AS kw_list,
         list_distinct(list(click_category_id) FILTER (WHERE click_category_id <> -1)) AS cat_list
  FROM actions GROUP BY session_id),
enriched AS (
  SELECT s.session_id, s.user_id, s.start_time, s.visit_length, s.step_length, s.search_keywords,
         s.click_category_ids, u.age, u.professional, u.sex, u.city, s.kw_list, s.cat_list
  FROM summary s JOIN user_info u ON s.user_id = u.user_id),
S AS (SELECT * FROM enriched WHERE age BETWEEN 20 AND 50 AND sex = 'male'),
FA AS (SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM S))"""

_SUMMARY_COLS = ("session_id, user_id, start_time, visit_length, step_length, search_keywords, "
                 "click_category_ids")
_ENRICHED_COLS = _SUMMARY_COLS + ", age, professional, sex, city"

oracle("session_summary", _SESSION_CTES, f"SELECT {_SUMMARY_COLS} FROM summary")
oracle("session_summary_table", _SESSION_CTES, f"SELECT {_SUMMARY_COLS} FROM summary")
oracle("session_enriched", _SESSION_CTES, f"SELECT {_ENRICHED_COLS} FROM enriched")
oracle("session_filter_age", _SESSION_CTES,
       "SELECT session_id, user_id FROM enriched WHERE age BETWEEN 20 AND 50")
_PROFS = ", ".join(f"'professional{i}'" for i in range(1, 41))
oracle("session_filter_in", _SESSION_CTES,
       f"SELECT session_id, user_id FROM enriched WHERE professional IN ({_PROFS}) "
       "AND city IN ('city1', 'city2', 'city3')")
oracle("session_filter_sex", _SESSION_CTES,
       "SELECT session_id, user_id FROM enriched WHERE sex = 'male'")
_CATS = ", ".join(str(i) for i in range(1, 31))
oracle("session_filter_overlap", _SESSION_CTES,
       "SELECT session_id, user_id FROM enriched WHERE list_has_any(kw_list, ['kw1', 'kw2']) "
       f"AND list_has_any(cat_list, [{_CATS}])")
oracle("session_filtered", _SESSION_CTES, f"SELECT {_ENRICHED_COLS} FROM S")
oracle("session_histogram", _SESSION_CTES, f"""
SELECT 'visit_length' AS kind, {_VISIT} AS bucket, count(*) AS cnt FROM S
WHERE {_VISIT} IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'step_length' AS kind, {_STEP} AS bucket, count(*) AS cnt FROM S
WHERE {_STEP} IS NOT NULL GROUP BY 2""")


def _ratio(n: str, d: str) -> str:
    return (f"CASE WHEN {d} = 0 THEN 0.0::DOUBLE "
            f"ELSE ((200 * {n} + {d}) // (2 * {d})) / 100.0::DOUBLE END")


_ratio_cols = ",\n       ".join(
    [_ratio(f"count(*) FILTER (WHERE vb = '{n}')", "count(*)") + f" AS visit_length_{n}_ratio"
     for n, _, _ in VISIT_BUCKETS]
    + [_ratio(f"count(*) FILTER (WHERE sb = '{n}')", "count(*)") + f" AS step_length_{n}_ratio"
       for n, _, _ in STEP_BUCKETS])
oracle("session_stat_ratio", _SESSION_CTES, f"""
SELECT count(*) AS session_count,
       {_ratio_cols}
FROM (SELECT {_VISIT} AS vb, {_STEP} AS sb FROM S)""")

# ---------------------------------------------------------------- sampling
_SAMPLE_CTES = _SESSION_CTES + """,
hours AS (
  SELECT strftime(start_time, '%Y-%m-%d') AS date, strftime(start_time, '%H') AS hour,
         count(*) AS cnt
  FROM S GROUP BY 1, 2),
quota AS (
  SELECT date, hour, cnt, CAST(sum(cnt) OVER (PARTITION BY date) AS BIGINT) AS day_cnt,
         CAST(least(cnt, (cnt * (300 // (SELECT count(DISTINCT date) FROM hours)))
                         // sum(cnt) OVER (PARTITION BY date)) AS BIGINT) AS quota
  FROM hours),
ex AS (
  SELECT session_id, start_time, search_keywords, click_category_ids FROM (
    SELECT s.*, q.quota,
           row_number() OVER (PARTITION BY q.date, q.hour
                              ORDER BY md5(s.session_id || '-42'), s.session_id) AS rn
    FROM S s JOIN quota q
      ON strftime(s.start_time, '%Y-%m-%d') = q.date AND strftime(s.start_time, '%H') = q.hour)
  WHERE rn <= quota)"""

oracle("session_hour_count", _SAMPLE_CTES, "SELECT * FROM hours")
oracle("session_extract_quota", _SAMPLE_CTES, "SELECT * FROM quota")
oracle("session_extract", _SAMPLE_CTES, "SELECT * FROM ex")
oracle("session_extract_detail", _SAMPLE_CTES, """
SELECT session_id, user_id, page_id, action_time, search_keyword, click_category_id,
       click_product_id, order_category_ids, order_product_ids, pay_category_ids, pay_product_ids
FROM actions WHERE session_id IN (SELECT session_id FROM ex)""")

# ---------------------------------------------------------------- categories
_CATEGORY_CTES = _SESSION_CTES + """,
kinds AS (
  SELECT click_category_id AS category_id, 1 AS c, 0 AS o, 0 AS p FROM FA WHERE click_category_id <> -1
  UNION ALL
  SELECT CAST(trim(x) AS BIGINT), 0, 1, 0
  FROM (SELECT unnest(string_split(order_category_ids, ',')) AS x FROM FA
        WHERE order_category_ids IS NOT NULL) WHERE trim(x) <> ''
  UNION ALL
  SELECT CAST(trim(x) AS BIGINT), 0, 0, 1
  FROM (SELECT unnest(string_split(pay_category_ids, ',')) AS x FROM FA
        WHERE pay_category_ids IS NOT NULL) WHERE trim(x) <> ''),
funnel AS (
  SELECT category_id, CAST(sum(c) AS BIGINT) AS click_count, CAST(sum(o) AS BIGINT) AS order_count,
         CAST(sum(p) AS BIGINT) AS pay_count
  FROM kinds GROUP BY category_id),
top10 AS (
  SELECT * FROM funnel
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10),
sess_cat AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count
  FROM FA WHERE click_category_id IN (SELECT category_id FROM top10)
  GROUP BY 1, 2)"""

oracle("filtered_actions", _CATEGORY_CTES, """
SELECT session_id, action_time, page_id, click_category_id, order_category_ids, pay_category_ids
FROM FA""")
oracle("category_click_count", _CATEGORY_CTES,
       "SELECT category_id, count(*) AS cnt FROM kinds WHERE c = 1 GROUP BY 1")
oracle("category_order_count", _CATEGORY_CTES,
       "SELECT category_id, count(*) AS cnt FROM kinds WHERE o = 1 GROUP BY 1")
oracle("category_pay_count", _CATEGORY_CTES,
       "SELECT category_id, count(*) AS cnt FROM kinds WHERE p = 1 GROUP BY 1")
oracle("active_categories", _CATEGORY_CTES, "SELECT DISTINCT category_id FROM kinds")
oracle("category_funnel", _CATEGORY_CTES, "SELECT * FROM funnel")
oracle("top10_category", _CATEGORY_CTES, "SELECT * FROM top10")
oracle("session_category_count", _CATEGORY_CTES, "SELECT * FROM sess_cat")
oracle("top_sessions_per_category", _CATEGORY_CTES, """
SELECT category_id, session_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rn
  FROM sess_cat) WHERE rn <= 10""")

# ---------------------------------------------------------------- page flow
_FLOW = [1, 2, 3, 4, 5, 6, 7]
_STEPS = [(i + 1, f"{a}_{b}") for i, (a, b) in enumerate(zip(_FLOW, _FLOW[1:]))]
_STEP_VALUES = ", ".join(f"({s}, '{p}')" for s, p in _STEPS)
_PAGE_CTES = f"""
pairs AS (
  SELECT session_id, page_id, next_page_id FROM (
    SELECT session_id, page_id,
           lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, page_id) AS next_page_id
    FROM actions) WHERE next_page_id IS NOT NULL),
pair_count AS (
  SELECT concat(CAST(page_id AS VARCHAR), '_', CAST(next_page_id AS VARCHAR)) AS page_pair,
         count(*) AS cnt
  FROM pairs GROUP BY 1
  HAVING page_pair IN ({", ".join(f"'{p}'" for _, p in _STEPS)})),
start_count AS (
  SELECT CAST({_FLOW[0]} AS BIGINT) AS start_page, count(*) AS cnt FROM actions WHERE page_id = {_FLOW[0]}),
steps AS (SELECT * FROM (VALUES {_STEP_VALUES}) t(step, page_pair)),
chained AS (
  SELECT s.step, s.page_pair, CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt
  FROM steps s LEFT JOIN pair_count c ON s.page_pair = c.page_pair),
rates AS (
  SELECT step, page_pair, cnt,
         coalesce(lag(cnt) OVER (ORDER BY step), (SELECT cnt FROM start_count)) AS prev_cnt
  FROM chained)"""

oracle("page_pairs", _PAGE_CTES, "SELECT * FROM pairs")
oracle("page_pair_count", _PAGE_CTES, "SELECT * FROM pair_count")
oracle("page_start_count", _PAGE_CTES, "SELECT * FROM start_count")
oracle("page_convert_rate", _PAGE_CTES, """
SELECT step, page_pair, cnt, prev_cnt,
       CASE WHEN prev_cnt = 0 THEN NULL
            ELSE ((200 * cnt + prev_cnt) // (2 * prev_cnt)) / 100.0::DOUBLE END AS rate
FROM rates""")

# ---------------------------------------------------------------- advertisement clicks
_AD_CTES = """
split_log AS (SELECT string_split(value, ' ') AS p FROM ad_log),
parsed AS (
  SELECT epoch_ms(CAST(p[1] AS BIGINT)) AS ts, strftime(epoch_ms(CAST(p[1] AS BIGINT)), '%Y%m%d') AS date,
         p[2] AS province, p[3] AS city, CAST(p[4] AS BIGINT) AS userid, CAST(p[5] AS BIGINT) AS adid
  FROM split_log
  WHERE len(p) = 5 AND TRY_CAST(p[1] AS BIGINT) IS NOT NULL AND p[2] <> '' AND p[3] <> ''
    AND TRY_CAST(p[4] AS BIGINT) IS NOT NULL AND TRY_CAST(p[5] AS BIGINT) IS NOT NULL),
ucc AS (SELECT date, userid, adid, count(*) AS click_count FROM parsed GROUP BY 1, 2, 3),
stat AS (SELECT date, province, city, adid, count(*) AS click_count FROM parsed GROUP BY 1, 2, 3, 4),
prov AS (SELECT date, province, adid, CAST(sum(click_count) AS BIGINT) AS click_count
         FROM stat GROUP BY 1, 2, 3),
top3 AS (
  SELECT date, province, adid, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, adid) AS rn
    FROM prov) WHERE rn <= 3),
per_minute AS (
  SELECT date_trunc('minute', ts) AS m, adid, count(*) AS click_count FROM parsed GROUP BY 1, 2),
trend AS (
  SELECT strftime(m, '%Y%m%d') AS date, strftime(m, '%H') AS hour, strftime(m, '%M') AS minute,
         adid, click_count
  FROM per_minute)"""

oracle("ad_log_parsed", _AD_CTES, "SELECT * FROM parsed")
oracle("ad_blacklist_filter", _AD_CTES,
       "SELECT userid, count(*) AS cnt FROM parsed WHERE userid NOT IN (0) GROUP BY userid")
oracle("ad_user_click_count", _AD_CTES, "SELECT * FROM ucc")
oracle("ad_blacklist", _AD_CTES, "SELECT DISTINCT userid FROM ucc WHERE click_count > 10")
oracle("ad_stat", _AD_CTES, "SELECT * FROM stat")
oracle("ad_province_count", _AD_CTES, "SELECT * FROM prov")
oracle("ad_province_top3", _AD_CTES, "SELECT * FROM top3")
oracle("ad_click_trend", _AD_CTES, "SELECT * FROM trend")
oracle("ad_recent_hour", _AD_CTES, """
SELECT strftime(m, '%Y%m%d') AS date, strftime(m, '%H') AS hour, strftime(m, '%M') AS minute,
       adid, click_count
FROM per_minute WHERE m >= (SELECT max(m) FROM per_minute) - INTERVAL 59 MINUTE""")
oracle("ad_sliding_hour", _AD_CTES, """
SELECT m + to_minutes(k + 1) AS window_end, adid, CAST(sum(click_count) AS BIGINT) AS click_count
FROM per_minute CROSS JOIN range(60) r(k)
GROUP BY 1, 2""")

# ---------------------------------------------------------------- keyed sinks and streams
_PARITY_CTES = _AD_CTES + """,
ad_log_ids AS (
  SELECT event_id, concat(CAST(epoch_us(ts) // 1000 AS VARCHAR), ' ', CAST(user_id % 5 AS VARCHAR), ' ',
                CAST(user_id % 10 AS VARCHAR), ' ',
                CAST(CASE WHEN event_id % 4 = 0 THEN user_id % 3 ELSE user_id END AS VARCHAR), ' ',
                CAST(CASE WHEN event_id % 4 = 0 THEN 0
                          ELSE CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 20 END AS VARCHAR)) AS value
  FROM events WHERE event_type IN ('click', 'view')),
parsed2 AS (
  SELECT event_id % 2 AS b, strftime(epoch_ms(CAST(p[1] AS BIGINT)), '%Y%m%d') AS date,
         p[2] AS province, p[3] AS city, CAST(p[4] AS BIGINT) AS userid, CAST(p[5] AS BIGINT) AS adid
  FROM (SELECT event_id, string_split(value, ' ') AS p FROM ad_log_ids)),
stat_b AS (SELECT b, date, province, city, adid, count(*) AS click_count FROM parsed2 GROUP BY ALL),
top3_b AS (
  SELECT b, date, province, adid, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY b, date, province ORDER BY click_count DESC, adid) AS rn
    FROM (SELECT b, date, province, adid, CAST(sum(click_count) AS BIGINT) AS click_count
          FROM stat_b GROUP BY ALL)) WHERE rn <= 3)"""

oracle("upsert_replace", _PARITY_CTES, """
SELECT date, province, city, adid, click_count FROM stat_b WHERE b = 1
UNION ALL
SELECT date, province, city, adid, click_count FROM stat_b s WHERE b = 0
  AND NOT EXISTS (SELECT 1 FROM stat_b t WHERE t.b = 1 AND t.date = s.date AND t.province = s.province
                  AND t.city = s.city AND t.adid = s.adid)""")
oracle("upsert_add", _AD_CTES, "SELECT * FROM ucc")
oracle("upsert_replace_group", _PARITY_CTES, """
SELECT date, province, adid, click_count FROM top3_b WHERE b = 1
UNION ALL
SELECT date, province, adid, click_count FROM top3_b s WHERE b = 0
  AND NOT EXISTS (SELECT 1 FROM top3_b t WHERE t.b = 1 AND t.date = s.date AND t.province = s.province)""")
oracle("ad_stat_stream", _AD_CTES, "SELECT * FROM stat")
oracle("ad_province_top3_stream", _AD_CTES, "SELECT * FROM top3")
oracle("ad_click_trend_stream", _AD_CTES, "SELECT * FROM trend")
oracle("ad_blacklist_stream", _AD_CTES, "SELECT DISTINCT userid FROM ucc WHERE click_count > 10")

oracle("ad_log_parsed_stream", _AD_CTES, "SELECT * FROM parsed")
oracle("ad_blacklist_filter_stream", _AD_CTES,
       "SELECT userid, count(*) AS cnt FROM parsed WHERE userid NOT IN (0) GROUP BY userid")

# ---------------------------------------------------------------- scalar functions
oracle("scalar_functions", """
ev AS (
  SELECT *, regexp_extract(props, '([0-9]+)', 1) AS k,
         CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN '' ELSE event_type END AS txt,
         concat('event=', CAST(event_id AS VARCHAR), '|type=', event_type, '|k=',
                regexp_extract(props, '([0-9]+)', 1)) AS packed,
         CASE WHEN user_id % 17 + 1 = 0 THEN NULL
              ELSE ((200 * (event_id % 200) + (user_id % 17 + 1)) // (2 * (user_id % 17 + 1)))
                   / 100.0::DOUBLE END AS ratio
  FROM events)""", """
SELECT event_id,
       strptime(strftime(ts, '%Y-%m-%d ') || CAST(hour(ts) AS VARCHAR) || strftime(ts, ':%M:%S'),
                '%Y-%m-%d %H:%M:%S') AS parsed_time,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text,
       strftime(ts, '%Y-%m-%d') AS date_text,
       strftime(ts, '%Y%m%d') AS date_key,
       CAST(CAST(strptime(strftime(ts, '%Y%m%d'), '%Y%m%d') AS DATE) AS VARCHAR) AS date_from_key,
       strftime(ts, '%Y%m%d%H%M') AS minute_key,
       strftime(ts, '%Y-%m-%d_%H') AS date_hour,
       ts < TIMESTAMP '2024-01-15 00:00:00' AS is_before,
       ts > TIMESTAMP '2024-01-15 00:00:00' AS is_after,
       date_diff('second', CAST(CAST(ts AS DATE) AS TIMESTAMP), ts) AS seconds_of_day,
       CAST(CAST(ts AS DATE) - 1 AS VARCHAR) AS yesterday,
       strftime(ts, '%Y%m%d') AS mk_date, strftime(ts, '%H') AS mk_hour, strftime(ts, '%M') AS mk_minute,
       (txt IS NULL OR txt = '') AS text_is_empty,
       trim(concat(',', k, ',,'), ',') AS trimmed,
       lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS hour_padded,
       ratio,
       regexp_extract(packed, '(^|\\|)type=([^|]*)', 2) AS packed_type,
       regexp_replace(packed, '(^|\\|)type=[^|]*', '\\1type=x') AS packed_set,
       concat(k, ',', CAST(CAST(k AS BIGINT) * 2 AS VARCHAR)) AS id_list,
       concat(CAST(user_id AS VARCHAR), ':', event_type) AS user_label,
       json_extract_string(props, '$.k') AS json_k,
       concat(CAST(event_id % 10 AS VARCHAR), '_', CAST((event_id + 1) % 10 AS VARCHAR), '=',
              CAST(ratio AS VARCHAR)) AS rate_text
FROM ev""")
oracle("page_convert_rate_text", _PAGE_CTES, """
SELECT string_agg(concat_ws('=', page_pair, CAST(rate AS VARCHAR)), '|' ORDER BY step) AS convert_rate
FROM (SELECT step, page_pair,
             CASE WHEN prev_cnt = 0 THEN NULL
                  ELSE ((200 * cnt + prev_cnt) // (2 * prev_cnt)) / 100.0::DOUBLE END AS rate
      FROM rates)""")
