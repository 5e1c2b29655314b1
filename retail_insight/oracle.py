"""DuckDB SQL for every registered query: the correctness oracle.

Only the driver's raw tables are registered in DuckDB, so each statement
starts with the canonical views as CTEs (the SQL twin of
``sources/testdata.py``). Sums are cast to BIGINT to match Spark's types.
"""

from __future__ import annotations

# Parameters shared with the Spark side (``retail_insight.catalog``).
START_DATE, END_DATE, START_AGE, END_AGE = "1996-01-01", "2000-12-31", 20, 50
TASK_ID = "task-0000"
THRESHOLD = 3
N_BATCHES = 5

_CITY = """
city_info AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS city_id, n.n_name AS city_name, r.r_name AS area
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)"""

_PRODUCT = """
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS extend_info FROM part)"""

_USER = """
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(10 + c_custkey % 50 AS INTEGER) AS age, c_mktsegment AS professional,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender
  FROM customer)"""

_VISITS = """
items AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, o.o_custkey, o.o_orderstatus, o.o_orderdate,
         c.c_nationkey, CAST(regexp_extract(p.p_brand, '(\\d+)', 1) AS BIGINT) AS brand
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey),
baskets AS (
  SELECT o_custkey, o_orderstatus, o_orderdate, c_nationkey,
         string_agg(CAST(brand AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey, brand) AS cat_csv,
         string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey, brand) AS prod_csv
  FROM items WHERE o_orderstatus IN ('O', 'P')
  GROUP BY l_orderkey, o_custkey, o_orderstatus, o_orderdate, c_nationkey),
user_visit_action AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, o_custkey AS user_id,
         's' || CAST(o_custkey % 40 AS VARCHAR) AS session_id, CAST(l_linenumber AS BIGINT) AS page_id,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS action_time, CAST(NULL AS VARCHAR) AS search_keyword,
         brand AS click_category_id, l_partkey AS click_product_id,
         CAST(NULL AS VARCHAR) AS order_category_ids, CAST(NULL AS VARCHAR) AS order_product_ids,
         CAST(NULL AS VARCHAR) AS pay_category_ids, CAST(NULL AS VARCHAR) AS pay_product_ids,
         CAST(c_nationkey AS BIGINT) AS city_id
  FROM items WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT strftime(o_orderdate, '%Y-%m-%d'), o_custkey, 's' || CAST(o_custkey % 40 AS VARCHAR),
         CAST(NULL AS BIGINT), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), CAST(NULL AS VARCHAR),
         CAST(-1 AS BIGINT), CAST(-1 AS BIGINT),
         CASE WHEN o_orderstatus = 'O' THEN cat_csv END, CASE WHEN o_orderstatus = 'O' THEN prod_csv END,
         CASE WHEN o_orderstatus = 'P' THEN cat_csv END, CASE WHEN o_orderstatus = 'P' THEN prod_csv END,
         CAST(c_nationkey AS BIGINT)
  FROM baskets)"""

VIEWS = "WITH" + ",".join([_CITY, _PRODUCT, _USER, _VISITS])

# --- R4 --------------------------------------------------------------------

_R4_BASE = VIEWS + """,
action_city AS (
  SELECT ci.area, ci.city_name, v.click_product_id
  FROM user_visit_action v JOIN city_info ci ON v.city_id = ci.city_id
  WHERE v.click_product_id > 0),
per_city AS (
  SELECT area, click_product_id, city_name, count(*) AS n FROM action_city
  GROUP BY area, click_product_id, city_name),
ranked_city AS (
  SELECT *, sum(n) OVER (PARTITION BY area, click_product_id) AS total,
         count(*) OVER (PARTITION BY area, click_product_id) AS ncity,
         row_number() OVER (PARTITION BY area, click_product_id ORDER BY n DESC, city_name) AS pos,
         floor(n / total * 1000 + 0.5) / 10 AS share
  FROM per_city),
remark AS (
  SELECT area, click_product_id, CAST(max(total) AS BIGINT) AS clickcount,
         string_agg(city_name || ':' || CAST(share AS VARCHAR) || '%', ',' ORDER BY pos)
           FILTER (WHERE pos <= 2)
         || CASE WHEN max(ncity) > 2 THEN ',其他:' || CAST(floor(
              (100.0 - sum(share) FILTER (WHERE pos = 1) - coalesce(sum(share) FILTER (WHERE pos = 2), 0))
              * 10 + 0.5) / 10 AS VARCHAR) || '%' ELSE '' END AS city_remark
  FROM ranked_city GROUP BY area, click_product_id),
top3 AS (
  SELECT area, click_product_id, clickcount, city_remark FROM (
    SELECT *, rank() OVER (PARTITION BY area ORDER BY clickcount DESC) AS rk FROM remark)
  WHERE rk <= 3)
"""

SQL: dict[str, str] = {}

SQL["action_city"] = _R4_BASE + "SELECT area, city_name, click_product_id FROM action_city"
SQL["area_product_clicks"] = _R4_BASE + """
SELECT area, click_product_id, count(*) AS clickcount FROM action_city GROUP BY area, click_product_id"""
SQL["area_product_city_remark"] = _R4_BASE + "SELECT area, click_product_id, clickcount, city_remark FROM remark"
SQL["area_product_top3"] = _R4_BASE + "SELECT * FROM top3"
SQL["area_top3_products"] = _R4_BASE + """
SELECT t3.area, p.product_name, t3.clickcount, t3.city_remark
FROM top3 t3 JOIN product_info p ON t3.click_product_id = p.product_id"""

# --- R1 / R2 ---------------------------------------------------------------

_R1_BASE = VIEWS + f""",
visits AS (
  SELECT v.* FROM user_visit_action v JOIN user_info u ON v.user_id = u.user_id
  WHERE v.date >= '{START_DATE}' AND v.date <= '{END_DATE}' AND u.age >= {START_AGE} AND u.age <= {END_AGE}),
order_items AS (
  SELECT unnest(string_split(order_category_ids, ',')) AS item FROM visits
  WHERE coalesce(click_category_id, -1) = -1 AND length(order_category_ids) > 0),
pay_items AS (
  SELECT unnest(string_split(pay_category_ids, ',')) AS item FROM visits
  WHERE coalesce(click_category_id, -1) = -1 AND coalesce(length(order_category_ids), 0) = 0
    AND length(pay_category_ids) > 0),
actions AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, 'click' AS action FROM visits
  WHERE coalesce(click_category_id, -1) <> -1
  UNION ALL SELECT item, 'order' FROM order_items WHERE length(item) > 0
  UNION ALL SELECT item, 'pay' FROM pay_items WHERE length(item) > 0),
wide AS (
  SELECT category_id,
         count(*) FILTER (WHERE action = 'click') AS click_count,
         count(*) FILTER (WHERE action = 'order') AS order_count,
         count(*) FILTER (WHERE action = 'pay') AS pay_count
  FROM actions GROUP BY category_id),
top10 AS (
  SELECT '{TASK_ID}' AS task_id, category_id, click_count, order_count, pay_count FROM wide
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10),
session_clicks AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, session_id, count(*) AS click_count
  FROM visits
  WHERE coalesce(click_category_id, -1) <> -1
    AND CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top10)
  GROUP BY 1, 2)
"""

SQL["visits_filtered"] = _R1_BASE + "SELECT * FROM visits"
SQL["visits_filtered_open"] = VIEWS + """
SELECT v.* FROM user_visit_action v JOIN user_info u ON v.user_id = u.user_id"""
SQL["category_action_counts"] = _R1_BASE + """
SELECT category_id, action, count(*) AS action_count FROM actions GROUP BY category_id, action"""
SQL["category_counts_wide"] = _R1_BASE + "SELECT * FROM wide"
SQL["category_top10"] = _R1_BASE + "SELECT * FROM top10"
SQL["category_session_clicks"] = _R1_BASE + "SELECT * FROM session_clicks"
SQL["category_top10_sessions"] = _R1_BASE + f"""
SELECT '{TASK_ID}' AS task_id, category_id, session_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rn
  FROM session_clicks) WHERE rn <= 10"""

# --- R3 / R5 / R6 ----------------------------------------------------------

ADS_VIEWS = f"""WITH
geo AS (
  SELECT n.n_nationkey AS geo_key, replace(r.r_name, ' ', '_') AS area, n.n_name AS city
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
lines AS (
  SELECT e.event_id, (e.event_id * {N_BATCHES}) // (SELECT max(event_id) + 1 FROM events) AS batch_id,
         concat_ws(' ', CAST(epoch_us(e.ts) // 1000 AS VARCHAR), g.area, g.city, CAST(e.user_id AS VARCHAR),
                   CAST(CAST(regexp_extract(e.props, '(\\d+)', 1) AS BIGINT) % 6 + 1 AS VARCHAR)) AS value
  FROM events e JOIN geo g ON e.user_id % 25 = g.geo_key),
tok AS (SELECT event_id, batch_id, string_split(value, ' ') AS t FROM lines),
ads AS (
  SELECT event_id, batch_id, TRY_CAST(t[1] AS BIGINT) AS ts, t[2] AS area, t[3] AS city,
         t[4] AS user_id, t[5] AS ad_id, strftime(epoch_ms(TRY_CAST(t[1] AS BIGINT)), '%Y-%m-%d') AS day
  FROM tok WHERE len(t) >= 5 AND TRY_CAST(t[1] AS BIGINT) IS NOT NULL),
per_batch AS (
  SELECT batch_id, day, user_id, ad_id, count(*) AS n FROM ads GROUP BY batch_id, day, user_id, ad_id),
running AS (
  SELECT *, sum(n) OVER (PARTITION BY day, user_id, ad_id ORDER BY batch_id) AS cum FROM per_batch),
bl AS (SELECT user_id, min(batch_id) AS listed_batch FROM running WHERE cum >= {THRESHOLD} GROUP BY user_id),
accepted AS (
  SELECT a.* FROM ads a LEFT JOIN bl ON a.user_id = bl.user_id
  WHERE bl.listed_batch IS NULL OR a.batch_id <= bl.listed_batch),
area_city AS (
  SELECT day, area, city, ad_id, count(*) AS clicks FROM accepted GROUP BY day, area, city, ad_id),
area_ad AS (
  SELECT day, area, ad_id, CAST(sum(clicks) AS BIGINT) AS clicks FROM area_city GROUP BY day, area, ad_id),
top3 AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY day, area ORDER BY clicks DESC, ad_id) AS rank FROM area_ad)
  WHERE rank <= 3)
"""

SQL["ad_log_parsed"] = ADS_VIEWS + "SELECT * FROM ads"
SQL["ad_clicks_user_day"] = ADS_VIEWS + """
SELECT day, user_id, ad_id, count(*) AS clicks FROM ads GROUP BY day, user_id, ad_id"""
SQL["blacklist_users"] = ADS_VIEWS + "SELECT * FROM bl"
SQL["ad_log_accepted"] = ADS_VIEWS + "SELECT * FROM accepted"
SQL["area_city_ad_counts"] = ADS_VIEWS + "SELECT * FROM area_city"
SQL["area_ad_counts"] = ADS_VIEWS + "SELECT * FROM area_ad"
SQL["area_top3_ads"] = ADS_VIEWS + "SELECT * FROM top3"
SQL["area_top3_ads_json"] = ADS_VIEWS + """
SELECT day, area, to_json(list(map([ad_id], [clicks]) ORDER BY rank)) AS ads_json FROM top3 GROUP BY day, area"""

# --- streams and sinks -----------------------------------------------------

SQL["stream_realtime_pipeline"] = SQL["area_city_ad_counts"]
SQL["stream_blacklist_users"] = SQL["blacklist_users"]
SQL["stream_area_top3_ads_json"] = SQL["area_top3_ads_json"]
SQL["stream_area_city_ad_counts"] = ADS_VIEWS + """
SELECT day, area, city, ad_id, count(*) AS clicks FROM ads GROUP BY day, area, city, ad_id"""
SQL["table_overwrite"] = SQL["area_top3_products"]
SQL["kv_upsert"] = SQL["area_city_ad_counts"]
SQL["area_top3_products_sql"] = SQL["area_top3_products"]
SQL["offline_job_sessions"] = SQL["category_top10_sessions"]
