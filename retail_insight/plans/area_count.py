"""Area job (R4): top-3 products per area with the city share remark.

Available as DataFrame calls and as SQL text over temp views. The SQL form
calls ``city_ratio``, a SQL function whose body the optimizer inlines, for
ranked products only: the plan has the shape of the DataFrame form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.city_share import register_city_ratio
from ..operators import area

# The same query in SQL, over the views user_visit_action, city_info and
# product_info. Steps mirror the DataFrame form: clicks per city, clicks per
# product ranked within their area, the remark of the ranked ones, their names.
AREA_TOP3_SQL = """
WITH action_city AS (
  SELECT ci.area, ci.city_name, v.click_product_id
  FROM user_visit_action v JOIN city_info ci ON v.city_id = ci.city_id
  WHERE v.click_product_id > 0),
per_city AS (
  SELECT area, click_product_id, city_name, count(*) AS n
  FROM action_city GROUP BY area, click_product_id, city_name),
ranked AS (
  SELECT area, click_product_id, clickcount FROM (
    SELECT *, rank() OVER (PARTITION BY area ORDER BY clickcount DESC) AS rk
    FROM (SELECT area, click_product_id, sum(n) AS clickcount FROM per_city GROUP BY area, click_product_id))
  WHERE rk <= 3),
remark AS (
  SELECT r.area, r.click_product_id, first(r.clickcount) AS clickcount,
         city_ratio(collect_list(struct(c.city_name AS city, c.n AS n))) AS city_remark
  FROM ranked r JOIN per_city c ON r.area <=> c.area AND r.click_product_id = c.click_product_id
  GROUP BY r.area, r.click_product_id)
SELECT r.area, p.product_name, r.clickcount, r.city_remark
FROM remark r JOIN product_info p ON r.click_product_id = p.product_id
"""


def area_top3_sql(spark: SparkSession) -> DataFrame:
    """R4 through ``spark.sql`` over registered views."""
    register_city_ratio(spark)
    return spark.sql(AREA_TOP3_SQL)


def run_area_count(visits: DataFrame, cities: DataFrame, products: DataFrame,
                   write: Callable[[DataFrame, str], None], table: str = "area_count_info") -> DataFrame:
    """Compute R4 once and hand it to the sink (one action, no re-scan)."""
    result = area.area_top3_products(visits, cities, products)
    write(result, table)
    return result
