"""Result schemas equal the declared table schemas (what the JDBC sinks append)."""

from visit_rows import visit

from retail_insight import schemas
from retail_insight.operators import area, category


def names_types(df):
    return [(f.name, f.dataType) for f in df.schema.fields]


def declared(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_result_schemas(spark, make_visits):
    v = make_visits([visit(click_category_id=1, click_product_id=1, city_id=1), visit(order="1,2")])
    top = category.top_categories(category.category_counts_wide(category.category_actions(v)), "t")
    assert names_types(top) == declared(schemas.CATEGORY_TOP10)
    sessions = category.top_sessions(category.category_session_clicks(v, top), "t")
    assert names_types(sessions) == declared(schemas.CATEGORY_TOP10_SESSIONS)
    cities = spark.createDataFrame([(1, "C1", "North")], schemas.CITY_INFO)
    products = spark.createDataFrame([(1, "p1", "")], schemas.PRODUCT_INFO)
    r4 = area.area_top3_products(v, cities, products)
    assert names_types(r4) == declared(schemas.AREA_COUNT_INFO)
