"""Canonical schemas of the inputs and outputs."""

from pyspark.sql.types import (IntegerType, LongType, StringType, StructField,
                               StructType)


def _schema(*fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


USER_VISIT_ACTION = _schema(
    ("date", StringType()),
    ("user_id", LongType()),
    ("session_id", StringType()),
    ("page_id", LongType()),
    ("action_time", StringType()),
    ("search_keyword", StringType()),
    ("click_category_id", LongType()),
    ("click_product_id", LongType()),
    ("order_category_ids", StringType()),
    ("order_product_ids", StringType()),
    ("pay_category_ids", StringType()),
    ("pay_product_ids", StringType()),
    ("city_id", LongType()),
)

USER_INFO = _schema(
    ("user_id", LongType()),
    ("username", StringType()),
    ("name", StringType()),
    ("age", IntegerType()),
    ("professional", StringType()),
    ("gender", StringType()),
)

PRODUCT_INFO = _schema(
    ("product_id", LongType()),
    ("product_name", StringType()),
    ("extend_info", StringType()),
)

CITY_INFO = _schema(
    ("city_id", LongType()),
    ("city_name", StringType()),
    ("area", StringType()),
)

# One ad-click log line: "ts_ms area city user_id ad_id", single spaces.
AD_LOG_LINE = _schema(("value", StringType()))

AD_LOG = _schema(
    ("ts", LongType()),
    ("area", StringType()),
    ("city", StringType()),
    ("user_id", StringType()),
    ("ad_id", StringType()),
    ("day", StringType()),
)

CATEGORY_TOP10 = _schema(
    ("task_id", StringType()),
    ("category_id", StringType()),
    ("click_count", LongType()),
    ("order_count", LongType()),
    ("pay_count", LongType()),
)

CATEGORY_TOP10_SESSIONS = _schema(
    ("task_id", StringType()),
    ("category_id", StringType()),
    ("session_id", StringType()),
    ("click_count", LongType()),
)

AREA_COUNT_INFO = _schema(
    ("area", StringType()),
    ("product_name", StringType()),
    ("clickcount", LongType()),
    ("city_remark", StringType()),
)
