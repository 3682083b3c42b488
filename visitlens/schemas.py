"""Schemas of the input tables and of the result tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the given and the result tables.


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

# ---- inputs ---------------------------------------------------------------

USER_VISIT_ACTION = _table(
    date=_S,
    user_id=_L,
    session_id=_S,
    page_id=_L,
    action_time=_S,
    search_keyword=_S,
    click_category_id=_L,
    click_product_id=_L,
    order_category_ids=_S,
    order_product_ids=_S,
    pay_category_ids=_S,
    pay_product_ids=_S,
    city_id=_L,
)

USER_INFO = _table(
    user_id=_L, username=_S, name=_S, age=_I, professional=_S, city=_S, sex=_S
)

PRODUCT_INFO = _table(product_id=_L, product_name=_S, extend_info=_S)

CITY = _table(city_id=_L, city_name=_S, area=_S)

AD_CLICK = _table(
    ts=T.TimestampType(), province=_S, city=_S, user_id=_L, ad_id=_L
)

# ---- result tables of the ad stream ---------------------------------------
# Each is stored by day: the first column is the partition column.

AD_BLACKLIST = _table(date=_S, userid=_L)
AD_USER_CLICK_COUNT = _table(date=_S, userid=_L, adid=_L, clickCount=_L)
AD_STAT = _table(date=_S, province=_S, city=_S, adid=_L, clickCount=_L)
AD_PROVINCE_TOP3 = _table(date=_S, province=_S, adid=_L, clickCount=_L)
AD_CLICK_TREND = _table(date=_S, hour=_S, minute=_S, adid=_L, clickCount=_L)
