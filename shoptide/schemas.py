"""Record types carried by the topics and tables."""

from __future__ import annotations

from pyspark.sql import types as T


# Fields in the order in which the records declare them.

STARTUP_LOG = T.StructType(
    [
        T.StructField("mid", T.StringType()),
        T.StructField("uid", T.StringType()),
        T.StructField("appid", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("os", T.StringType()),
        T.StructField("ch", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("vs", T.StringType()),
        T.StructField("ts", T.LongType()),
    ]
)

EVENT_LOG = T.StructType(
    [
        T.StructField("mid", T.StringType()),
        T.StructField("uid", T.StringType()),
        T.StructField("appid", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("os", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("evid", T.StringType()),
        T.StructField("pgid", T.StringType()),
        T.StructField("npgid", T.StringType()),
        T.StructField("itemid", T.StringType()),
        T.StructField("ts", T.LongType()),
    ]
)

ORDER_INFO = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("province_id", T.StringType()),
        T.StructField("consignee", T.StringType()),
        T.StructField("order_comment", T.StringType()),
        T.StructField("consignee_tel", T.StringType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("payment_way", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("img_url", T.StringType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("expire_time", T.StringType()),
        T.StructField("delivery_address", T.StringType()),
        T.StructField("create_time", T.StringType()),
        T.StructField("operate_time", T.StringType()),
        T.StructField("tracking_no", T.StringType()),
        T.StructField("parent_order_id", T.StringType()),
        T.StructField("out_trade_no", T.StringType()),
        T.StructField("trade_body", T.StringType()),
    ]
)

ORDER_DETAIL = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("sku_name", T.StringType()),
        T.StructField("sku_id", T.StringType()),
        T.StructField("order_price", T.StringType()),
        T.StructField("img_url", T.StringType()),
        T.StructField("sku_num", T.StringType()),
    ]
)

USER_INFO = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("login_name", T.StringType()),
        T.StructField("user_level", T.StringType()),
        T.StructField("birthday", T.StringType()),
        T.StructField("gender", T.StringType()),
    ]
)

CHANGE = T.StructType(
    [
        T.StructField("entry_type", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField(
            "after",
            T.ArrayType(
                T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())])
            ),
        ),
    ]
)

SALE_DETAIL_COLUMNS = [
    "order_detail_id",
    "order_id",
    "order_status",
    "create_time",
    "user_id",
    "sku_id",
    "user_gender",
    "user_age",
    "user_level",
    "sku_price",
    "sku_name",
    "dt",
]
