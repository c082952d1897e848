"""Record types as Spark schemas. Event time is epoch milliseconds in ``ts_ms``."""

from pyspark.sql import types as T

EVENT = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)

URL_VIEW_COUNT = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("pv", T.LongType()),
        T.StructField("window_start_ms", T.LongType()),
        T.StructField("window_end_ms", T.LongType()),
    ]
)

LOGIN_EVENT = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)

APP_ORDER = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)

PAYMENT = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)
