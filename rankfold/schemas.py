"""Fixed schemas at the edges (never inferred)."""

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType([
    T.StructField("visitorid", T.LongType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("event", T.StringType()),
    T.StructField("itemid", T.LongType()),
    T.StructField("transactionid", T.LongType()),
])

RATING_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.IntegerType()),
])

RECS_SCHEMA = T.StructType([
    T.StructField("visitorid", T.LongType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("itemid", T.LongType()),
])

# fixed values: the event vocabulary of the log
KNOWN_EVENTS = ("view", "addtocart", "transaction")

ENRICHED_COLUMNS = ("visitorid", "itemid", "event", "timestamp", "transactionid",
                    "date", "datetime", "hour", "day_of_week", "is_weekend")
