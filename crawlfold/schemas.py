"""Declared schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

SHOP_FIELDS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("type_", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("comments_n", T.IntegerType()),
    T.StructField("consumption_per_capita", T.DoubleType()),
    T.StructField("stars", T.IntegerType()),
    T.StructField("flavor", T.DoubleType()),
    T.StructField("envir", T.DoubleType()),
    T.StructField("service", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("key_words", T.StringType()),
])

SHOPS = T.StructType(
    [T.StructField("id", T.StringType(), False)]
    + SHOP_FIELDS.fields
    + [T.StructField("lock_", T.IntegerType(), False)]
)

OBSERVATIONS = T.StructType(
    [T.StructField("id", T.StringType(), False)]
    + SHOP_FIELDS.fields
    + [T.StructField("ts", T.TimestampNTZType()), T.StructField("seq", T.LongType(), False)]
)

PAGES = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("html", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("fetched_at", T.TimestampNTZType()),
    T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
])

# One completed or started request. `seq` is the unique arrival number.
OUTCOMES = T.StructType([
    T.StructField("key", T.StringType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("kind", T.StringType(), False),
])

CLAIMS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("code", T.IntegerType(), False),
])

POOL = T.StructType([
    T.StructField("proxy", T.StringType(), False),
    T.StructField("ip", T.StringType()),
    T.StructField("port", T.StringType()),
    T.StructField("scheme", T.StringType()),
    T.StructField("lifetime_class", T.IntegerType()),
    T.StructField("birth_time", T.TimestampNTZType()),
    T.StructField("expire_time", T.TimestampNTZType()),
    T.StructField("death_time", T.TimestampNTZType()),
    T.StructField("death", T.IntegerType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("ban", T.IntegerType()),
    T.StructField("using_n", T.IntegerType()),
])

LEASE_REPLY = T.StructType([
    T.StructField("success", T.BooleanType()),
    T.StructField("msg", T.StringType()),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("ip", T.StringType()),
        T.StructField("port", T.StringType()),
        T.StructField("expire_time", T.StringType()),
    ]))),
])

AREAS = T.StructType([
    T.StructField("district", T.StringType(), False),
    T.StructField("area", T.StringType(), False),
    T.StructField("area_code", T.StringType(), False),
])

# Extracted item key -> shop column.
ITEM_COLUMNS = {
    "ID": "id", "NAME": "name", "ADDRESS": "address", "TYPE": "type_", "TAG": "tag",
    "COMMENTS_N": "comments_n", "CPC": "consumption_per_capita", "STARS": "stars",
    "FLA": "flavor", "ENV": "envir", "SER": "service", "LON": "lon", "LAT": "lat",
    "KEY_WORDS": "key_words",
}
