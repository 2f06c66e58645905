"""Column names and schemas shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

ENTITY = ["entity_type", "oid"]
DIMENSIONS = ["data_source", "protocol", "action"]
ROW_KEY = ENTITY + DIMENSIONS
ATTR_KEY = ROW_KEY + ["code", "value"]

OBS_HEADER = ROW_KEY + ["capture_time", "seq"]

PROPS_TYPE = T.ArrayType(
    T.StructType(
        [T.StructField("code", T.StringType()), T.StructField("value", T.StringType())]
    )
)

# One observation; the position of an attribute is its index in ``props``.
OBS = T.StructType(
    [
        T.StructField("entity_type", T.StringType()),
        T.StructField("oid", T.StringType()),
        T.StructField("data_source", T.StringType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("capture_time", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("props", PROPS_TYPE),
    ]
)
