"""Declared schemas: the driver's input tables and the shop's own tables."""

from __future__ import annotations

from pyspark.sql import types as T


MONEY = T.DecimalType(10, 2)
_KINDS = {
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "decimal(10,2)": MONEY,
    "decimal(5,2)": T.DecimalType(5, 2),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    """A schema from ``name type [not null]`` parts; needs no session."""
    fields = []
    for part in columns.split(", "):
        name, kind, *rest = part.split()
        fields.append(T.StructField(name, _KINDS[kind], nullable=rest != ["not", "null"]))
    return T.StructType(fields)


# Input tables that the shop views are built from.
INPUTS = {
    "customer": _struct(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": _struct(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": _struct(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": _struct(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": _struct(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
}

BRONZE = _struct("session_id string, event_type string, product_id int, event_ts timestamp_ntz")
# As it travels in JSON: the time is text and is parsed after landing.
BRONZE_TEXT = _struct("session_id string, event_type string, product_id int, event_ts string")
# The live feed carries no session and sends its time as text.
LIVE_EVENTS = _struct("event_type string, product_id int, event_ts string")

# Fixed values.
EVENT_TYPES = ("view", "click", "add_to_cart")
ORDER_STATUSES = ("pending", "confirmed", "shipped", "delivered", "cancelled")
