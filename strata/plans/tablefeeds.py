"""Feeds over the driver's tables: the analogues used by the query catalogue.

lineitem plays the flight feed (its key (l_orderkey, l_linenumber) repeats,
so latest-wins matters), orders and customer play paged ops/ref feeds, part
plays a reference entity with versions, nation and region play airports and
countries.  Faults are injected by data-driven rules, the same expression in
Spark and in the oracle SQL, so checks are never vacuous.

Injection rules, rule predicates, page sizes, sweep time, route list and event
groups below are parameters of the catalogue.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.keys import surrogate_key
from strata.spec import QUARANTINE, SILVER, FeedSpec, Field, Rule

OPS_PAGE = 50
REF_PAGE = 100
SWEEP_TS = "2024-01-01 00:00:00"
SCRIPT = "strata.landing"

# --- lineitem as the flight feed -------------------------------------------
LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_ORDER = ("l_shipdate",)
LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                "l_shipdate")
STAGED_LINE_COLUMNS = LINE_COLUMNS + ("line_id",)

LINE_RULES = (
    Rule("valid_part", "l_partkey IS NOT NULL"),
    Rule("valid_supplier", "l_suppkey IS NOT NULL"),
    Rule("valid_return_flag", "l_returnflag IS NOT NULL"),
    Rule("recent_ship", None, fail_sql="l_shipdate < '1996-01-01'",
         applies_to=frozenset({QUARANTINE})),
)


def staged_lines(lineitem: DataFrame) -> DataFrame:
    """Lines with injected faults: part lost when the discount is 0, supplier
    lost when the tax is 0.08, return flag lost for quantity 50."""
    return lineitem.select(
        "l_orderkey",
        F.when(F.col("l_discount") == F.lit(0.0), F.lit(None)).otherwise(F.col("l_partkey")).alias("l_partkey"),
        F.when(F.col("l_tax") == F.lit(0.08), F.lit(None)).otherwise(F.col("l_suppkey")).alias("l_suppkey"),
        "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.when(F.col("l_quantity") == F.lit(50.0), F.lit(None)).otherwise(F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus", "l_shipdate",
        surrogate_key("l_orderkey", "l_linenumber").alias("line_id"),
    )


STAGED_LINES_SQL = """SELECT l_orderkey,
  CASE WHEN l_discount = CAST(0.0 AS DOUBLE) THEN NULL ELSE l_partkey END AS l_partkey,
  CASE WHEN l_tax = CAST(0.08 AS DOUBLE) THEN NULL ELSE l_suppkey END AS l_suppkey,
  l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  CASE WHEN l_quantity = CAST(50.0 AS DOUBLE) THEN NULL ELSE l_returnflag END AS l_returnflag,
  l_linestatus, l_shipdate, concat_ws('-', l_orderkey, l_linenumber) AS line_id
FROM lineitem"""

# --- part as a versioned reference entity (airports analogue) ---------------
PART_KEY = ("part_code",)
PART_ORDER = ("p_partkey",)
PART_RULES = (
    Rule("valid_code", "length(part_code) = 8"),
    Rule("has_name", "part_name IS NOT NULL"),
)


def staged_parts(part: DataFrame) -> DataFrame:
    """Each part row is a snapshot of its brand; a newer part key is a newer
    snapshot.  Names are lost for size-1 parts."""
    return part.select(
        F.col("p_brand").alias("part_code"),
        F.when(F.col("p_size") == F.lit(1), F.lit(None)).otherwise(F.col("p_name")).alias("part_name"),
        "p_partkey", "p_type", "p_size", "p_retailprice",
    )


STAGED_PARTS_SQL = """SELECT p_brand AS part_code,
  CASE WHEN p_size = 1 THEN NULL ELSE p_name END AS part_name,
  p_partkey, p_type, p_size, p_retailprice
FROM part"""

# --- orders as a paged ops feed ----------------------------------------------
_DT = [StructField("DateTime", StringType())]
ORDER_NODE = StructType([
    StructField("OrderKey", StringType()), StructField("CustKey", StringType()),
    StructField("Status", StringType()), StructField("TotalPrice", StringType()),
    StructField("OrderDateUTC", StructType(_DT)), StructField("OrderDateLocal", StructType(_DT)),
    StructField("Priority", StringType()),
])
ORDERS_FEED = FeedSpec(
    name="orders", category="ops", array_path="payload.OrderResource.Orders.Order",
    node_schema=ORDER_NODE,
    fields=(Field("o_orderkey", "OrderKey", "long"), Field("o_custkey", "CustKey", "long"),
            Field("o_orderstatus", "Status"), Field("o_totalprice", "TotalPrice", "double"),
            Field("o_orderdate", "OrderDateUTC.DateTime", "ts_utc"),
            Field("order_date_local", "OrderDateLocal.DateTime", "ts_local"),
            Field("o_orderpriority", "Priority"),
            Field("ingested_at", "@ingested_at", "ts"), Field("batch_id", "@batch_id")),
    key=("o_orderkey",), page_size=OPS_PAGE, multiline=False, keep_unknown=False,
)


def order_record(o: DataFrame) -> Column:
    return F.struct(
        F.col("o_orderkey").cast("string").alias("OrderKey"),
        F.col("o_custkey").cast("string").alias("CustKey"),
        F.col("o_orderstatus").alias("Status"),
        F.col("o_totalprice").cast("string").alias("TotalPrice"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm'Z'").alias("DateTime")).alias("OrderDateUTC"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("DateTime")).alias("OrderDateLocal"),
        F.col("o_orderpriority").alias("Priority"),
    )


# A page is lost in transit when its first order is urgent and pending.
LOST_PRIORITY = "1-URGENT"
LOST_STATUS = "P"

# --- lineitem lines as documents of an ops feed ------------------------------
LINE_NODE = StructType([StructField(n, StringType()) for n in (
    "OrderKey", "PartKey", "SuppKey", "LineNumber", "Quantity", "ExtendedPrice", "Discount",
    "Tax", "ReturnFlag", "LineStatus")] + [StructField("ShipDate", StructType(_DT))])
LINES_FEED = FeedSpec(
    name="lines", category="ops", array_path="payload.LineResource.Lines.Line",
    node_schema=LINE_NODE,
    fields=(Field("l_orderkey", "OrderKey", "long"), Field("l_partkey", "PartKey", "long"),
            Field("l_suppkey", "SuppKey", "long"), Field("l_linenumber", "LineNumber", "int"),
            Field("l_quantity", "Quantity", "double"),
            Field("l_extendedprice", "ExtendedPrice", "double"),
            Field("l_discount", "Discount", "double"), Field("l_tax", "Tax", "double"),
            Field("l_returnflag", "ReturnFlag"), Field("l_linestatus", "LineStatus"),
            Field("l_shipdate", "ShipDate.DateTime", "ts_utc"),
            Field("ingested_at", "@ingested_at", "ts")),
    key=LINE_KEY, order=("ingested_at",) + LINE_ORDER, page_size=OPS_PAGE, multiline=False, keep_unknown=False,
)


# The lines feed with checks, for change-driven layers.
CHECKED_LINES_FEED = dataclasses.replace(LINES_FEED, rules=(
    Rule("small_quantity", "l_quantity < 50"), Rule("has_discount", "l_discount > 0", action="warn")))
SILVER_PARTS = 64
# Lines of the newest hundredth of orders come again with this much more quantity.
CORRECTED_SHARE = 100
CORRECTION = 10


def line_record(line: Column) -> Column:
    """A line, as a struct of its columns, as the feed's record."""
    return F.struct(
        line["l_orderkey"].cast("string").alias("OrderKey"),
        line["l_partkey"].cast("string").alias("PartKey"),
        line["l_suppkey"].cast("string").alias("SuppKey"),
        line["l_linenumber"].cast("string").alias("LineNumber"),
        line["l_quantity"].cast("string").alias("Quantity"),
        line["l_extendedprice"].cast("string").alias("ExtendedPrice"),
        line["l_discount"].cast("string").alias("Discount"),
        line["l_tax"].cast("string").alias("Tax"),
        line["l_returnflag"].alias("ReturnFlag"),
        line["l_linestatus"].alias("LineStatus"),
        F.struct(F.date_format(line["l_shipdate"], "yyyy-MM-dd'T'HH:mm'Z'").alias("DateTime")).alias("ShipDate"),
    )


# Lines shipped from this day on arrive in the second drop.
SECOND_DROP_FROM = "1998-01-01"

# --- reference tables as ref feeds (the table factory) -----------------------


def table_feed(name: str, resource: str, plural: str, singular: str, columns: dict,
               key: str, enabled: bool = True) -> FeedSpec:
    """A ref feed whose records carry a table's columns as text."""
    node = StructType([StructField(f, StringType()) for f in columns])
    fields = tuple(Field(col, f, kind) for f, (col, kind) in columns.items())
    return FeedSpec(name=name, category="ref", array_path=f"payload.{resource}.{plural}.{singular}",
                    node_schema=node, fields=fields + (Field("ingested_at", "@ingested_at", "ts"),),
                    key=(key,), enabled=enabled, page_size=REF_PAGE, multiline=False,
                    keep_unknown=False)


REF_TABLE_FEEDS = (
    ("nation", table_feed("nation", "NationResource", "Nations", "Nation",
                          {"NationKey": ("n_nationkey", "int"), "Name": ("n_name", "string"),
                           "RegionKey": ("n_regionkey", "int")}, "n_nationkey"), "n_nationkey"),
    ("region", table_feed("region", "RegionResource", "Regions", "Region",
                          {"RegionKey": ("r_regionkey", "int"), "Name": ("r_name", "string")},
                          "r_regionkey"), "r_regionkey"),
    ("supplier", table_feed("supplier", "SupplierResource", "Suppliers", "Supplier",
                            {"SuppKey": ("s_suppkey", "long"), "Name": ("s_name", "string"),
                             "NationKey": ("s_nationkey", "int")}, "s_suppkey", enabled=False),
     "s_suppkey"),
    ("customer", table_feed("customer", "CustomerResource", "Customers", "Customer",
                            {"CustKey": ("c_custkey", "long"), "Name": ("c_name", "string"),
                             "NationKey": ("c_nationkey", "int"),
                             "Segment": ("c_mktsegment", "string")}, "c_custkey"), "c_custkey"),
    ("part", table_feed("part", "PartResource", "Parts", "Part",
                        {"PartKey": ("p_partkey", "long"), "Name": ("p_name", "string"),
                         "Brand": ("p_brand", "string")}, "p_partkey"), "p_partkey"),
)

# A customer page is truncated in transit when its first customer is in this segment.
CORRUPT_SEGMENT = "BUILDING"
# Pages whose first customer is in this one arrive with quoted numbers.
QUOTED_SEGMENT = "MACHINERY"

# Pages whose first customer is in this one have a first record without its closing brace.
GARBLED_SEGMENT = "HOUSEHOLD"

# The day of the backfill query.
BACKFILL_DAY = dt.date(2001, 6, 1)

# --- events ------------------------------------------------------------------
# Event types standing in for hub airports, and the sweep's start time.
HUB_EVENT_TYPES = ("click", "purchase")
HUB_SINCE = "2024-01-15 00:00:00"
# Events of the second batch carry the new ``props`` column.
EVOLVED_FROM = "2024-01-16 00:00:00"
# Events of a third batch carry more.
EVOLVED_AGAIN = "2024-01-24 00:00:00"

EVENT_NODE = StructType([StructField(n, StringType()) for n in ("EventId", "UserId", "Type", "Value", "Props")])
EVENTS_FEED = FeedSpec(
    name="events", category="ops", array_path="payload.EventResource.Events.Event", node_schema=EVENT_NODE,
    fields=(Field("event_id", "EventId", "long"), Field("user_id", "UserId", "long"), Field("event_type", "Type"),
            Field("value", "Value", "double"), Field("props", "Props")),
    key=("event_id",), page_size=REF_PAGE, multiline=False,
)

# Nation pairs (customer nation, supplier nation) of the route lookup.
ROUTES = (
    ("NATION_0", "NATION_1"), ("NATION_1", "NATION_2"), ("NATION_2", "NATION_3"),
    ("NATION_3", "NATION_4"), ("NATION_4", "NATION_5"), ("NATION_5", "NATION_6"),
    ("NATION_6", "NATION_7"), ("NATION_7", "NATION_8"), ("NATION_8", "NATION_9"),
    ("NATION_9", "NATION_10"),
)
# The days looked up on every route: each third day of 1998's first half.
ROUTE_DAYS = tuple(dt.date(1998, 1, 1) + dt.timedelta(days=n) for n in range(0, 181, 3))

# nation and region are closed lists; they are broadcast under this bound.
SMALL_DIM_ROWS = 10_000
