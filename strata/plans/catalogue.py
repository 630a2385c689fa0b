"""The query catalogue: each operator of the survey exercised on the driver's
tables, with an equivalent DuckDB SQL text for the oracle comparison.

Every query reads whole tables; nothing is sampled or capped.  Queries that
land files or run streams write under a fresh folder of the shared
checkpoint location (``strata.session.scratch_path``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.keys import surrogate_key
from strata.functions.records import record_count
from strata.functions.status import ordered_case
from strata.functions.typed import parse_local, parse_utc, try_double, try_int, wall_clock
from strata.operators.audit import SWEEP, completeness, landed_pages, newest_pages, offset_gaps, with_runs
from strata.operators.dedupe import latest
from strata.operators.enrich import star_left_join
from strata.operators.flatten import flatten
from strata.operators.lookup import departures_from_hubs, route_frame, routes_on
from strata.operators.quality import (dq_metrics, expect_flags, partition_split, quarantine,
                                      silver_by)
from strata.operators.salvage import salvaged_documents, with_salvaged
from strata.plans import tablefeeds as tf
from strata.plans.incremental import EPOCH, PART, Layout, refresh_changes, touched_parts
from strata.session import scratch_path, shuffle_for
from strata.sources.bronze import envelope_schema, read_bronze, read_landing
from strata.sources.catalog import save_bucketed
from strata.sources.discover import appeared, draft_feed, evolve, recall, remember
from strata.sources.landing import (document_name, envelope_json, ingestion_metadata, name_of, pages_by_key_range,
                                    with_position_pages,
                                    partition_folder, to_pages, write_landing, write_landings, write_named_landing)
from strata.sources.tables import read_evolved, table, write_table
from strata.spec import Dim, FeedSpec, Field, Rule
from strata.streaming.ingest import bronze_path, ingest_feeds, landing_path
from strata.streaming.ledger import LOAD, current_documents, ingest_changed
from strata.streaming.latest import compact_latest, read_latest, start_latest

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return table(spark, d, name)


def _order_sql(cols) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


_LINE_TIES = [c for c in tf.LINE_COLUMNS if c not in tf.LINE_KEY + tf.LINE_ORDER]
_STAGED_TIES = [c for c in tf.STAGED_LINE_COLUMNS if c not in tf.LINE_KEY + tf.LINE_ORDER]


def _latest_sql(source: str, columns, ties) -> str:
    cols = ", ".join(columns)
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(tf.LINE_KEY)} ORDER BY {_order_sql(list(tf.LINE_ORDER) + list(ties))}) AS rn "
            f"FROM {source}) WHERE rn = 1")


# --------------------------------------------------------------------------
# Landing documents built from orders (q01, q02, q07, q21, q26)
# --------------------------------------------------------------------------

def order_documents(spark: SparkSession, d: str) -> DataFrame:
    """One envelope per page of 50 orders (key ranges), ``TotalCount`` = all
    orders (a scalar subquery), ``ingested_at`` = the month of the page's newest
    order, folder by day (an ops feed)."""
    o = _t(spark, d, "orders")
    total = o.select(F.count(F.lit(1))).scalar()
    page = pages_by_key_range(o, "o_orderkey", tf.OPS_PAGE).alias("page_offset")
    pages = to_pages(o.select("*", page), ["page_offset"], tf.order_record(o), F.col("o_orderkey"),
                     extra=[F.date_trunc("month", F.max("o_orderdate")).alias("fetched")])
    spec = tf.ORDERS_FEED
    _, resource, plural, singular = spec.array_path.split(".")
    meta = ingestion_metadata("ops", spec.name, F.col("fetched"), tf.SCRIPT,
                              offset=F.col("page_offset"), limit=spec.page_size,
                              endpoint="orders")
    return pages.select(
        envelope_json(F.col("records"), resource, plural, singular, meta, total).alias("document"),
        partition_folder("ops", F.col("fetched")).alias("folder"),
    )


def _parsed(docs: DataFrame, spec: FeedSpec) -> DataFrame:
    return docs.select(F.from_json("document", envelope_schema(spec, with_corrupt=False)).alias("e")) \
               .select("e.*")


def _page_summary(bronze: DataFrame, spec: FeedSpec) -> DataFrame:
    flagged = bronze.withColumn("single_object", F.col(spec.array_path).startswith("{"))
    pages = landed_pages(flagged, spec, keep=("single_object",))
    return pages.select(
        "category", "entity", "page_offset", "page_limit",
        partition_folder("ops", F.to_timestamp("ingested_at")).alias("folder"),
        "n_records", "total_count", "batch_id", "single_object",
        document_name("entity", F.date_format(F.to_timestamp("ingested_at"), "HHmmss"),
                      "page_offset").alias("doc_name"),
    )


_PAGES_OUT = ["page_offset", "page_limit", "folder", "n_records", "total_count", "batch_id",
              "single_object", "doc_name"]


def q01_landing_envelope(spark, d):
    docs = order_documents(spark, d)
    return _page_summary(_parsed(docs, tf.ORDERS_FEED), tf.ORDERS_FEED).select(*_PAGES_OUT)


_ORDER_PAGES_SQL = f"""WITH p AS (
  SELECT o_orderkey // 50 AS pg, count(*) AS n,
         date_trunc('month', max(o_orderdate)) AS fetched
  FROM orders GROUP BY o_orderkey // 50)"""

Q01_SQL = _ORDER_PAGES_SQL + """
SELECT CAST(pg * 50 AS BIGINT) AS page_offset, CAST(50 AS INTEGER) AS page_limit,
  strftime(fetched, '%Y-%m-%d') AS folder, CAST(n AS BIGINT) AS n_records,
  (SELECT count(*) FROM orders) AS total_count,
  sha256('ops|orders||' || CAST(pg * 50 AS VARCHAR)) AS batch_id,
  n = 1 AS single_object,
  'orders_' || strftime(fetched, '%H%M%S') || '_' || CAST(pg * 50 AS VARCHAR) AS doc_name
FROM p"""


def q02_bronze_stream(spark, d):
    root = scratch_path(spark, "q02")
    spec = tf.ORDERS_FEED
    write_landing(order_documents(spark, d), landing_path(f"{root}/landing", spec))
    paths = ingest_feeds(spark, [spec], f"{root}/landing", root)
    return _page_summary(read_bronze(spark, paths[spec.name], spec), spec).select(*_PAGES_OUT)


def _table_feed_documents(spark, d, table_name, spec, key, extra=()):
    t = _t(spark, d, table_name)
    cols = {f.path: f.name for f in spec.fields if not f.path.startswith("@")}
    record = F.struct(*[F.col(c).cast("string").alias(f) for f, c in cols.items()])
    page = pages_by_key_range(t, key, spec.page_size).alias("page_offset")
    pages = to_pages(t.select("*", page), ["page_offset"], record, F.col(key), extra=extra)
    _, resource, plural, singular = spec.array_path.split(".")
    ts = F.to_timestamp(F.lit(tf.SWEEP_TS))
    meta = ingestion_metadata("ref", spec.name, ts, tf.SCRIPT, offset=F.col("page_offset"),
                              limit=spec.page_size, endpoint=spec.name)
    return pages.select(
        envelope_json(F.col("records"), resource, plural, singular, meta).alias("document"),
        partition_folder("ref", ts).alias("folder"), "page_offset",
        *[c for c in pages.columns if c not in ("page_offset", "records")])


def q03_ref_factory(spark, d):
    root = scratch_path(spark, "q03")
    write_landings([(_table_feed_documents(spark, d, table_name, spec, key),
                     landing_path(f"{root}/landing", spec))
                    for table_name, spec, key in tf.REF_TABLE_FEEDS])
    specs = [spec for _, spec, _ in tf.REF_TABLE_FEEDS]
    paths = ingest_feeds(spark, specs, f"{root}/landing", root)
    out = None
    for spec in specs:
        if not spec.enabled:
            continue
        b = read_bronze(spark, paths[spec.name], spec)
        # The folder is the one the file lies in: a month, for reference feeds.
        folder = F.regexp_extract("source_file", "folder=([0-9-]+)", 1).alias("folder")
        counts = b.groupBy(folder).agg(F.count(F.lit(1)).alias("n_documents"),
                                       F.sum(record_count(F.col(spec.array_path))).alias("n_records"))
        counts = counts.select(F.lit(spec.name).alias("feed"), "folder", "n_documents",
                               F.col("n_records").cast("bigint").alias("n_records"))
        out = counts if out is None else out.unionByName(counts)
    return out


Q03_SQL = " UNION ALL ".join(
    f"SELECT '{spec.name}' AS feed, '{tf.SWEEP_TS[:7]}' AS folder, count(DISTINCT {key} // 100) AS n_documents, "
    f"count(*) AS n_records FROM {table_name}"
    for table_name, spec, key in tf.REF_TABLE_FEEDS if spec.enabled)


def q04_schema_evolution(spark, d):
    root = scratch_path(spark, "q04")
    ev = _t(spark, d, "events")
    cut = F.lit(tf.EVOLVED_FROM).cast("timestamp_ntz")
    write_table(ev.filter(F.col("ts") < cut).drop("props"), f"{root}/bronze_events", mode="append")
    write_table(ev.filter(F.col("ts") >= cut), f"{root}/bronze_events", mode="append")
    return read_bronze(spark, f"{root}/bronze_events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")


Q04_SQL = f"""SELECT event_id, ts, user_id, event_type, value,
  CASE WHEN ts < TIMESTAMP '{tf.EVOLVED_FROM}' THEN NULL ELSE props END AS props FROM events"""


def q04b_envelope_evolution(spark, d):
    """Two batches of event pages go through the bronze stream; the second one
    has a new field in its records and two new ones outside them: a revision
    in the envelope and a page checksum in the resource's Meta block."""
    root = scratch_path(spark, "q04b")
    spec = tf.EVENTS_FEED
    land, cut = landing_path(f"{root}/landing", spec), F.lit(tf.EVOLVED_FROM).cast("timestamp_ntz")
    ev = _t(spark, d, "events")
    names = {"event_id": "EventId", "user_id": "UserId", "event_type": "Type", "value": "Value", "props": "Props"}
    _, resource, plural, singular = spec.array_path.split(".")
    ts = F.to_timestamp(F.lit(tf.SWEEP_TS))
    meta = ingestion_metadata("ops", spec.name, ts, tf.SCRIPT, offset=F.col("page_offset"), limit=spec.page_size)
    for batch, cond, cols in ((1, F.col("ts") < cut, list(names)[:-1]), (2, F.col("ts") >= cut, list(names))):
        record = F.struct(*[F.col(c).cast("string").alias(names[c]) for c in cols])
        page = pages_by_key_range(ev, "event_id", spec.page_size).alias("page_offset")
        pages = to_pages(ev.filter(cond).select("*", page), ["page_offset"], record, F.col("event_id"),
                         extra=[F.max("user_id").alias("top")])
        doc = envelope_json(F.col("records"), resource, plural, singular, meta)
        if batch == 2:
            doc = F.regexp_replace(doc, r"^\{", '{"revision":2,')
            doc = F.regexp_replace(doc, r'"Meta":\{', F.concat(F.lit('"Meta":{"Top":'), F.col("top"), F.lit(",")))
        write_landing(pages.select(doc.alias("document"), partition_folder("ops", ts).alias("folder")), land)
        paths = ingest_feeds(spark, [spec], f"{root}/landing", root)
    bronze = read_bronze(spark, paths[spec.name], spec).select(
        "*", F.col("unknown.envelope.revision").try_cast("int").alias("revision"),
        F.get_json_object("unknown.resource.Meta", "$.Top").try_cast("bigint").alias("page_top"))
    return flatten(bronze, spec, keep=("revision", "page_top"))


Q04B_SQL = f"""WITH e AS (SELECT *, ts >= TIMESTAMP '{tf.EVOLVED_FROM}' AS late FROM events)
SELECT event_id, user_id, event_type, value, CASE WHEN late THEN props END AS props,
  CAST(CASE WHEN late THEN 2 END AS INTEGER) AS revision,
  CASE WHEN late THEN max(user_id) OVER (PARTITION BY late, event_id // 100) END AS page_top
FROM e"""


def q04c_appearing_columns(spark, d):
    """Three batches of event pages; the second brings a new record field, the third
    two more, nested, and new fields in envelope and resource.  After each batch the
    columns that appeared are found in its documents and remembered; its rows are
    appended to one stored table, read with all columns: NULL where a row is older."""
    root = scratch_path(spark, "q04c")
    spec = tf.EVENTS_FEED
    land, columns, staged = landing_path(f"{root}/landing", spec), f"{root}/columns", f"{root}/staged"
    ev = _t(spark, d, "events")
    _, resource, plural, singular = spec.array_path.split(".")
    base = [F.col(c).cast("string").alias(n) for n, c in (("EventId", "event_id"), ("UserId", "user_id"), ("Type", "event_type"),
                                                          ("Value", "value"))]
    later = [base, [*base, F.hour("ts").alias("Hour")],
             [*base, F.hour("ts").alias("Hour"),
              F.struct((F.col("user_id") % 2 == 0).alias("Even"), (F.col("event_id") / 4).alias("Quarter")).alias("Info")]]
    batch = F.when(F.col("ts") < F.lit(tf.EVOLVED_FROM).cast("timestamp_ntz"), 0).when(
        F.col("ts") < F.lit(tf.EVOLVED_AGAIN).cast("timestamp_ntz"), 1).otherwise(2)
    for i, fields in enumerate(later):
        ts = F.to_timestamp(F.lit(tf.SWEEP_TS)) + F.expr(f"INTERVAL {i} DAYS")
        meta = ingestion_metadata("ops", spec.name, ts, tf.SCRIPT, offset=F.col("page_offset"), limit=spec.page_size)
        page = pages_by_key_range(ev, "event_id", spec.page_size).alias("page_offset")
        pages = to_pages(ev.filter(batch == i).select("*", page), ["page_offset"], F.struct(*fields), F.col("event_id"))
        doc = envelope_json(F.col("records"), resource, plural, singular, meta)
        if i == 2:
            doc = F.regexp_replace(doc, r"^\{", '{"revision":2,"channel":"b",')
            doc = F.regexp_replace(doc, r'"Meta":\{', '"Checked":true,"Meta":{')
        write_landing(pages.select(doc.alias("document"), partition_folder("ops", ts).alias("folder")), land)
        paths = ingest_feeds(spark, [spec], f"{root}/landing", root)
        day = F.date_add(F.to_date(F.lit(tf.SWEEP_TS)), i)
        new = read_bronze(spark, paths[spec.name], spec).where(F.col("ingest_date") == day)
        known = recall(spark, columns, spec)
        found = appeared(new, known)
        remember(spark, columns, spec, found)
        write_table(flatten(new, evolve(known, found)), staged, mode="append")
    now = recall(spark, columns, spec)
    return read_evolved(spark, staged, now).select(*[f.name for f in now.fields])


Q04C_SQL = f"""WITH e AS (SELECT *, CASE WHEN ts < TIMESTAMP '{tf.EVOLVED_FROM}' THEN 0
    WHEN ts < TIMESTAMP '{tf.EVOLVED_AGAIN}' THEN 1 ELSE 2 END AS batch FROM events)
SELECT event_id, user_id, event_type, value, CAST(NULL AS VARCHAR) AS props, CASE WHEN batch >= 1 THEN CAST(hour(ts) AS BIGINT) END AS hour,
  CASE WHEN batch = 2 THEN user_id % 2 = 0 END AS info_even, CASE WHEN batch = 2 THEN event_id / 4 END AS info_quarter,
  CASE WHEN batch = 2 THEN CAST(2 AS BIGINT) END AS revision, CASE WHEN batch = 2 THEN 'b' END AS channel,
  CASE WHEN batch = 2 THEN true END AS checked FROM e"""


def _line_pages(lines: DataFrame, order_key: str = "l_orderkey", distinct: bool = True) -> DataFrame:
    """Per order, pages of at most 50 distinct lines (line numbers 1-50 on
    page 0, 51-100 on page 1, ...): bounded whatever the order size, and
    re-delivered versions of a line collapse inside the aggregation.  Only
    the line number varies inside a page, so the aggregation collects ints
    and the records are built from them afterwards."""
    chunk = F.coalesce(F.floor((F.col("l_linenumber") - 1) / F.lit(tf.OPS_PAGE)), F.lit(0)).alias("chunk")
    collect = F.collect_set if distinct else F.collect_list
    pages = lines.select(order_key, "l_linenumber", chunk).groupBy(order_key, "chunk").agg(
        F.array_sort(collect("l_linenumber")).alias("_lines"))
    key = F.col(order_key).cast("string")
    records = F.transform("_lines", lambda n: F.struct(key.alias("OrderKey"),
                                                       n.cast("string").alias("LineNumber")))
    return pages.select(order_key, "chunk", records.alias("records"))


_LINE_REF_NODE = StructType([StructField("OrderKey", StringType()),
                                StructField("LineNumber", StringType())])
_LINE_REF_FEED = FeedSpec(name="order_lines", category="ops",
                          array_path="payload.OrderLineResource.OrderLines.OrderLine",
                          node_schema=_LINE_REF_NODE,
                          fields=(Field("l_orderkey", "OrderKey", "long"),
                                  Field("l_linenumber", "LineNumber", "int")),
                          key=("l_orderkey",))


def _order_line_docs(pages: DataFrame, single_as_object: bool) -> DataFrame:
    spec = _LINE_REF_FEED
    _, resource, plural, singular = spec.array_path.split(".")
    meta = ingestion_metadata("ops", spec.name, F.to_timestamp(F.lit(tf.SWEEP_TS)), tf.SCRIPT,
                              offset=F.col("o_orderkey"))
    return pages.select("o_orderkey", envelope_json(
        F.col("records"), resource, plural, singular, meta,
        single_as_object=single_as_object).alias("document"))


def q05_normalize_single(spark, d):
    # A codegen'd distinct before paging beats de-duplicating inside the pages here.
    lines = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    pages = _line_pages(lines, distinct=False).withColumnRenamed("l_orderkey", "o_orderkey")
    docs = _order_line_docs(pages, single_as_object=True)
    spec = _LINE_REF_FEED
    parsed = docs.select("o_orderkey", F.from_json("document", envelope_schema(spec, False)).alias("e"))
    raw = F.col(f"e.{spec.array_path}")
    return parsed.groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(
        F.sum(record_count(raw)).cast("bigint").alias("n_lines"),
        F.count_if(raw.startswith("{")).alias("n_object_pages"))


Q05_SQL = """SELECT l_orderkey, count(DISTINCT l_linenumber) AS n_lines,
  CAST(CASE WHEN count(DISTINCT l_linenumber) = 1 THEN 1 ELSE 0 END AS BIGINT) AS n_object_pages
FROM lineitem GROUP BY l_orderkey"""


def q05b_drafted_feed(spark, d):
    """The order-line feed drafted from its pages, some of which hold a lone object and
    some an array, then used to read them."""
    lines = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    pages = _line_pages(lines, distinct=False).withColumnRenamed("l_orderkey", "o_orderkey")
    path = scratch_path(spark, "q05b")
    write_table(_order_line_docs(pages, single_as_object=True).select("document"), path)
    docs = spark.read.parquet(path)
    spec = draft_feed(docs, "order_lines", "ops", key=("OrderKey",), column=lambda p: "l_" + p.lower())
    return flatten(_parsed(docs, spec), spec).select("l_orderkey", "l_linenumber", F.lit(spec.array_path).alias("array_path"),
                                                     F.lit(",".join(f.kind for f in spec.fields)).alias("kinds"))


Q05B_SQL = """SELECT DISTINCT l_orderkey, l_linenumber, 'payload.OrderLineResource.OrderLines.OrderLine' AS array_path,
  'long,int' AS kinds FROM lineitem"""


def q06_explode_outer_empty(spark, d):
    orders = _t(spark, d, "orders").select("o_orderkey")
    lines = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    shuffle_for(spark, lines.count())
    # Lines are paged first (per order and block of 50 line numbers, repeats
    # collapsed map-side), so an order holding a third of all lines still
    # yields bounded pages spread over many tasks.  Pages of known orders are
    # kept by a semi join (the page side may be skewed: AQE splits it); an
    # order without lines gets its (empty) page, as the feed would, through
    # an anti join against one key row per order.  No join ever gathers a hot
    # order's lines on its build side.
    pages = _line_pages(lines).withColumnRenamed("l_orderkey", "o_orderkey")
    matched = pages.join(orders, "o_orderkey", "left_semi").select("o_orderkey", "records")
    empty = F.array().cast(pages.schema["records"].dataType)
    line_orders = lines.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    missing = orders.join(line_orders, "o_orderkey", "left_anti").select("o_orderkey", empty.alias("records"))
    paged = matched.unionByName(missing)
    docs = _order_line_docs(paged, single_as_object=False)
    bronze = docs.select("o_orderkey", F.from_json("document", envelope_schema(_LINE_REF_FEED, False))
                         .alias("e")).select("o_orderkey", "e.*")
    return flatten(bronze, _LINE_REF_FEED, keep=("o_orderkey",)).select("o_orderkey", "l_linenumber")


Q06_SQL = """SELECT o.o_orderkey, l.l_linenumber FROM orders o
LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) l ON o.o_orderkey = l.l_orderkey"""


def q07_flatten_ops(spark, d):
    bronze = _parsed(order_documents(spark, d), tf.ORDERS_FEED)
    staged = flatten(bronze, tf.ORDERS_FEED)
    return staged.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                         wall_clock("o_orderdate").alias("o_orderdate"), "order_date_local",
                         "o_orderpriority")


Q07_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  o_orderdate AS order_date_local, o_orderpriority FROM orders"""


_NATION_NODE = StructType([
    StructField("NationCode", StringType()), StructField("RegionCode", StringType()),
    StructField("Names", StructType([StructField("Name", StructType([
        StructField("@LanguageCode", StringType()), StructField("$", StringType())]))]))])
_NATION_FEED = FeedSpec(name="nations", category="ref",
                        array_path="payload.NationResource.Nations.Nation", node_schema=_NATION_NODE,
                        fields=(Field("n_nationkey", "NationCode", "int"),
                                Field("n_name", "Names", "name"),
                                Field("n_regionkey", "RegionCode", "int")),
                        key=("n_nationkey",))


def q08_flatten_ref(spark, d):
    n = _t(spark, d, "nation")
    rec = F.struct(F.col("n_nationkey").cast("string").alias("NationCode"),
                   F.col("n_regionkey").cast("string").alias("RegionCode"),
                   F.struct(F.struct(F.lit("EN").alias("@LanguageCode"),
                                     F.col("n_name").alias("$")).alias("Name")).alias("Names"))
    page = pages_by_key_range(n, "n_nationkey", tf.REF_PAGE).alias("page_offset")
    pages = to_pages(n.select("*", page), ["page_offset"], rec, F.col("n_nationkey"))
    spec = _NATION_FEED
    _, resource, plural, singular = spec.array_path.split(".")
    meta = ingestion_metadata("ref", spec.name, F.to_timestamp(F.lit(tf.SWEEP_TS)), tf.SCRIPT,
                              offset=F.col("page_offset"), limit=spec.page_size)
    docs = pages.select(envelope_json(F.col("records"), resource, plural, singular, meta).alias("document"))
    return flatten(_parsed(docs, spec), spec)


Q08_SQL = "SELECT n_nationkey, n_name, n_regionkey FROM nation"


def q09_try_typed(spark, d):
    ev = _t(spark, d, "events")
    user_text = F.when(F.col("event_type") == "signup", F.concat(F.lit("U"), F.col("user_id"))) \
        .otherwise(F.col("user_id").cast("string"))
    utc_text = F.when(F.col("event_type") == "error",
                      F.date_format("ts", "yyyy-MM-dd HH:mm")) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm'Z'"))
    local_text = F.when(F.col("event_type") == "view", F.lit("n/a")) \
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
    return ev.select("event_id", try_int(user_text).alias("user_num"),
                     wall_clock(parse_utc(utc_text)).alias("dep_utc"),
                     parse_local(local_text).alias("dep_local"))


Q09_SQL = """SELECT event_id,
  CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(user_id AS INTEGER) END AS user_num,
  CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('minute', ts) END AS dep_utc,
  CASE WHEN event_type = 'view' THEN NULL ELSE date_trunc('minute', ts) END AS dep_local
FROM events"""


def q10_surrogate_key(spark, d):
    ev = _t(spark, d, "events")
    etype = F.when(F.col("value") < F.lit(1.0), F.lit(None)).otherwise(F.col("event_type"))
    user = F.when(F.col("event_type") == "purchase", F.lit(None)).otherwise(F.col("user_id"))
    return ev.select("event_id", surrogate_key(etype, user, F.to_date("ts")).alias("event_key"))


Q10_SQL = """SELECT event_id, concat_ws('-',
  CASE WHEN value < CAST(1.0 AS DOUBLE) THEN NULL ELSE event_type END,
  CASE WHEN event_type = 'purchase' THEN NULL ELSE user_id END,
  CAST(ts AS DATE)) AS event_key FROM events"""


def q11_latest_by_key(spark, d):
    li = _t(spark, d, "lineitem")
    return latest(li, tf.LINE_KEY, tf.LINE_ORDER, _LINE_TIES, method="window")


def q11b_max_by(spark, d):
    li = _t(spark, d, "lineitem")
    return latest(li, tf.LINE_KEY, tf.LINE_ORDER, _LINE_TIES, method="aggregate")


Q11_SQL = _latest_sql("lineitem", tf.LINE_COLUMNS, _LINE_TIES)

_STAGED_CTE = f"WITH staged AS ({tf.STAGED_LINES_SQL})\n"
_LINE_DROP_SQL = " AND ".join(f"coalesce(({r.sql}), false)" for r in tf.LINE_RULES
                              if r.sql and r.action == "drop")
_LINE_FAIL_SQL = " OR ".join(f"({r.fails()})" for r in tf.LINE_RULES)


def _silver_lines(spark, d):
    staged = tf.staged_lines(_t(spark, d, "lineitem"))
    return silver_by(staged, tf.LINE_KEY, tf.LINE_ORDER, tf.LINE_RULES, _STAGED_TIES)


def q12_ops_silver(spark, d):
    return _silver_lines(spark, d)


_SILVER_LINES_SQL = (f"SELECT * FROM ({_latest_sql('staged', tf.STAGED_LINE_COLUMNS, _STAGED_TIES)}) "
                     f"WHERE {_LINE_DROP_SQL}")
Q12_SQL = _STAGED_CTE + _SILVER_LINES_SQL


def q12b_check_then_dedup(spark, d):
    """The offered alternative to the feed's order: checks first,
    so a key whose newest version is bad keeps its newest good version."""
    staged = tf.staged_lines(_t(spark, d, "lineitem"))
    return silver_by(staged, tf.LINE_KEY, tf.LINE_ORDER, tf.LINE_RULES, _STAGED_TIES,
                     mode="check_then_dedup")


Q12B_SQL = (_STAGED_CTE + f", good AS (SELECT * FROM staged WHERE {_LINE_DROP_SQL})\n"
            + _latest_sql("good", tf.STAGED_LINE_COLUMNS, _STAGED_TIES))


BUCKETS = 16


def _bucketed(spark, df, name, key):
    path = scratch_path(spark, name)
    return save_bucketed(df, f"{name}_{path.rsplit('-', 1)[1]}", [key], BUCKETS, path)


def _bucketed_silver_lines(spark, d):
    """Silver lines from a catalog table of staged lines in buckets of their order."""
    staged = _bucketed(spark, tf.staged_lines(_t(spark, d, "lineitem")), "staged_lines", "l_orderkey")
    return silver_by(staged, tf.LINE_KEY, tf.LINE_ORDER, tf.LINE_RULES, _STAGED_TIES)


def q12c_bucketed_silver(spark, d):
    """q12 over a bucketed catalog table: no exchange."""
    return _bucketed_silver_lines(spark, d)


def q13_ops_quarantine(spark, d):
    return quarantine(tf.staged_lines(_t(spark, d, "lineitem")), tf.LINE_RULES)


Q13_SQL = _STAGED_CTE + f"SELECT * FROM staged WHERE {_LINE_FAIL_SQL}"


def q14_ref_quarantine(spark, d):
    return quarantine(tf.staged_parts(_t(spark, d, "part")), tf.PART_RULES)


Q14_SQL = (f"WITH staged AS ({tf.STAGED_PARTS_SQL})\nSELECT * FROM staged WHERE "
           + " OR ".join(f"({r.fails()})" for r in tf.PART_RULES))


def q15_ref_silver(spark, d):
    return silver_by(tf.staged_parts(_t(spark, d, "part")), tf.PART_KEY, tf.PART_ORDER,
                     tf.PART_RULES, null_key_prefilter=True)


_PART_COLS = ["part_code", "part_name", "p_partkey", "p_type", "p_size", "p_retailprice"]
Q15_SQL = (f"WITH staged AS ({tf.STAGED_PARTS_SQL})\nSELECT {', '.join(_PART_COLS)} FROM ("
           f"SELECT *, row_number() OVER (PARTITION BY part_code ORDER BY "
           f"{_order_sql(['p_partkey', 'part_name', 'p_type', 'p_size', 'p_retailprice'])}) AS rn "
           f"FROM staged WHERE part_code IS NOT NULL) WHERE rn = 1 AND "
           + " AND ".join(f"coalesce(({r.sql}), false)" for r in tf.PART_RULES))


def q16_dq_metrics(spark, d):
    staged = tf.staged_lines(_t(spark, d, "lineitem"))
    return dq_metrics(latest(staged, tf.LINE_KEY, tf.LINE_ORDER, _STAGED_TIES), tf.LINE_RULES)


def _metric_sql(r: Rule) -> str:
    if r.sql is not None:
        p, f = f"coalesce(({r.sql}), false)", f"NOT coalesce(({r.sql}), false)"
    else:
        f = f"coalesce(({r.fails()}), false)"
        p = f"NOT {f}"
    action = r.action if "silver" in r.applies_to else "quarantine"
    return (f"SELECT '{r.name}' AS rule, '{action}' AS action, count(*) FILTER (WHERE {p}) AS n_pass, "
            f"count(*) FILTER (WHERE {f}) AS n_fail FROM checked")


Q16_SQL = _STAGED_CTE + f""", checked AS (SELECT * FROM (SELECT *, row_number() OVER (
  PARTITION BY {', '.join(tf.LINE_KEY)} ORDER BY {_order_sql(list(tf.LINE_ORDER) + _STAGED_TIES)}) AS rn FROM staged)
  WHERE rn = 1)
""" + "\nUNION ALL\n".join(_metric_sql(r) for r in tf.LINE_RULES)


_DOC_RULES = (Rule("valid_size", "size_chars BETWEEN 100 AND 5000 AND lang IS NOT NULL",
                   action="warn"),)


def q17_warn_only(spark, d):
    docs = _t(spark, d, "documents").select(
        "doc_id", "lang", "source", try_double(F.col("n_chars").cast("string")).alias("size_chars"))
    return expect_flags(docs, _DOC_RULES)


Q17_SQL = """SELECT doc_id, lang, source, CAST(n_chars AS DOUBLE) AS size_chars,
  coalesce(CAST(n_chars AS DOUBLE) BETWEEN 100 AND 5000 AND lang IS NOT NULL, false) AS valid_size
FROM documents"""


def _event_status():
    return ordered_case([
        (F.col("value") > F.lit(15.0), "Delayed"),
        (F.col("event_type").isin("click", "view", "signup"), "In Flight"),
        (F.col("event_type") == "error", "Cancelled"),
    ], "On Time")


def q18_status_case(spark, d):
    ev = _t(spark, d, "events")
    return ev.select("event_id", "event_type", F.hour("ts").alias("event_hour"),
                     _event_status().alias("status"))


Q18_SQL = """SELECT event_id, event_type, CAST(hour(ts) AS INTEGER) AS event_hour,
  CASE WHEN value > CAST(15.0 AS DOUBLE) THEN 'Delayed'
       WHEN event_type IN ('click', 'view', 'signup') THEN 'In Flight'
       WHEN event_type = 'error' THEN 'Cancelled' ELSE 'On Time' END AS status
FROM events"""


def _nation_roles(spark, d):
    orders = _t(spark, d, "orders")
    customer = _t(spark, d, "customer")
    supplier = _t(spark, d, "supplier")
    nation = _t(spark, d, "nation")
    return [
        Dim(orders, "o", "f.l_orderkey = o.o_orderkey", keep=("o_custkey",)),
        Dim(customer, "cu", "o.o_custkey = cu.c_custkey", keep=("c_nationkey",)),
        Dim(supplier, "su", "f.l_suppkey = su.s_suppkey", keep=("s_nationkey",)),
        Dim(nation, "org", "cu.c_nationkey = org.n_nationkey", {"cust_nation": "n_name"},
            max_rows=tf.SMALL_DIM_ROWS),
        Dim(nation, "dst", "su.s_nationkey = dst.n_nationkey", {"supp_nation": "n_name"},
            max_rows=tf.SMALL_DIM_ROWS),
    ]


_Q19_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
             "cust_nation", "supp_nation"]


def q19_role_playing(spark, d):
    li = _t(spark, d, "lineitem")
    return star_left_join(li, _nation_roles(spark, d)).select(*_Q19_COLS)


_Q19_FROM = """FROM lineitem f
LEFT JOIN orders o ON f.l_orderkey = o.o_orderkey
LEFT JOIN customer cu ON o.o_custkey = cu.c_custkey
LEFT JOIN supplier su ON f.l_suppkey = su.s_suppkey
LEFT JOIN nation org ON cu.c_nationkey = org.n_nationkey
LEFT JOIN nation dst ON su.s_nationkey = dst.n_nationkey"""
Q19_SQL = f"""SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_suppkey, f.l_shipdate,
  org.n_name AS cust_nation, dst.n_name AS supp_nation
{_Q19_FROM}"""


def _line_status():
    return ordered_case([
        (F.col("l_linestatus") == "O", "Delayed"),
        (F.col("l_returnflag").isin("R"), "In Flight"),
        (F.col("l_returnflag") == "A", "Cancelled"),
    ], "On Time")


def q20_fact_master(spark, d):
    """The gold fact over silver lines: five dimension roles plus the order
    hop that carries the customer key."""
    return _fact_master(spark, d, _silver_lines(spark, d), _t(spark, d, "orders"))


def q20b_bucketed_fact(spark, d):
    """q20 with lines and orders from catalog tables in buckets of the order key: the
    fact meets its orders where it lies."""
    return _fact_master(spark, d, _bucketed_silver_lines(spark, d), _bucketed(spark, _t(spark, d, "orders"), "orders", "o_orderkey"))


def _fact_master(spark, d, fact, orders):
    customer = _t(spark, d, "customer")
    supplier = _t(spark, d, "supplier")
    nation = _t(spark, d, "nation")
    region = _t(spark, d, "region")
    # Parts of size 1 carry neither brand nor name: matched rows that take defaults.
    part = _t(spark, d, "part").select(
        "p_partkey", *[F.when(F.col("p_size") != 1, F.col(c)).alias(c) for c in ("p_brand", "p_name")])
    dims = [
        Dim(orders, "o", "f.l_orderkey = o.o_orderkey", {"sch_dep_utc": "o_orderdate"},
            keep=("o_custkey",)),
        Dim(customer, "al", "o.o_custkey = al.c_custkey", {"airline_name": "c_name"},
            keep=("c_nationkey",)),
        Dim(supplier, "sp", "f.l_suppkey = sp.s_suppkey", keep=("s_nationkey",)),
        Dim(nation, "org", "al.c_nationkey = org.n_nationkey", {"origin_hub": "n_name"},
            max_rows=tf.SMALL_DIM_ROWS),
        Dim(nation, "dst", "sp.s_nationkey = dst.n_nationkey", {"destination": "n_name"},
            keep=("n_regionkey",), max_rows=tf.SMALL_DIM_ROWS),
        Dim(part, "ac", "f.l_partkey = ac.p_partkey",
            {"equip_code": "p_brand", "aircraft_name": "p_name"},
            defaults={"equip_code": "N/A", "aircraft_name": "Unknown Aircraft"}),
        Dim(region, "cntry", "dst.n_regionkey = cntry.r_regionkey", {"country": "r_name"},
            max_rows=tf.SMALL_DIM_ROWS),
    ]
    g = star_left_join(fact, dims)
    return g.select(
        F.col("line_id").alias("flight_id"), "airline_name",
        F.col("l_linenumber").alias("flight_number"), "origin_hub", "destination", "country",
        "equip_code", "aircraft_name", "sch_dep_utc",
        F.hour("sch_dep_utc").alias("dep_hour"),
        F.col("l_linestatus").alias("raw_time_status"),
        _line_status().alias("operational_status"),
        F.col("l_shipdate").alias("ingested_at"),
    )


Q20_SQL = _STAGED_CTE + f""", silver AS ({_SILVER_LINES_SQL})
SELECT f.line_id AS flight_id, al.c_name AS airline_name, f.l_linenumber AS flight_number,
  org.n_name AS origin_hub, dst.n_name AS destination, cntry.r_name AS country,
  coalesce(ac.p_brand, 'N/A') AS equip_code, coalesce(ac.p_name, 'Unknown Aircraft') AS aircraft_name,
  o.o_orderdate AS sch_dep_utc, CAST(hour(o.o_orderdate) AS INTEGER) AS dep_hour,
  f.l_linestatus AS raw_time_status,
  CASE WHEN f.l_linestatus = 'O' THEN 'Delayed' WHEN f.l_returnflag IN ('R') THEN 'In Flight'
       WHEN f.l_returnflag = 'A' THEN 'Cancelled' ELSE 'On Time' END AS operational_status,
  f.l_shipdate AS ingested_at
FROM silver f
LEFT JOIN orders o ON f.l_orderkey = o.o_orderkey
LEFT JOIN customer al ON o.o_custkey = al.c_custkey
LEFT JOIN supplier sp ON f.l_suppkey = sp.s_suppkey
LEFT JOIN nation org ON al.c_nationkey = org.n_nationkey
LEFT JOIN nation dst ON sp.s_nationkey = dst.n_nationkey
LEFT JOIN (SELECT p_partkey, CASE WHEN p_size <> 1 THEN p_brand END AS p_brand,
                  CASE WHEN p_size <> 1 THEN p_name END AS p_name FROM part) ac ON f.l_partkey = ac.p_partkey
LEFT JOIN region cntry ON dst.n_regionkey = cntry.r_regionkey"""


_SWEEP = ["category", "entity", "endpoint"]


def _landed_hub_pages(spark, d):
    """Two hubs' sweeps of one day, with the same offsets: orders of even and of
    odd key.  Pages of the even hub get lost, pages of the odd hub come twice,
    the second time an hour later."""
    spec = tf.ORDERS_FEED
    o = _t(spark, d, "orders").withColumn("hub", F.pmod("o_orderkey", F.lit(2))).withColumn(
        "pos", F.floor(F.col("o_orderkey") / 2))
    page = pages_by_key_range(o, "pos", tf.OPS_PAGE).alias("page_offset")
    first = F.min_by(F.struct("o_orderpriority", "o_orderstatus"), F.col("o_orderkey")).alias("first")
    pages = to_pages(o.select("*", page), ["hub", "page_offset"], tf.order_record(o), F.col("o_orderkey"),
                     extra=[first])
    pages = pages.join(F.broadcast(o.groupBy("hub").agg(F.count(F.lit(1)).alias("total"))), "hub")  # two rows
    lost = (F.col("hub") == 0) & (F.col("first.o_orderpriority") == tf.LOST_PRIORITY) & (
        F.col("first.o_orderstatus") == tf.LOST_STATUS)
    again = (F.col("hub") == 1) & (F.col("first.o_orderpriority") == tf.LOST_PRIORITY)
    sent = pages.filter(~lost).withColumn(
        "hour", F.explode(F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(tf.SWEEP_TS)) + F.col("hour") * 3600)
    meta = ingestion_metadata("ops", spec.name, at, tf.SCRIPT, offset=F.col("page_offset"), limit=spec.page_size)
    meta = F.struct(meta.getField("ingested_at").alias("ingested_at"), meta.getField("batch_id").alias("batch_id"),
                    meta.getField("category").alias("category"), meta.getField("entity").alias("entity"),
                    meta.getField("offset").alias("offset"), meta.getField("limit").alias("limit"),
                    F.concat(F.lit("orders/"), F.col("hub").cast("string")).alias("endpoint"))
    _, resource, plural, singular = spec.array_path.split(".")
    docs = sent.select(envelope_json(F.col("records"), resource, plural, singular, meta, F.col("total"))
                       .alias("document"))
    return newest_pages(landed_pages(_parsed(docs, spec), spec), _SWEEP)


def q21_completeness(spark, d):
    return completeness(_landed_hub_pages(spark, d), _SWEEP)


_KEPT_SQL = f"""WITH p AS (
  SELECT o_orderkey % 2 AS hub, o_orderkey // 2 // 50 AS pg, count(*) AS n,
         arg_min(o_orderpriority, o_orderkey) AS pri, arg_min(o_orderstatus, o_orderkey) AS st
  FROM orders GROUP BY 1, 2),
kept AS (SELECT 'orders/' || CAST(hub AS VARCHAR) AS endpoint, pg * 50 AS page_offset, pg * 50 + 50 AS page_end, n FROM p
         WHERE NOT (hub = 0 AND pri = '{tf.LOST_PRIORITY}' AND st = '{tf.LOST_STATUS}')),
tot AS (SELECT 'orders/' || CAST(o_orderkey % 2 AS VARCHAR) AS endpoint, count(*) AS total FROM orders GROUP BY 1)"""

Q21_SQL = _KEPT_SQL + """
SELECT 'ops' AS category, 'orders' AS entity, endpoint, count(*) AS n_pages,
  CAST(sum(n) AS BIGINT) AS n_records, max(total) AS total_count,
  CAST(ceil(max(total) / 50) AS BIGINT) AS expected_pages,
  CAST(max(total) - sum(n) AS BIGINT) AS missing_records, sum(n) >= max(total) AS complete
FROM kept JOIN tot USING (endpoint) GROUP BY endpoint"""


def _landed_run_pages(spark, d):
    """Two hubs swept twice a day, and route files.

    The hubs' first runs are whole.  In the second run, five hours later, hub 0 loses
    pages; of hub 1's pages some come only as a recovered batch of their second half,
    others come whole with that batch after them.  A route file holds the orders of 20
    keys, without endpoint, offset and limit; pending orders are missing from it."""
    spec = tf.ORDERS_FEED
    _, resource, plural, singular = spec.array_path.split(".")
    o = _t(spark, d, "orders").withColumn("hub", F.pmod("o_orderkey", F.lit(2))).withColumn(
        "pos", F.floor(F.col("o_orderkey") / 2)).withColumn("page", F.floor(F.col("pos") / tf.OPS_PAGE))
    totals = F.broadcast(o.groupBy("hub").agg(F.count(F.lit(1)).alias("total")))  # two rows
    first = F.min_by(F.struct("o_orderpriority", "o_orderstatus"), F.col("o_orderkey")).alias("first")
    # Second halves keep their page's first order, which decides what happens to them.
    pages = to_pages(o, ["hub", "page"], tf.order_record(o), F.col("o_orderkey"), extra=[first, F.min("pos").alias("low")])
    pages = pages.join(totals, "hub")
    urgent = F.col("first.o_orderpriority") == tf.LOST_PRIORITY
    lost = urgent & (F.col("first.o_orderstatus") == tf.LOST_STATUS)
    half = tf.OPS_PAGE // 2
    start = F.col("page") * tf.OPS_PAGE
    kept_before = F.least(F.greatest(start + half - F.col("low"), F.lit(0)), F.size("records")).cast("int")
    tail = F.slice("records", kept_before + 1, F.size("records") + 1)
    whole = F.struct(F.lit(0).alias("run"), start.alias("offset"), F.lit(tf.OPS_PAGE).alias("limit"), F.col("records"), F.lit(False).alias("part"))
    second = F.struct(F.lit(1).alias("run"), start.alias("offset"), F.lit(tf.OPS_PAGE).alias("limit"), F.col("records"), F.lit(False).alias("part"))
    batch = F.struct(F.lit(1).alias("run"), (start + half).alias("offset"), F.lit(half).alias("limit"), tail.alias("records"), F.lit(True).alias("part"))
    sent = F.array(whole, F.when(~lost, second), F.when((F.col("hub") == 1) & urgent & (F.size(tail) > 0), batch))
    docs = pages.select("hub", "page", "total", F.explode(F.array_compact(sent)).alias("s")).select("hub", "page", "total", "s.*")
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(tf.SWEEP_TS)) + F.pmod("page", F.lit(600)) + F.col("run") * 18000)
    meta = ingestion_metadata("ops", spec.name, at, tf.SCRIPT, offset=F.col("offset"),
                              batch_seed=F.concat_ws("/", "hub", "run", "part"))
    plain = ["ingested_at", "batch_id", "category", "entity", "script_name"]
    fields = [meta.getField(f).alias(f) for f in plain]
    paged = F.struct(*fields, F.col("offset").cast("bigint").alias("offset"), F.col("limit").alias("limit"),
                     F.concat(F.lit("orders/"), F.col("hub").cast("string")).alias("endpoint"),
                     F.col("part").alias("poison_pill_recovered"))
    hubs = docs.select(envelope_json(F.col("records"), resource, plural, singular, paged, F.col("total")).alias("document"))
    present = F.when(F.col("o_orderstatus") != tf.LOST_STATUS, tf.order_record(o))
    routes = to_pages(o.select("*", F.floor(F.col("o_orderkey") / 20).alias("route")), ["route"], present, F.col("o_orderkey"),
                      extra=[F.count(F.lit(1)).alias("total")])
    lone = ingestion_metadata("ops", spec.name, F.to_timestamp(F.lit(tf.SWEEP_TS)), tf.SCRIPT, batch_seed=F.col("route"))
    files = routes.select(envelope_json(F.col("records"), resource, plural, singular, lone, F.col("total")).alias("document"))
    # The audits use the pages' metadata several times; the documents are built once.
    path = scratch_path(spark, "run-pages")
    write_table(landed_pages(_parsed(hubs.unionByName(files), spec), spec), path)
    return newest_pages(with_runs(spark.read.parquet(path)), SWEEP)


def _run_clock(df):
    return df.withColumn("run_start", wall_clock("run_start"))


def q21b_run_completeness(spark, d):
    """Completeness per run and per route file, overlapping pages counted once."""
    return _run_clock(completeness(_landed_run_pages(spark, d), SWEEP, recovered="recovered"))


_RUN_PAGES_SQL = f"""WITH o AS (SELECT *, o_orderkey % 2 AS hub, o_orderkey // 2 AS pos, o_orderkey // 2 // 50 AS page FROM orders),
p AS (SELECT hub, page, count(*) AS n, count(*) FILTER (WHERE pos % 50 >= 25) AS n_half,
        arg_min(o_orderpriority, o_orderkey) = '{tf.LOST_PRIORITY}' AS urgent, arg_min(o_orderstatus, o_orderkey) = '{tf.LOST_STATUS}' AS pending
      FROM o GROUP BY 1, 2),
t AS (SELECT hub, count(*) AS total FROM o GROUP BY 1),
sent AS (SELECT hub, page, 0 AS run, page * 50 AS off, 50 AS lim, n, 0 AS part FROM p
  UNION ALL SELECT hub, page, 1, page * 50, 50, n, 0 FROM p WHERE NOT (urgent AND pending)
  UNION ALL SELECT hub, page, 1, page * 50 + 25, 25, n_half, 1 FROM p WHERE hub = 1 AND urgent AND n_half > 0),
started AS (SELECT *, min(page % 600) OVER (PARTITION BY hub, run) AS second FROM sent),
pg AS (SELECT 'ops' AS category, 'orders' AS entity, 'orders/' || hub AS endpoint, CAST(NULL AS VARCHAR) AS document,
    TIMESTAMP '{tf.SWEEP_TS}' + to_seconds(CAST(second + run * 18000 AS BIGINT)) AS run_start, CAST(off AS BIGINT) AS off,
    CAST(off + lim AS BIGINT) AS stop, lim, n, total, part FROM started JOIN t USING (hub)
  UNION ALL SELECT 'ops', 'orders', NULL, sha256('ops|orders|' || route || '|'), TIMESTAMP '{tf.SWEEP_TS}', 0, n, NULL, n, total, 0 FROM (
    SELECT o_orderkey // 20 AS route, count(*) FILTER (WHERE o_orderstatus <> '{tf.LOST_STATUS}') AS n, count(*) AS total FROM orders GROUP BY 1)),
seen AS (SELECT *, max(stop) OVER w AS before, lead(off) OVER (PARTITION BY endpoint, document, run_start ORDER BY off) AS nxt
  FROM pg WINDOW w AS (PARTITION BY endpoint, document, run_start ORDER BY off ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""

Q21B_SQL = _RUN_PAGES_SQL + """
SELECT category, entity, endpoint, document, run_start, count(*) AS n_pages, CAST(sum(n) AS BIGINT) AS n_records, max(total) AS total_count,
  CAST(ceil(max(total) / max(lim)) AS BIGINT) AS expected_pages,
  CAST(greatest(max(total) - sum(least(n, greatest(stop - greatest(off, before), 0))), 0) AS BIGINT) AS missing_records,
  sum(least(n, greatest(stop - greatest(off, before), 0))) >= max(total) AS complete, CAST(sum(part) AS BIGINT) AS n_recovered
FROM seen GROUP BY ALL"""


def q26b_run_gaps(spark, d):
    """Uncovered offsets per run and per route file."""
    return _run_clock(offset_gaps(_landed_run_pages(spark, d), SWEEP))


Q26B_SQL = _RUN_PAGES_SQL + """,
g AS (SELECT category, entity, endpoint, document, run_start, greatest(stop, before) AS gap_start, nxt AS gap_end FROM seen WHERE nxt > greatest(stop, before)
  UNION ALL SELECT category, entity, endpoint, document, run_start, 0, off FROM seen WHERE before IS NULL AND off > 0
  UNION ALL SELECT category, entity, endpoint, document, run_start, greatest(stop, before), total FROM seen
            WHERE nxt IS NULL AND greatest(stop, before) < total)
SELECT *, gap_end - gap_start AS missing_records FROM g"""


def q22_partition_split(spark, d):
    staged = tf.staged_lines(_t(spark, d, "lineitem"))
    split = partition_split(staged, tf.LINE_KEY, tf.LINE_ORDER, tf.LINE_RULES, _STAGED_TIES)
    return split.select("line_id", "l_orderkey", "l_linenumber", "l_shipdate", "label",
                        F.array_join("failed_rules", ",").alias("failed_rules"))


_DROP_RULES = [r for r in tf.LINE_RULES if r.sql and r.action == "drop" and "silver" in r.applies_to]
Q22_SQL = _STAGED_CTE + f"""SELECT line_id, l_orderkey, l_linenumber, l_shipdate,
  CASE WHEN {' OR '.join(f'({r.fails()})' for r in _DROP_RULES)} THEN 'quarantine'
       WHEN rn = 1 THEN 'silver' ELSE 'superseded' END AS label,
  concat_ws(',', {', '.join(f"CASE WHEN {r.fails()} THEN '{r.name}' END" for r in _DROP_RULES)}) AS failed_rules
FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(tf.LINE_KEY)} ORDER BY
  {_order_sql(list(tf.LINE_ORDER) + _STAGED_TIES)}) AS rn FROM staged)"""


def q23_hub_departures(spark, d):
    ev = _t(spark, d, "events")
    return departures_from_hubs(ev, tf.HUB_EVENT_TYPES, tf.HUB_SINCE, origin="event_type",
                                departure="ts").select("event_id", "ts", "user_id", "event_type")


Q23_SQL = f"""SELECT event_id, ts, user_id, event_type FROM events
WHERE event_type IN ({', '.join(repr(h) for h in tf.HUB_EVENT_TYPES)}) AND ts >= TIMESTAMP '{tf.HUB_SINCE}'"""


def q24_route_lookup(spark, d):
    on = ["cust_nation", "supp_nation", "day"]
    routes = route_frame(spark, [(a, b, day) for a, b in tf.ROUTES for day in tf.ROUTE_DAYS], on)
    flown = q19_role_playing(spark, d).withColumn("day", F.to_date("l_shipdate"))
    return routes_on(flown, routes, on).drop("day")


Q24_SQL = f"""SELECT * FROM ({Q19_SQL}) q
WHERE CAST(l_shipdate AS DATE) IN ({', '.join(f"DATE '{day}'" for day in tf.ROUTE_DAYS)}) AND EXISTS (
  SELECT 1 FROM (VALUES {', '.join(f"('{a}', '{b}')" for a, b in tf.ROUTES)}) r(a, b)
  WHERE r.a = q.cust_nation AND r.b = q.supp_nation)"""


def _lines_drop_documents(li: DataFrame, drop_no: int) -> DataFrame:
    """A drop's lines in pages of at most 50, paged by position."""
    spec = tf.LINES_FEED
    _, resource, plural, singular = spec.array_path.split(".")
    ts = F.to_timestamp(F.lit(tf.SWEEP_TS)) + F.expr(f"INTERVAL {drop_no - 1} DAYS")
    # Pages are gathered as typed lines, which take less to shuffle than their texts.
    pages = to_pages(with_position_pages(li, spec.page_size), ["page_id"], F.struct(*tf.LINE_COLUMNS), F.col("_pos"))
    pages = pages.withColumn("records", F.transform("records", tf.line_record))
    meta = ingestion_metadata("ops", spec.name, ts, tf.SCRIPT, offset=F.col("page_id"),
                              batch_seed=F.lit(f"drop{drop_no}"))
    return pages.select(envelope_json(F.col("records"), resource, plural, singular, meta)
                        .alias("document"), partition_folder("ops", ts).alias("folder"))


def q25_incremental_rerun(spark, d):
    """Two drops of lines land; bronze and the latest-per-key stream run after
    each drop, each run consuming only what is new.  The stream logs changed
    keys per trigger (update mode); the first run's log is compacted into a
    base, and the result resolves that base plus the second run's epoch."""
    root = scratch_path(spark, "q25")
    spec = tf.LINES_FEED
    li = _t(spark, d, "lineitem")
    second = F.col("l_shipdate") >= F.lit(tf.SECOND_DROP_FROM).cast("timestamp_ntz")
    ordering = ["ingested_at", "l_shipdate"] + _LINE_TIES
    land = landing_path(f"{root}/landing", spec)
    bronze = bronze_path(root, spec)
    snapshot = f"{root}/silver_lines"
    for drop_no, cond in ((1, ~second), (2, second)):
        write_landing(_lines_drop_documents(li.filter(cond), drop_no), land)
        ingest_feeds(spark, [spec], f"{root}/landing", root)
        schema = spark.read.parquet(bronze).schema
        staged = flatten(spark.readStream.schema(schema).parquet(bronze), spec)
        q = start_latest(spark, staged, list(tf.LINE_KEY), ordering, snapshot,
                         f"{root}/_checkpoints/silver_lines", mode="update")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        if drop_no == 1:
            # Compact what the first run logged; later reads take that base
            # plus newer epochs only.
            compact_latest(spark, snapshot, list(tf.LINE_KEY), f"{root}/silver_lines_base", ordering)
    out = read_latest(spark, snapshot, list(tf.LINE_KEY), base=f"{root}/silver_lines_base", ordering=ordering)
    return out.select(*[F.col(c) for c in tf.LINE_COLUMNS if c != "l_shipdate"],
                      wall_clock("l_shipdate").alias("l_shipdate"),
                      F.dayofmonth("ingested_at").alias("drop_no"))


Q25_SQL = (f"SELECT *, CASE WHEN l_shipdate < TIMESTAMP '{tf.SECOND_DROP_FROM}' THEN 1 ELSE 2 END "
           f"AS drop_no FROM ({Q11_SQL})")


def q26_offset_gaps(spark, d):
    return offset_gaps(_landed_hub_pages(spark, d), _SWEEP)


Q26_SQL = _KEPT_SQL + """,
seq AS (SELECT endpoint, page_offset, page_end,
               lead(page_offset) OVER (PARTITION BY endpoint ORDER BY page_offset) AS nxt,
               lag(page_offset) OVER (PARTITION BY endpoint ORDER BY page_offset) AS prv FROM kept)
SELECT 'ops' AS category, 'orders' AS entity, endpoint, CAST(page_end AS BIGINT) AS gap_start,
  CAST(nxt AS BIGINT) AS gap_end, CAST(nxt - page_end AS BIGINT) AS missing_records
FROM seq WHERE nxt > page_end
UNION ALL
SELECT 'ops', 'orders', endpoint, CAST(0 AS BIGINT), CAST(page_offset AS BIGINT), CAST(page_offset AS BIGINT)
FROM seq WHERE prv IS NULL AND page_offset > 0
UNION ALL
SELECT 'ops', 'orders', endpoint, CAST(page_end AS BIGINT), CAST(total AS BIGINT), CAST(total - page_end AS BIGINT)
FROM seq JOIN tot USING (endpoint) WHERE nxt IS NULL AND page_end < total"""


def q27_bad_record_isolation(spark, d):
    """Customer pages land as JSON lines; pages whose first customer is in the
    corrupt segment arrive truncated, those of another one with their numbers
    quoted.  The bronze stream keeps the good documents, quoted ones with all
    their records, and isolates the bad ones instead of failing the batch."""
    root = scratch_path(spark, "q27")
    name, spec, key = next(x for x in tf.REF_TABLE_FEEDS if x[0] == "customer")
    docs = _table_feed_documents(spark, d, name, spec, key,
                                 extra=[F.min_by("c_mktsegment", key).alias("seg")])
    quoted = F.regexp_replace("document", '"(offset|limit|TotalCount)":([0-9]+)', '"$1":"$2"')
    docs = docs.select(
        F.when(F.col("seg") == tf.CORRUPT_SEGMENT,
               F.expr("substring(document, 1, length(document) div 2)"))
        .when(F.col("seg") == tf.QUOTED_SEGMENT, quoted)
        .otherwise(F.col("document")).alias("document"), "folder")
    write_landing(docs, landing_path(f"{root}/landing", spec))
    # Bronze stores the parsed documents, corrupt ones with their raw text in
    # ``_corrupt_record`` (a raw JSON scan cannot be queried on that column alone).
    paths = ingest_feeds(spark, [spec], f"{root}/landing", root)
    bronze = read_bronze(spark, paths[spec.name], spec)
    status = F.when(F.col("_corrupt_record").isNotNull(), F.lit("corrupt")).otherwise(F.lit("ok"))
    return bronze.groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.sum(F.when(F.col("_corrupt_record").isNull(),
                     record_count(F.col(spec.array_path))).otherwise(F.lit(0)))
        .cast("bigint").alias("n_records"))


Q27_SQL = f"""WITH p AS (SELECT c_custkey // 100 AS pg, count(*) AS n,
  arg_min(c_mktsegment, c_custkey) AS seg FROM customer GROUP BY 1)
SELECT CASE WHEN seg = '{tf.CORRUPT_SEGMENT}' THEN 'corrupt' ELSE 'ok' END AS status,
  count(*) AS n_documents,
  CAST(sum(CASE WHEN seg = '{tf.CORRUPT_SEGMENT}' THEN 0 ELSE n END) AS BIGINT) AS n_records
FROM p GROUP BY 1"""


def q29_record_salvage(spark, d):
    """Customer pages land cut in half, or with a first record that lost its closing
    brace.  Staged rows hold every complete record of every page; what is no complete
    record comes as a damaged piece."""
    root = scratch_path(spark, "q29")
    name, spec, key = next(x for x in tf.REF_TABLE_FEEDS if x[0] == "customer")
    docs = _table_feed_documents(spark, d, name, spec, key, extra=[F.min_by("c_mktsegment", key).alias("seg")])
    open_record = F.concat(F.substring_index("document", '"},{', 1), F.lit('",{'),
                           F.expr("""substring(document, locate('"},{', document) + 4)"""))
    docs = docs.select(
        F.when(F.col("seg") == tf.CORRUPT_SEGMENT, F.expr("substring(document, 1, length(document) div 2)"))
        .when((F.col("seg") == tf.GARBLED_SEGMENT) & F.contains("document", F.lit('"},{')), open_record)
        .otherwise(F.col("document")).alias("document"), "folder")
    write_landing(docs, landing_path(f"{root}/landing", spec))
    paths = ingest_feeds(spark, [spec], f"{root}/landing", root)
    bronze = read_bronze(spark, paths[spec.name], spec)
    offset = F.col("ingestion_metadata.offset").try_cast("bigint").alias("page_offset")
    kept = flatten(with_salvaged(bronze, spec).select("*", offset), spec, keep=("page_offset",))
    pieces = salvaged_documents(bronze, spec).select(offset, F.explode("damaged").alias("piece"))
    none = F.lit(None).cast("string")
    return kept.select(F.lit("kept").alias("status"), "page_offset", "c_custkey", "c_name", none.alias("piece")).unionByName(
        pieces.select(F.lit("damaged").alias("status"), "page_offset", F.lit(None).cast("bigint").alias("c_custkey"),
                      none.alias("c_name"), "piece"))


def _json_member(field: str, column: str) -> str:
    return f"""'"{field}":"' || {column} || '"'"""


Q29_SQL = f"""WITH r AS (SELECT c_custkey, c_name, c_mktsegment, c_custkey // 100 * 100 AS off, '{{' || array_to_string(list_filter([
    {_json_member('CustKey', 'c_custkey')}, {_json_member('Name', 'c_name')}, {_json_member('NationKey', 'c_nationkey')},
    {_json_member('Segment', 'c_mktsegment')}], lambda m: m IS NOT NULL), ',') || '}}' AS t FROM customer),
p AS (SELECT off, count(*) AS n, arg_min(c_mktsegment, c_custkey) AS seg, string_agg(t, ',' ORDER BY c_custkey) AS body,
        min(c_custkey) AS first_key, '{{"ingestion_metadata":{{"ingested_at":"{tf.SWEEP_TS}","batch_id":"' || sha256('ref|customer||' || off)
        || '","category":"ref","entity":"customer","script_name":"{tf.SCRIPT}","offset":' || off
        || ',"limit":100,"endpoint":"customer"}},"payload":{{"CustomerResource":{{"Customers":{{"Customer":' AS pre FROM r GROUP BY off),
d AS (SELECT *, seg = '{tf.CORRUPT_SEGMENT}' AS cut, seg = '{tf.GARBLED_SEGMENT}' AND n > 1 AS garbled,
        length(pre) + CASE WHEN n > 1 THEN 1 ELSE 0 END AS head,
        pre || CASE WHEN n > 1 THEN '[' || body || ']' ELSE body END || '}},"Meta":{{"TotalCount":' || n || '}}}}}}}}' AS doc FROM p),
e AS (SELECT r.*, d.* EXCLUDE (off), length(doc) // 2 AS half,
        CAST(head + sum(length(t) + 1) OVER (PARTITION BY off ORDER BY c_custkey) - 1 AS BIGINT) AS stop FROM r JOIN d USING (off)),
tails AS (SELECT off, pre, trim(substring(doc, (CASE WHEN half < length(pre) THEN 0 ELSE greatest(head, tail) END) + 1, half - CASE
    WHEN half < length(pre) THEN 0 ELSE greatest(head, tail) END), ',') AS piece, half FROM (
    SELECT off, any_value(pre) AS pre, any_value(doc) AS doc, any_value(head) AS head, any_value(half) AS half,
           coalesce(max(stop) FILTER (WHERE stop <= half), 0) AS tail FROM e WHERE cut GROUP BY off))
SELECT 'kept' AS status, off AS page_offset, c_custkey, c_name, CAST(NULL AS VARCHAR) AS piece FROM e
WHERE CASE WHEN cut THEN stop <= half WHEN garbled THEN c_custkey <> first_key ELSE true END
UNION ALL SELECT 'damaged', off, NULL, NULL, piece FROM tails WHERE piece <> ''
UNION ALL SELECT 'damaged', off, NULL, NULL, left(t, length(t) - 1) FROM e WHERE garbled AND c_custkey = first_key"""


def q28_label_enrich(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang", "source")
    labels = _t(spark, d, "labels")
    g = star_left_join(docs, [Dim(labels, "lb", "f.doc_id = lb.doc_id",
                                  {"quality": "quality", "toxic": "toxic", "_label_doc": "doc_id"},
                                  defaults={"quality": -1, "toxic": 0})])
    return g.select("doc_id", "lang", "source", "quality", "toxic",
                    F.col("_label_doc").isNotNull().alias("labelled"))


Q28_SQL = """SELECT d.doc_id, d.lang, d.source, coalesce(l.quality, -1) AS quality,
  coalesce(l.toxic, 0) AS toxic, l.doc_id IS NOT NULL AS labelled
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def _corrected_lines(spark, d, root):
    """Lines land twice: all of them, then corrected ones of the newest orders; layers
    are brought up to date after each drop."""
    spec = tf.CHECKED_LINES_FEED
    li = _t(spark, d, "lineitem")
    top = li.agg(F.max("l_orderkey")).scalar()
    span = li.agg(F.max("l_orderkey")).first()[0] // tf.SILVER_PARTS + 1
    newest = F.col("l_orderkey") >= top - F.floor(top / tf.CORRECTED_SHARE)
    again = li.where(newest).withColumn("l_quantity", F.col("l_quantity") + tf.CORRECTION)
    layouts = {spec.name: Layout(by=f"l_orderkey div {span}")}
    runs = []
    for drop_no, lines in ((1, li), (2, again)):
        write_landing(_lines_drop_documents(lines, drop_no), landing_path(f"{root}/landing", spec))
        runs.append(refresh_changes(spark, f"{root}/landing", root, [spec], layouts)[spec.name])
    return runs


def q30_changed_parts(spark, d):
    """Silver lines after two drops, and whether the second one rewrote their part."""
    second = _corrected_lines(spark, d, scratch_path(spark, "q30"))[1]
    return second.read(spark).select(
        *[F.col(c) for c in tf.LINE_COLUMNS if c != "l_shipdate"], wall_clock("l_shipdate").alias("l_shipdate"),
        F.col(PART).isin(touched_parts(spark, second)).alias("rewritten"))


_CORRECTED_SQL = f"""WITH m AS (SELECT max(l_orderkey) AS top, max(l_orderkey) // {tf.SILVER_PARTS} + 1 AS span FROM lineitem),
drops AS (SELECT *, 1 AS drop_no FROM lineitem UNION ALL
  SELECT lineitem.* REPLACE (l_quantity + {tf.CORRECTION} AS l_quantity), 2 FROM lineitem, m WHERE l_orderkey >= top - top // {tf.CORRECTED_SHARE})"""

Q30_SQL = _CORRECTED_SQL + f""",
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(tf.LINE_KEY)} ORDER BY drop_no DESC,
  {_order_sql(list(tf.LINE_ORDER) + _LINE_TIES)}) AS rn FROM drops) WHERE rn = 1)
SELECT {', '.join(tf.LINE_COLUMNS)}, l_orderkey // span IN (SELECT l_orderkey // span FROM drops, m WHERE drop_no = 2) AS rewritten
FROM newest, m WHERE l_quantity < 50"""


def q30b_stream_metrics(spark, d):
    """Rule counts of each epoch's rows, as the stream stored them."""
    second = _corrected_lines(spark, d, scratch_path(spark, "q30b"))[1]
    return spark.read.parquet(second.metrics).select("feed", F.col(EPOCH).cast("bigint").alias("epoch"), "rule", "action", "n_pass", "n_fail")


Q30B_SQL = _CORRECTED_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT 'lines' AS feed, CAST(drop_no - 1 AS BIGINT) AS epoch, '{r.name}' AS rule, '{r.action}' AS action, "
    f"count(*) FILTER (WHERE {r.sql}) AS n_pass, count(*) FILTER (WHERE NOT coalesce({r.sql}, false)) AS n_fail FROM drops GROUP BY drop_no"
    for r in tf.CHECKED_LINES_FEED.rules)


def _named_order_documents(spark, d, corrected: bool):
    """Order pages with the names of their files; ``corrected`` ones hold another price."""
    spec = tf.ORDERS_FEED
    o = _t(spark, d, "orders").withColumn("pg", F.floor(F.col("o_orderkey") / tf.OPS_PAGE))
    if corrected:  # pages whose first order is urgent are fetched again
        again = o.groupBy("pg").agg(F.min_by("o_orderpriority", "o_orderkey").alias("first")).where(F.col("first") == tf.LOST_PRIORITY)
        o = o.join(again.select("pg"), "pg", "left_semi").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    pages = to_pages(o, ["pg"], tf.order_record(o), F.col("o_orderkey"))
    at = F.to_timestamp(F.lit(tf.SWEEP_TS)) + F.expr("INTERVAL 1 DAY") * F.pmod("pg", F.lit(7))
    offset = F.col("pg") * tf.OPS_PAGE
    meta = ingestion_metadata("ops", spec.name, at, tf.SCRIPT, offset=offset, limit=spec.page_size, endpoint="orders")
    _, resource, plural, singular = spec.array_path.split(".")
    return pages.select(envelope_json(F.col("records"), resource, plural, singular, meta).alias("document"),
                        partition_folder("ops", at).alias("folder"), document_name(F.lit("orders"), offset.cast("string")).alias("name"))


def q31_rewritten_files(spark, d):
    """Order pages land as named files; some are fetched again under their names.  The
    ledger takes those once more and no other; every order is read from its newest file."""
    root = scratch_path(spark, "q31")
    spec = tf.ORDERS_FEED
    land, bronze, ledger = landing_path(f"{root}/landing", spec), f"{root}/bronze", f"{root}/ledger"
    for corrected in (False, True, None):
        if corrected is not None:
            write_named_landing(_named_order_documents(spark, d, corrected), land, "name")
        ingest_changed(spark, spec, land, bronze, ledger)
    docs = current_documents(spark, bronze, spec).withColumn("doc_name", name_of(F.col("source_file")))
    return flatten(docs, spec, keep=("doc_name", LOAD)).select(
        "o_orderkey", "o_totalprice", "doc_name", F.col(LOAD).cast("bigint").alias("load"))


Q31_SQL = f"""WITH p AS (SELECT o_orderkey // 50 AS pg, arg_min(o_orderpriority, o_orderkey) = '{tf.LOST_PRIORITY}' AS again FROM orders GROUP BY 1)
SELECT o_orderkey, CASE WHEN again THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, 'orders_' || (pg * 50) AS doc_name,
  CAST(CASE WHEN again THEN 2 ELSE 1 END AS BIGINT) AS load FROM orders JOIN p ON pg = o_orderkey // 50"""


def q32_backfill(spark, d):
    """A day's documents out of the landing tree, by listing that day's folder only."""
    root = scratch_path(spark, "q32")
    spec = tf.ORDERS_FEED
    write_landing(order_documents(spark, d), landing_path(f"{root}/landing", spec))
    docs = read_landing(spark, spec, landing_path(f"{root}/landing", spec), tf.BACKFILL_DAY, tf.BACKFILL_DAY)
    return flatten(docs, spec).select("o_orderkey", "o_totalprice")


Q32_SQL = _ORDER_PAGES_SQL + f"""
SELECT o_orderkey, o_totalprice FROM orders JOIN p ON pg = o_orderkey // 50 WHERE fetched = TIMESTAMP '{tf.BACKFILL_DAY}'"""


QUERIES: dict[str, Query] = {
    "q01_landing_envelope": q01_landing_envelope,
    "q02_bronze_stream": q02_bronze_stream,
    "q03_ref_factory": q03_ref_factory,
    "q04_schema_evolution": q04_schema_evolution,
    "q04b_envelope_evolution": q04b_envelope_evolution,
    "q04c_appearing_columns": q04c_appearing_columns,
    "q05_normalize_single": q05_normalize_single,
    "q05b_drafted_feed": q05b_drafted_feed,
    "q06_explode_outer_empty": q06_explode_outer_empty,
    "q07_flatten_ops": q07_flatten_ops,
    "q08_flatten_ref": q08_flatten_ref,
    "q09_try_typed": q09_try_typed,
    "q10_surrogate_key": q10_surrogate_key,
    "q11_latest_by_key": q11_latest_by_key,
    "q11b_max_by": q11b_max_by,
    "q12_ops_silver": q12_ops_silver,
    "q12b_check_then_dedup": q12b_check_then_dedup,
    "q12c_bucketed_silver": q12c_bucketed_silver,
    "q13_ops_quarantine": q13_ops_quarantine,
    "q14_ref_quarantine": q14_ref_quarantine,
    "q15_ref_silver": q15_ref_silver,
    "q16_dq_metrics": q16_dq_metrics,
    "q17_warn_only": q17_warn_only,
    "q18_status_case": q18_status_case,
    "q19_role_playing": q19_role_playing,
    "q20_fact_master": q20_fact_master,
    "q20b_bucketed_fact": q20b_bucketed_fact,
    "q21_completeness": q21_completeness,
    "q21b_run_completeness": q21b_run_completeness,
    "q22_partition_split": q22_partition_split,
    "q23_hub_departures": q23_hub_departures,
    "q24_route_lookup": q24_route_lookup,
    "q25_incremental_rerun": q25_incremental_rerun,
    "q26_offset_gaps": q26_offset_gaps,
    "q26b_run_gaps": q26b_run_gaps,
    "q27_bad_record_isolation": q27_bad_record_isolation,
    "q28_label_enrich": q28_label_enrich,
    "q29_record_salvage": q29_record_salvage,
    "q30_changed_parts": q30_changed_parts,
    "q30b_stream_metrics": q30b_stream_metrics,
    "q31_rewritten_files": q31_rewritten_files,
    "q32_backfill": q32_backfill,
}

ORACLE_SQL: dict[str, str] = {
    "q01_landing_envelope": Q01_SQL,
    "q02_bronze_stream": Q01_SQL,
    "q03_ref_factory": Q03_SQL,
    "q04_schema_evolution": Q04_SQL,
    "q04b_envelope_evolution": Q04B_SQL,
    "q04c_appearing_columns": Q04C_SQL,
    "q05_normalize_single": Q05_SQL,
    "q05b_drafted_feed": Q05B_SQL,
    "q06_explode_outer_empty": Q06_SQL,
    "q07_flatten_ops": Q07_SQL,
    "q08_flatten_ref": Q08_SQL,
    "q09_try_typed": Q09_SQL,
    "q10_surrogate_key": Q10_SQL,
    "q11_latest_by_key": Q11_SQL,
    "q11b_max_by": Q11_SQL,
    "q12_ops_silver": Q12_SQL,
    "q12b_check_then_dedup": Q12B_SQL,
    "q12c_bucketed_silver": Q12_SQL,
    "q13_ops_quarantine": Q13_SQL,
    "q14_ref_quarantine": Q14_SQL,
    "q15_ref_silver": Q15_SQL,
    "q16_dq_metrics": Q16_SQL,
    "q17_warn_only": Q17_SQL,
    "q18_status_case": Q18_SQL,
    "q19_role_playing": Q19_SQL,
    "q20_fact_master": Q20_SQL,
    "q20b_bucketed_fact": Q20_SQL,
    "q21_completeness": Q21_SQL,
    "q21b_run_completeness": Q21B_SQL,
    "q22_partition_split": Q22_SQL,
    "q23_hub_departures": Q23_SQL,
    "q24_route_lookup": Q24_SQL,
    "q25_incremental_rerun": Q25_SQL,
    "q26_offset_gaps": Q26_SQL,
    "q26b_run_gaps": Q26B_SQL,
    "q27_bad_record_isolation": Q27_SQL,
    "q28_label_enrich": Q28_SQL,
    "q29_record_salvage": Q29_SQL,
    "q30_changed_parts": Q30_SQL,
    "q30b_stream_metrics": Q30B_SQL,
    "q31_rewritten_files": Q31_SQL,
    "q32_backfill": Q32_SQL,
}
