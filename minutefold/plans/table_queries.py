"""Every operator and model as a query over the shared test tables.

The tables take the roles of the domain: ``events`` are readings and, read as a log,
missions; ``customer`` are heroes. Each query carries the same result as SQL. Values
that are averaged are whole cents, whose sums are exact in any order.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LAYERS as LAYER_NAMES
from ..config import Settings, prepare, scratch_path
from ..functions import json_field, json_fields, normalise_text, to_date, to_int
from ..functions import to_utc_ntz, trunc_ntz
from ..operators import (
    dim_lookup,
    distinct_rows,
    drop_null_keys,
    events_with_series,
    explode_json_array,
    heal_by_key,
    quality,
    resample_mean,
    series_with_events,
    top_n,
)
from ..operators.quality import Check, report
from ..sources import BatchTable, BucketTable, DayTable, LoadMetrics, PartTable, RunInProgress, SourceError, VersionedTable
from ..sources import export_csv, export_json, export_parquet, read_csv, read_json, read_parquet
from ..streaming import above_mark, above_mark_per_key, apply_arrivals, replace_days, upsert
from ..streaming.increments import days_from
from . import analytics, marts, questions, schemas, staging
from .checks import CHECKS
from .run import Layers, append_fact, land_as_is, land_readings, run, run_arrivals, together

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        setattr(self, name, df)  # found there from now on
        return df


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its own name, with its SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        def call(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(prepare(spark), folder))

        QUERIES[build.__name__] = call
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return register


def cents(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("bigint")


def clock(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


CENTS = "CAST(round({} * 100) AS BIGINT)"
VALUE_CENTS = CENTS.format("value")
PRICE_CENTS = CENTS.format("o_totalprice")
K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


# --- Resampling ----------------------------------------------------------------


def user_cents(t: Tables) -> DataFrame:
    return t.events.select("user_id", "ts", "event_type", cents("value").alias("cents"))


def dense_sql(key: str, step: str, source: str, measures: list[str]) -> str:
    """SQL of a dense resample: means per bin, on a grid from first to last bin."""
    means = ", ".join(f"avg({m}) AS {m}" for m in measures)
    picked = ", ".join(f"m.{m}" for m in measures)
    return f"""
        readings AS ({source}),
        means AS (
            SELECT {key}, date_trunc('{step}', ts) AS ts, {means}
            FROM readings WHERE {key} IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2),
        spans AS (SELECT {key}, min(ts) AS lo, max(ts) AS hi FROM means GROUP BY 1),
        grid AS (
            SELECT {key}, unnest(generate_series(lo, hi, INTERVAL 1 {step})) AS ts FROM spans),
        dense AS (
            SELECT g.{key}, g.ts, {picked}
            FROM grid g LEFT JOIN means m ON g.{key} = m.{key} AND g.ts = m.ts)"""


EVENT_CENTS = f"SELECT user_id, ts, event_type, {VALUE_CENTS} AS cents FROM events"


@query(f"WITH {dense_sql('user_id', 'hour', EVENT_CENTS, ['cents'])} SELECT * FROM dense")
def resample_dense_hour(t):
    return resample_mean(user_cents(t), ["user_id"], "ts", ["cents"], "1 hour")


@query(f"WITH {dense_sql('event_type', 'minute', EVENT_CENTS, ['cents'])} SELECT * FROM dense")
def resample_dense_minute_by_type(t):
    return resample_mean(user_cents(t), ["event_type"], "ts", ["cents"], "1 minute")


@query(
    f"""WITH {dense_sql('user_id', 'minute', EVENT_CENTS, ['cents'])}
    SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_bins, count(cents) AS n_filled,
           min(ts) AS first_bin, max(ts) AS last_bin, max(cents) AS top_cents
    FROM dense GROUP BY 1, 2"""
)
def resample_dense_minute(t):
    """Every user and minute; summed up per day, since the bins are hundreds per event."""
    dense = resample_mean(user_cents(t), ["user_id"], "ts", ["cents"], "1 minute")
    return dense.groupBy("user_id", to_date(F.col("ts")).alias("day")).agg(
        F.count(F.lit(1)).alias("n_bins"),
        F.count("cents").alias("n_filled"),
        F.min("ts").alias("first_bin"),
        F.max("ts").alias("last_bin"),
        F.max("cents").alias("top_cents"),
    )


@query(
    f"""SELECT user_id, date_trunc('minute', ts) AS ts, avg({VALUE_CENTS}) AS cents
    FROM events GROUP BY 1, 2"""
)
def resample_sparse_minute(t):
    return resample_mean(user_cents(t), ["user_id"], "ts", ["cents"], "1 minute", dense=False)


GAPS = f"""SELECT CASE WHEN event_type <> 'signup' THEN user_id END AS user_id, ts,
    CASE WHEN event_type NOT IN ('error', 'view') THEN CAST({VALUE_CENTS} AS DOUBLE) END AS cents,
    {K} AS k FROM events"""


@query(f"WITH {dense_sql('user_id', 'hour', GAPS, ['cents', 'k'])} SELECT * FROM dense")
def resample_skips_null_and_nan(t):
    """Null keys dropped; nulls and NaNs outside the mean; bins of nothing else null."""
    kind = F.col("event_type")
    broken = t.events.select(
        F.when(kind != "signup", F.col("user_id")).alias("user_id"),
        "ts",
        F.when(kind == "error", None)
        .when(kind == "view", F.lit(float("nan")))
        .otherwise(cents("value").cast("double"))
        .alias("cents"),
        to_int(json_field(F.col("props"), "k")).alias("k"),
    )
    return resample_mean(broken, ["user_id"], "ts", ["cents", "k"], "1 hour")


@query(
    f"""SELECT user_id, event_type, time_bucket(INTERVAL 15 minute, ts) AS ts,
           avg({VALUE_CENTS}) AS cents FROM events GROUP BY ALL"""
)
def resample_two_keys_quarter_hour(t):
    keys = ["user_id", "event_type"]
    return resample_mean(user_cents(t), keys, "ts", ["cents"], "15 minutes", dense=False)


# --- Text, JSON, time and casts ----------------------------------------------------


@query(
    r"""SELECT c_custkey, lower(regexp_replace(c_name, '[^\p{L}\p{N}]', '', 'g')) AS name
    FROM customer WHERE c_custkey IS NOT NULL"""
)
def clean_names(t):
    name = normalise_text(F.col("c_name")).alias("name")
    return drop_null_keys(t.customer, ["c_custkey"]).select("c_custkey", name)


@query(
    r"""SELECT doc_id, lower(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) AS clean
    FROM documents"""
)
def clean_long_texts(t):
    return t.documents.select("doc_id", normalise_text(F.col("text")).alias("clean"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_field_text(t):
    return t.events.select("event_id", json_field(F.col("props"), "k").alias("k"))


@query(
    f"""SELECT event_id, {K} AS k, CAST(NULL AS VARCHAR) AS absent FROM events"""
)
def json_field_int(t):
    """Several fields from one parse; an absent one is null."""
    found = t.events.select("event_id", json_fields(F.col("props"), ["k", "absent"]).alias("f"))
    return found.select("event_id", to_int(F.col("f.k")).alias("k"), "f.absent")


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def json_array_flatten(t):
    words = F.to_json(F.split("p_name", " ")).alias("words")
    return explode_json_array(t.part.select("p_partkey", words), "words", "word")


@query(
    """SELECT p_partkey, unnest([w FOR w IN string_split(p_name, ' ') IF w < 'm']) AS word
    FROM part WHERE p_type <> 'ECONOMY'"""
)
def flatten_drops_empty(t):
    """Arrays left empty, and arrays that are null, give no row."""
    early = F.filter(F.split("p_name", " "), lambda w: w < "m")
    words = F.when(F.col("p_type") != "ECONOMY", F.to_json(early)).alias("words")
    return explode_json_array(t.part.select("p_partkey", words), "words", "word")


@query(
    """SELECT event_id, date_trunc('minute', ts) AS minute, date_trunc('hour', ts) AS hour
    FROM events"""
)
def trunc_minute(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id", trunc_ntz(ts, "minute").alias("minute"), trunc_ntz(ts, "hour").alias("hour")
    )


@query(
    """SELECT event_id, CAST(ts AS DATE) AS day, CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS parsed
    FROM events"""
)
def date_of(t):
    text = F.date_format("ts", "yyyy-MM-dd")
    day = to_date(F.col("ts")).alias("day")
    return t.events.select("event_id", day, to_date(text).alias("parsed"))


ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def offset_text(ts: str) -> Column:
    """The wall clock ``ts`` as ISO text; clicks are written five hours to the west."""
    west = F.date_format(F.col(ts) - F.expr("INTERVAL 5 HOURS"), ISO)
    return F.when(F.col("event_type") == "click", F.concat(west, F.lit("-05:00"))).otherwise(
        F.concat(F.date_format(ts, ISO), F.lit("+00:00"))
    )


@query("SELECT event_id, ts AS utc FROM events")
def offset_to_utc(t):
    return t.events.select("event_id", to_utc_ntz(offset_text("ts")).alias("utc"))


@query(
    f"""SELECT o_orderkey, {PRICE_CENTS} // 100 AS whole, TRY_CAST(o_orderpriority AS INTEGER) AS lenient
    FROM orders"""
)
def cast_text_to_int(t):
    whole = F.floor(cents("o_totalprice") / 100).cast("bigint").cast("string")
    return t.orders.select(
        "o_orderkey",
        to_int(whole).cast("bigint").alias("whole"),
        to_int(F.col("o_orderpriority"), strict=False).alias("lenient"),
    )


# --- Filters, projections, dedupe --------------------------------------------------


BROKEN_EVENTS = """SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
    CASE WHEN value >= 1 THEN ts END AS ts FROM events"""


def broken_events(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
        F.when(F.col("value") >= 1, F.col("ts")).alias("ts"),
    )


@query(f"SELECT * FROM ({BROKEN_EVENTS}) WHERE user_id IS NOT NULL AND ts IS NOT NULL")
def not_null_keys(t):
    return drop_null_keys(broken_events(t), ["user_id", "ts"])


@query(
    """SELECT o_orderkey AS mission_id, o_custkey AS hero, o_totalprice AS damage FROM orders
    WHERE o_totalprice > 250000 AND o_custkey IS NOT NULL AND o_orderstatus = 'F'"""
)
def threshold_and_equality(t):
    kept = t.orders.where(
        (F.col("o_totalprice") > 250000)
        & F.col("o_custkey").isNotNull()
        & (F.col("o_orderstatus") == "F")
    )
    return kept.select(
        F.col("o_orderkey").alias("mission_id"),
        F.col("o_custkey").alias("hero"),
        F.col("o_totalprice").alias("damage"),
    )


@query(
    """SELECT o_custkey, max(nullif(o_orderpriority, '5-LOW')) AS priority,
           max(nullif(o_orderstatus, 'P')) AS status, max(o_totalprice) AS price
    FROM orders GROUP BY 1"""
)
def heal_keys(t):
    dirty = t.orders.select(
        "o_custkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.col("o_totalprice").alias("price"),
    )
    return heal_by_key(dirty, ["o_custkey"], ["priority", "status", "price"])


@query(
    """WITH mixed AS (SELECT p_brand, p_size, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS name FROM part)
    SELECT p_brand, max({'folded': lower(name), 'capital': name = upper(name), 'name': name}).name AS name,
           max(p_size) AS p_size FROM mixed GROUP BY p_brand"""
)
def heal_keys_in_locale_order(t):
    """Names of small letters and capitals: in a locale the case decides between equal words only."""
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return heal_by_key(t.part.withColumn("name", name), ["p_brand"], ["name", "p_size"], collation="UNICODE")


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_lines(t):
    return distinct_rows(t.lineitem.select("l_orderkey", "l_linenumber"))


@query("SELECT DISTINCT text, lang FROM documents")
def distinct_texts(t):
    return distinct_rows(t.documents.select("text", "lang"))


# --- Joins -----------------------------------------------------------------------


PURCHASES = "SELECT event_id, user_id, ts AS at, event_type AS outcome FROM events WHERE event_type = 'purchase'"  # noqa: E501


def purchases(t: Tables) -> DataFrame:
    return t.events.where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", F.col("ts").alias("at"), F.col("event_type").alias("outcome")
    )


def people(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")


WIDE_BY_HOUR = f"""WITH {dense_sql('user_id', 'hour', EVENT_CENTS, ['cents'])},
    purchases AS ({PURCHASES}),
    wide AS (
        SELECT b.ts, m.event_id, m.outcome, b.cents, c.c_custkey AS user_id, c.c_name, c.c_mktsegment
        FROM dense b
        LEFT JOIN purchases m ON b.user_id = m.user_id AND b.ts = date_trunc('hour', m.at)
        LEFT JOIN customer c ON b.user_id = c.c_custkey)"""


def wide_by_hour(t: Tables) -> DataFrame:
    bins = resample_mean(user_cents(t), ["user_id"], "ts", ["cents"], "1 hour")
    joined = series_with_events(bins, purchases(t), ["user_id"], "ts", "at", "1 hour")
    return dim_lookup(joined, people(t), "user_id", ["c_name", "c_mktsegment"])


@query(f"{WIDE_BY_HOUR} SELECT * FROM wide")
def obt_series_left(t):
    return wide_by_hour(t)


def crowded_purchases(t: Tables) -> DataFrame:
    """A third of all events in the first bin of one user's series."""
    first = user_cents(t).where("user_id = 1").agg(F.min("ts")).scalar()
    crowd = t.events.where("event_id % 3 = 0").select(
        "event_id", F.lit(1).cast("bigint").alias("user_id"), first.alias("at"), F.lit("crowd").alias("outcome")
    )
    return purchases(t).unionByName(crowd)


@query(
    WIDE_BY_HOUR.replace(
        f"purchases AS ({PURCHASES})",
        f"""purchases AS ({PURCHASES} UNION ALL
            SELECT event_id, 1, (SELECT min(ts) FROM ({EVENT_CENTS}) WHERE user_id = 1), 'crowd'
            FROM events WHERE event_id % 3 = 0)""",
    )
    + " SELECT * FROM wide"
)
def obt_series_left_spread(t):
    """The same with events that crowd into one bin."""
    bins = resample_mean(user_cents(t), ["user_id"], "ts", ["cents"], "1 hour")
    joined = series_with_events(bins, crowded_purchases(t), ["user_id"], "ts", "at", "1 hour")
    return dim_lookup(joined, people(t), "user_id", ["c_name", "c_mktsegment"])


WIDE_BY_EVENT = f"""WITH {dense_sql('user_id', 'hour', EVENT_CENTS, ['cents'])},
    purchases AS ({PURCHASES}),
    wide AS (
        SELECT m.event_id, m.at, m.outcome, b.cents, c.c_custkey AS user_id, c.c_name, c.c_mktsegment
        FROM purchases m
        LEFT JOIN dense b ON b.user_id = m.user_id AND b.ts = date_trunc('hour', m.at)
        LEFT JOIN customer c ON m.user_id = c.c_custkey)"""


@query(f"{WIDE_BY_EVENT} SELECT * FROM wide")
def obt_events_left(t):
    bins = resample_mean(user_cents(t), ["user_id"], "ts", ["cents"], "1 hour", dense=False)
    joined = events_with_series(purchases(t), bins, ["user_id"], "at", "ts", "1 hour")
    return dim_lookup(joined, people(t), "user_id", ["c_name", "c_mktsegment"])


RICH = "SELECT * FROM customer WHERE c_acctbal > 0"


@query(
    f"""SELECT o.o_orderkey, o.o_totalprice, c.c_custkey, c.c_name
    FROM orders o LEFT JOIN ({RICH}) c ON o.o_custkey = c.c_custkey"""
)
def dimension_lookup(t):
    """The dimension's own key in the result: null where it has no such row."""
    orders = t.orders.select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("c_custkey"))
    return dim_lookup(orders, t.customer.where("c_acctbal > 0"), "c_custkey", ["c_name"])


# --- Increments ----------------------------------------------------------------------


def sales(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")


SALES = "SELECT o_orderkey, o_orderdate, o_orderstatus, o_totalprice FROM orders"
OLD_SALES = f"SELECT * FROM ({SALES}) WHERE o_orderdate < TIMESTAMP '1998-01-01'"
NEW_SALES = f"""SELECT o_orderkey, o_orderdate, 'X' AS o_orderstatus, o_totalprice
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01'"""


def old_and_new_sales(t: Tables) -> tuple[DataFrame, DataFrame]:
    old = sales(t).where(F.col("o_orderdate") < clock("1998-01-01"))
    new = sales(t).where(F.col("o_orderdate") >= clock("1997-06-01"))
    return old, new.withColumn("o_orderstatus", F.lit("X"))


UPSERTED_SALES = f"""
    SELECT * FROM ({OLD_SALES}) o
    WHERE NOT EXISTS (SELECT 1 FROM ({NEW_SALES}) n WHERE n.o_orderkey = o.o_orderkey)
    UNION ALL SELECT * FROM ({NEW_SALES})"""


@query(UPSERTED_SALES)
def upsert_single_key(t):
    old, new = old_and_new_sales(t)
    return upsert(old, new, ["o_orderkey"])


@query(UPSERTED_SALES)
def upsert_persisted(t):
    """Two versions of a table on disk: built by the first batch, upserted by the second."""
    old, new = old_and_new_sales(t)
    table = VersionedTable(t.spark, scratch_path(t.spark, "upsert"))
    for batch in (old, new):
        table.write(upsert(table.read(), batch, ["o_orderkey"]))
    return table.read()


@query(UPSERTED_SALES)
def upsert_buckets(t):
    """The same on a table dealt by key, of which an upsert rewrites the touched buckets."""
    old, new = old_and_new_sales(t)
    table = BucketTable(t.spark, scratch_path(t.spark, "buckets"), ["o_orderkey"], 8, ["o_orderdate"])
    for batch in (old, new):
        table.upsert(batch)
    table.drop_old()
    return table.read()


@query(
    """SELECT l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 100 = 0 THEN l_quantity + 100 ELSE l_quantity END AS l_quantity, l_shipdate
    FROM lineitem"""
)
def upsert_small_batch(t):
    """One order in a hundred comes again."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    table = BucketTable(t.spark, scratch_path(t.spark, "buckets"), ["l_orderkey", "l_linenumber"], 64, ["l_shipdate"])
    table.upsert(lines)
    again = lines.where(F.col("l_orderkey") % 100 == 0)
    table.upsert(again.withColumn("l_quantity", F.col("l_quantity") + 100))
    return table.read()


@query(
    """WITH again AS (SELECT l_orderkey, l_linenumber, l_quantity + 100 AS l_quantity, l_shipdate FROM lineitem
        WHERE l_orderkey % 10 = 0 AND date_trunc('month', l_shipdate) = DATE '1995-03-01')
    SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem l WHERE NOT EXISTS (
        SELECT 1 FROM again a WHERE a.l_orderkey = l.l_orderkey AND a.l_linenumber = l.l_linenumber)
    UNION ALL SELECT * FROM again"""
)
def upsert_one_part(t):
    """Lines in parts by month; one in ten of a month comes again, and that month is rewritten."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    month = F.to_date(F.date_trunc("month", "l_shipdate"))
    table = PartTable(t.spark, scratch_path(t.spark, "months"), month, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    table.upsert(lines)
    again = lines.where((F.col("l_orderkey") % 10 == 0) & (month == F.lit("1995-03-01").cast("date")))
    table.upsert(again.withColumn("l_quantity", F.col("l_quantity") + 100))
    return table.read()


@query(
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0
        THEN CAST(o_orderdate AS DATE) + 400 ELSE CAST(o_orderdate AS DATE) END AS day FROM orders"""
)
def upsert_moving_parts(t):
    """Orders in parts by year; one in seven comes again with a date over a year later."""
    orders = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    table = PartTable(t.spark, scratch_path(t.spark, "years"), F.year("day"), ["o_orderkey"], ["day"])
    table.upsert(orders)
    table.upsert(orders.where(F.col("o_orderkey") % 7 == 0).withColumn("day", F.date_add("day", 400)))
    return table.read()


LINES = "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem"


@query(
    f"""WITH old AS (SELECT * FROM ({LINES}) WHERE l_shipdate < TIMESTAMP '1998-01-01'),
    new AS (SELECT l_orderkey, l_linenumber, l_quantity + 100 AS l_quantity, l_shipdate
            FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-06-01')
    SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n
        WHERE n.l_orderkey = o.l_orderkey AND n.l_linenumber = o.l_linenumber)
    UNION ALL SELECT * FROM new"""
)
def upsert_composite_key(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    old = lines.where(F.col("l_shipdate") < clock("1998-01-01"))
    new = lines.where(F.col("l_shipdate") >= clock("1997-06-01")).withColumn(
        "l_quantity", F.col("l_quantity") + 100
    )
    return upsert(old, new, ["l_orderkey", "l_linenumber"])


EARLY = "SELECT event_id, user_id, ts, value FROM events WHERE ts < TIMESTAMP '2024-01-16 12:00:00'"
BATCH = "SELECT event_id, user_id, ts, value + 1 AS value FROM events"


def early_and_batch(t: Tables) -> tuple[DataFrame, DataFrame]:
    events = t.events.select("event_id", "user_id", "ts", "value")
    early = events.where(F.col("ts") < clock("2024-01-16 12:00:00"))
    return early, events.withColumn("value", F.col("value") + 1)


@query(
    f"""{EARLY} UNION ALL
    SELECT * FROM ({BATCH}) WHERE ts > (SELECT max(ts) FROM ({EARLY}))"""
)
def hwm_append(t):
    target, batch = early_and_batch(t)
    return target.unionByName(above_mark(batch, "ts", target.agg(F.max("ts")).scalar()))


@query(
    f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE late) AS n_late
    FROM (SELECT ts <= (SELECT max(ts) FROM ({EARLY})) AS late FROM ({BATCH}))"""
)
def hwm_late_rows(t):
    """How many rows of a batch the mark keeps out."""
    target, batch = early_and_batch(t)
    kept = above_mark(batch, "ts", target.agg(F.max("ts")).scalar())
    counts = batch.agg(F.count(F.lit(1)).alias("n_rows"))
    n_kept = kept.agg(F.count(F.lit(1))).scalar()
    return counts.select("n_rows", (F.col("n_rows") - n_kept).alias("n_late"))


BATCH_OF_ALL = f"""SELECT b.* FROM ({BATCH}) b LEFT JOIN
    (SELECT user_id, max(ts) AS mark FROM ({EARLY}) GROUP BY 1) m ON b.user_id = m.user_id
    WHERE m.mark IS NULL OR b.ts > m.mark"""


@query(f"{EARLY} UNION ALL {BATCH_OF_ALL}")
def hwm_append_per_key(t):
    target, batch = early_and_batch(t)
    return target.unionByName(above_mark_per_key(batch, target, ["user_id"], "ts"))


DAYS = "SELECT event_id, user_id, ts, value, CAST(ts AS DATE) AS day FROM ({})"
FRESH_DAYS = f"""SELECT * FROM ({DAYS.format('{batch}')})
    WHERE day >= (SELECT max(CAST(ts AS DATE)) FROM ({EARLY}))"""
REPLACED = f"""
    SELECT * FROM ({DAYS.format(EARLY)}) WHERE day NOT IN (SELECT day FROM ({FRESH_DAYS}))
    UNION ALL {FRESH_DAYS}"""
REPLACED_DAYS = REPLACED.format(batch=BATCH)
LATER_BATCH = f"SELECT * FROM ({BATCH}) WHERE ts >= TIMESTAMP '2024-01-18'"


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("day", to_date(F.col("ts")))


@query(REPLACED_DAYS)
def day_replace(t):
    target, batch = early_and_batch(t)
    return replace_days(with_day(target), with_day(batch), "day")


@query(REPLACED.format(batch=LATER_BATCH))
def day_replace_absent_day(t):
    """A batch that lacks the target's last day, which stays; the same on a table by day."""
    target, batch = (with_day(df) for df in early_and_batch(t))
    later = batch.where(F.col("ts") >= clock("2024-01-18"))
    table = DayTable(t.spark, scratch_path(t.spark, "days"), target.schema, "day")
    table.replace(target)
    table.replace(days_from(later, "day", table.last_day()))
    on_disk, framed = table.read(), replace_days(target, later, "day")
    if not (on_disk.exceptAll(framed).isEmpty() and framed.exceptAll(on_disk).isEmpty()):
        raise AssertionError("the table by day and the frame differ")
    return framed


@query(REPLACED_DAYS)
def day_replace_persisted(t):
    """The same on a table partitioned by day, whose earlier days are not touched."""
    early, batch = (with_day(df) for df in early_and_batch(t))
    table = DayTable(t.spark, scratch_path(t.spark, "days"), early.schema, "day")
    table.replace(early)
    table.replace(batch.where(F.col("day") >= F.lit(table.last_day()).cast("date")))
    return table.read()


# --- Ranking ---------------------------------------------------------------------------


def risky_means(t: Tables) -> DataFrame:
    """Mean high price per segment; one segment has no known price."""
    segment = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    known = F.when(F.col("c_mktsegment") != "BUILDING", cents("o_totalprice"))
    joined = t.orders.where(F.col("o_totalprice") > 300000).join(segment, "o_custkey")
    return joined.groupBy("c_mktsegment").agg(F.avg(known).alias("avg_cents"))


RISKY_MEANS = f"""SELECT c_mktsegment,
    avg(CASE WHEN c_mktsegment <> 'BUILDING' THEN {PRICE_CENTS} END) AS avg_cents
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 300000 GROUP BY 1"""


@query(f"{RISKY_MEANS} ORDER BY avg_cents DESC NULLS LAST, c_mktsegment LIMIT 1")
def top1_avg_high_risk(t):
    return top_n(risky_means(t), "avg_cents", ["c_mktsegment"])


@query(f"{RISKY_MEANS} ORDER BY avg_cents DESC NULLS FIRST, c_mktsegment LIMIT 1")
def top1_avg_high_risk_nulls_first(t):
    return top_n(risky_means(t), "avg_cents", ["c_mktsegment"], nulls="first")


@query(
    f"""SELECT o_custkey, count(DISTINCT o_orderdate) AS n_days, avg({PRICE_CENTS}) AS avg_cents
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
    ORDER BY n_days DESC NULLS LAST, o_custkey LIMIT 1"""
)
def top1_distinct_and_avg(t):
    finished = t.orders.where(F.col("o_orderstatus") == "F")
    counts = finished.groupBy("o_custkey").agg(
        F.count_distinct("o_orderdate").alias("n_days"), F.avg(cents("o_totalprice")).alias("avg_cents")
    )
    return top_n(counts, "n_days", ["o_custkey"])


@query(
    """SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10"""
)
def top_ten_preview(t):
    return top_n(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], 10)


# --- Data quality ------------------------------------------------------------------------


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1"""
)
def dq_compound_unique(t):
    return quality.unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT c_nationkey, count(*) AS n_rows FROM customer GROUP BY 1 HAVING count(*) > 1")
def dq_unique(t):
    return quality.unique(t.customer, ["c_nationkey"])


@query(f"SELECT * FROM ({BROKEN_EVENTS}) WHERE user_id IS NULL")
def dq_not_null(t):
    return quality.not_null(broken_events(t), "user_id")


@query("SELECT * FROM customer WHERE NOT (c_acctbal BETWEEN 0 AND 5000)")
def dq_between(t):
    return quality.between(t.customer, "c_acctbal", 0, 5000)


@query("SELECT * FROM customer WHERE c_acctbal < 0")
def dq_min_only(t):
    return quality.between(t.customer, "c_acctbal", lo=0)


@query("SELECT * FROM orders WHERE o_orderstatus NOT IN ('O', 'F')")
def dq_in_set(t):
    return quality.in_set(t.orders, "o_orderstatus", ["O", "F"])


@query(
    f"""SELECT * FROM orders WHERE o_custkey IS NOT NULL
    AND o_custkey NOT IN (SELECT c_custkey FROM ({RICH}))"""
)
def dq_relationships(t):
    return quality.in_parent(
        t.orders, "o_custkey", t.customer.where("c_acctbal > 0"), "c_custkey"
    )


TABLE_CHECKS = [
    Check("lineitem", "unique", ("l_orderkey", "l_linenumber")),
    Check("lineitem", "not_null", ("l_orderkey",)),
    Check("lineitem", "between", ("l_discount",), {"lo": 0.02, "hi": 0.08}),
    Check("customer", "unique", ("c_custkey",)),
    Check("customer", "between", ("c_acctbal",), {"lo": 0}),
    Check("orders", "in_set", ("o_orderstatus",), {"values": ["O", "F"]}),
    Check("orders", "in_parent", ("o_custkey",), {"parent": "rich", "parent_col": "c_custkey"}),
]


def report_sql(counts: list[tuple[str, str, str, str]]) -> str:
    """SQL of a report from (model, test, column, SQL of the failure count)."""
    parts = [
        f"SELECT '{model}' AS model, '{test}' AS test, '{column}' AS \"column\","
        f" CAST(({count}) AS BIGINT) AS failures"
        for model, test, column, count in counts
    ]
    union = " UNION ALL ".join(parts)
    return f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'warn' END AS status FROM ({union})"


def duplicates_sql(table: str, columns: str, where: str = "true") -> str:
    return (
        f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {where}"
        f" GROUP BY {columns} HAVING count(*) > 1)"
    )


def rows_sql(table: str, where: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {where}"


@query(
    report_sql([
        ("lineitem", "unique", "l_orderkey,l_linenumber",
         duplicates_sql("lineitem", "l_orderkey, l_linenumber")),
        ("lineitem", "not_null", "l_orderkey", rows_sql("lineitem", "l_orderkey IS NULL")),
        ("lineitem", "between", "l_discount",
         rows_sql("lineitem", "l_discount < 0.02 OR l_discount > 0.08")),
        ("customer", "unique", "c_custkey", duplicates_sql("customer", "c_custkey")),
        ("customer", "between", "c_acctbal", rows_sql("customer", "c_acctbal < 0")),
        ("orders", "in_set", "o_orderstatus", rows_sql("orders", "o_orderstatus NOT IN ('O', 'F')")),
        ("orders", "in_parent", "o_custkey",
         rows_sql("orders", f"o_custkey NOT IN (SELECT c_custkey FROM ({RICH}))")),
    ])
)
def dq_report(t):
    models = {
        "lineitem": t.lineitem,
        "customer": t.customer,
        "orders": t.orders,
        "rich": t.customer.where("c_acctbal > 0"),
    }
    return report(models, TABLE_CHECKS)


# --- Sources and sinks --------------------------------------------------------------------


@query("SELECT * FROM customer")
def csv_round_trip(t):
    path = scratch_path(t.spark, "csv")
    export_csv(t.customer, path)
    return read_csv(t.spark, path, t.customer.schema, multi_line=False)


@query(
    """SELECT c_custkey, '  ' || c_name || ' "a", ' AS padded,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer"""
)
def csv_padded_round_trip(t):
    """Spaces around values, quotes and commas in them, and nulls."""
    third = F.col("c_custkey") % 3 == 0
    rows = t.customer.select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(' "a", ')).alias("padded"),
        F.when(~third, F.col("c_mktsegment")).alias("segment"),
    )
    path = scratch_path(t.spark, "csv")
    export_csv(rows, path)
    return read_csv(t.spark, path, rows.schema, multi_line=False)


@query(
    """SELECT CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 1 END AS known,
    '{"c_custkey":' || c_custkey || ',"segment":' ||
    CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}' AS line
    FROM customer"""
)
def json_lines_as_written(t):
    """The text of a JSON export: a null field is there, as null."""
    third = F.col("c_custkey") % 3 == 0
    rows = t.customer.select("c_custkey", F.when(~third, F.col("c_mktsegment")).alias("segment"))
    path = scratch_path(t.spark, "json")
    export_json(rows, path)
    lines = t.spark.read.text(path)
    known = F.when(~F.contains("value", F.lit("null")), 1)
    return lines.select(known.alias("known"), F.col("value").alias("line"))


@query("SELECT event_id, user_id, event_type FROM events")
def json_document_round_trip(t):
    """Documents that are each one top-level array, spread over many lines."""
    path = scratch_path(t.spark, "documents")
    record = F.to_json(F.struct("event_id", "user_id", "event_type"))
    documents = t.events.groupBy((F.col("user_id") % 50).alias("part")).agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list(record), ",\n"), F.lit("\n]")).alias("value")
    )
    documents.select("value", "part").write.partitionBy("part").text(path)
    schema = t.events.select("event_id", "user_id", "event_type").schema
    return read_json(t.spark, path, schema).select(*schema.names)


@query(
    "SELECT event_id, CAST(json_object('kind', event_type, 'note', '}],\"' || event_type || chr(10) || '[{') AS VARCHAR) AS note FROM events"
)
def json_document_split(t):
    """A few large arrays, cut into records in byte ranges; strings hold what could end a record."""
    event, part = F.col("event_id"), F.pmod("user_id", F.lit(4)).alias("part")
    note = F.concat(F.lit('}],"'), F.col("event_type"), F.lit("\n[{"))
    inner = F.struct(F.col("event_type").alias("kind"), note.alias("note"))
    rows = t.events.select(part, event, F.to_json(F.struct(event, inner.alias("note"))).alias("record"))
    # Four rows. With the closing lines added by a union of joins, a document came out as two
    # files under 211 partitions that were not coalesced.
    ends = rows.groupBy("part").agg(F.min("event_id").alias("first"), F.max("event_id").alias("last")).collect()
    opens, closes = ([r[c] for r in ends] for c in ("first", "last"))
    line = F.concat(
        F.when(event.isin(opens), "[").otherwise(","), "record", F.when(event.isin(closes), "]").otherwise("")
    )
    path = scratch_path(t.spark, "large-documents")
    lines = rows.withColumn("value", line).repartition("part").sortWithinPartitions("part", "event_id")
    lines.select("value", "part").write.partitionBy("part").text(path)
    return read_json(t.spark, path, t.events.select("event_id", F.lit("").alias("note")).schema, split=True).select("event_id", "note")


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name END AS c_name,
    CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS c_nationkey FROM customer"""
)
def csv_null_tokens(t):
    """The ways of writing no value, all read as null."""
    part = F.col("c_custkey") % 4
    blank = F.when(part == 1, "NaN").when(part == 2, "NULL").otherwise("")
    rows = t.customer.select(
        "c_custkey",
        F.when(part == 0, F.col("c_name")).otherwise(blank).alias("c_name"),
        F.when(part % 2 == 0, F.col("c_nationkey").cast("string")).otherwise("NA").alias("c_nationkey"),
    )
    path = scratch_path(t.spark, "tokens")
    export_csv(rows, path)
    return read_csv(t.spark, path, t.customer.select("c_custkey", "c_name", "c_nationkey").schema, multi_line=False)


@query("SELECT event_id, ts, ts AS parsed FROM events")
def parquet_nanoseconds_and_text(t):
    """Timestamps held as nanoseconds, and as text, become timestamps."""
    ts = F.col("ts").cast("timestamp")
    rows = t.events.select(
        "event_id",
        (F.unix_micros(ts) * 1000 + 999).alias("ts"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("parsed"),
    )
    path = scratch_path(t.spark, "nanos")
    export_parquet(rows, path)
    found = read_parquet(t.spark, path, ["ts", "parsed"])
    return found.select("event_id", *[to_utc_ntz(F.col(c), instant=True).alias(c) for c in ("ts", "parsed")])


@query("SELECT * FROM lineitem")
def parquet_round_trip(t):
    path = scratch_path(t.spark, "parquet")
    export_parquet(t.lineitem, path)
    return read_parquet(t.spark, path, ["l_shipdate"])


@query("SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F'")
def batches_append(t):
    """Three batches, one of them tried twice, read as one table."""
    table = BatchTable(t.spark, scratch_path(t.spark, "batches"), t.orders.schema)
    finished = F.col("o_orderstatus") == "F"
    table.append(t.orders.where(finished), "one")
    table.append(t.orders.where(~finished), "two")
    table.append(t.orders.where(~finished), "two")
    table.append(t.orders.where(finished), "three")
    return table.read()


@query("SELECT count(*) * 0 AS n_rows FROM orders")
def truncate_after_load(t):
    table = BatchTable(t.spark, scratch_path(t.spark, "truncate"), t.orders.schema)
    table.append(t.orders, "one")
    table.truncate()
    return table.read().agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT * FROM supplier WHERE s_acctbal > 0")
def full_refresh(t):
    """A table written twice holds the second result only."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "refresh"))
    table.write(t.supplier)
    table.write(table.read().where("s_acctbal > 0"))
    return table.read()


@query(
    f"""SELECT 'in.rows' AS metric, count(*) AS value FROM events
    UNION ALL SELECT 'in.null_user_id', count(*) FROM ({BROKEN_EVENTS}) WHERE user_id IS NULL
    UNION ALL SELECT 'out.rows', count(*) FROM ({BROKEN_EVENTS}) WHERE user_id IS NOT NULL"""
)
def load_metrics(t):
    """Counts gathered by the write itself."""
    metrics = LoadMetrics("events")
    seen = metrics.watch(broken_events(t), "in", ["user_id"])
    kept = metrics.watch(drop_null_keys(seen, ["user_id"]), "out")
    export_parquet(kept, scratch_path(t.spark, "metrics"))
    counts = [(k, v) for k, v in metrics.summary().items() if "." in k]
    return t.spark.createDataFrame(counts, "metric string, value bigint")


@query("SELECT event_id, user_id, ts, value FROM events")
def arrivals_append(t):
    """Files arriving in a folder, each batch appended once."""
    events = t.events.select("event_id", "user_id", "ts", "value")
    table = BatchTable(t.spark, scratch_path(t.spark, "arrived"), events.schema)
    stream = (
        t.spark.readStream.schema(t.events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(t.folder)
    )
    checkpoint = scratch_path(t.spark, "arrivals")
    for _ in range(2):  # nothing new arrives before the second call
        apply_arrivals(stream, table.append, checkpoint)
    return table.read()


# --- Models: the layers over the tables in their roles ---------------------------------------


HOUR = "1 hour"


def raw_heroes(t: Tables) -> DataFrame:
    """Customers, then once more without names, those of one segment without ids."""
    first = F.date_add(F.lit("1940-01-01").cast("date"), F.col("c_nationkey")).cast("string")
    hero_id = F.concat(F.lit("H-"), F.col("c_custkey").cast("string"))
    known = t.customer.select(
        hero_id.alias("hero_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("alter_ego"),
        first.alias("first_appearance"),
    )
    again = known.withColumn("name", F.lit(None).cast("string")).withColumn(
        "hero_id", F.when(F.col("alter_ego") != "BUILDING", F.col("hero_id"))
    )
    return known.unionByName(again)


def raw_missions(t: Tables) -> DataFrame:
    """Events as a log of missions, logged twice under two offsets of the same instant."""
    kind, k = F.col("event_type"), json_field(F.col("props"), "k")
    user = F.concat(F.lit("H-"), F.col("user_id").cast("string"))
    pair = F.array(user, F.concat(F.lit("H-"), k))
    heroes = (
        F.when(kind == "signup", F.array().cast("array<string>"))
        .when(kind == "view", F.array(user))
        .otherwise(pair)
    )
    damage = F.struct(
        (cents("value") * 10).alias("structural_damage"), k.cast("int").alias("civilian_injuries")
    )
    log = t.events.select(
        F.when(kind != "error", F.concat(F.lit("M-"), F.col("event_id").cast("string"))).alias(
            "mission_id"
        ),
        F.to_json(heroes).alias("hero_ids"),
        F.when(kind != "view", F.concat(F.lit("Place "), kind)).alias("location"),
        offset_text("ts").alias("timestamp"),
        F.when(kind == "purchase", "Successful").otherwise(kind).alias("outcome"),
        F.when(kind != "view", F.to_json(damage)).alias("damage_report"),
        F.concat(F.date_format("ts", ISO), F.lit("Z")).alias("again"),
    )
    return log.drop("again").unionByName(log.withColumn("timestamp", F.col("again")).drop("again"))


def readings(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    k = json_field(F.col("props"), "k").cast("int")
    user = F.concat(F.lit("H-"), F.col("user_id").cast("string"))
    return t.events.select(
        F.col("ts").alias("timestamp"),
        F.when(k > 0, user).alias("hero_id"),
        F.when(kind != "error", k.cast("double")).alias("heart_rate"),
        (k * 3).cast("double").alias("stress_level"),
        cents("value").alias("energy_output"),
    )


HERO_CTE = r"""
    stg_heroes AS (
        SELECT 'H-' || c_custkey AS hero_id,
               lower(regexp_replace(c_name, '[^\p{L}\p{N}]', '', 'g')) AS name,
               c_mktsegment AS alter_ego,
               CAST(DATE '1940-01-01' + c_nationkey AS VARCHAR) AS first_appearance
        FROM customer),
    dim_heroes AS (
        SELECT hero_id, name, alter_ego, CAST(first_appearance AS DATE) AS first_appearance
        FROM stg_heroes)"""
MISSION_CTE = f"""
    flat AS (
        SELECT 'M-' || event_id AS mission_id,
               unnest(CASE WHEN event_type = 'view' THEN ['H-' || user_id]
                           ELSE ['H-' || user_id, 'H-' || {K}] END) AS hero_id,
               CASE WHEN event_type <> 'view' THEN 'Place ' || event_type END AS location,
               ts AS timestamp,
               CASE WHEN event_type = 'purchase' THEN 'Successful' ELSE event_type END AS outcome,
               CASE WHEN event_type <> 'view' THEN {VALUE_CENTS} * 10 END AS structural_damage,
               CASE WHEN event_type <> 'view' THEN {K} END AS civilian_injuries
        FROM events WHERE event_type NOT IN ('error', 'signup')),
    dim_missions_heroes AS (
        SELECT DISTINCT * REPLACE (CAST(structural_damage AS INTEGER) AS structural_damage)
        FROM flat),
    stg_missions AS (
        SELECT * REPLACE (CAST(structural_damage AS VARCHAR) AS structural_damage,
                          CAST(civilian_injuries AS VARCHAR) AS civilian_injuries)
        FROM dim_missions_heroes)"""
READING_SQL = f"""SELECT ts, CASE WHEN {K} > 0 THEN 'H-' || user_id END AS hero_id,
    CASE WHEN event_type <> 'error' THEN {K} END AS heart_rate, {K} * 3 AS stress_level,
    {VALUE_CENTS} AS energy_output FROM events"""
BIOMETRICS_CTE = f"""{dense_sql('hero_id', 'hour', READING_SQL, staging.MEASURES)},
    stg_biometrics AS (
        SELECT ts AS timestamp, hero_id, heart_rate, stress_level, energy_output FROM dense)"""
WIDE_CTE = """
    obt_biometrics AS (
        SELECT b.timestamp, h.name AS hero_name, h.alter_ego, h.hero_id, m.mission_id,
               m.location AS mission_location, m.outcome AS mission_outcome,
               m.structural_damage, b.heart_rate, b.stress_level, b.energy_output
        FROM stg_biometrics b
        LEFT JOIN dim_missions_heroes m
            ON m.hero_id = b.hero_id AND date_trunc('hour', m.timestamp) = b.timestamp
        LEFT JOIN dim_heroes h ON h.hero_id = b.hero_id),
    obt_missions AS (
        SELECT m.timestamp AS mission_timestamp, CAST(m.timestamp AS DATE) AS mission_date,
               h.name AS hero_name, h.alter_ego, h.hero_id, m.mission_id,
               m.location AS mission_location, m.outcome AS mission_outcome,
               m.structural_damage, b.heart_rate, b.stress_level, b.energy_output
        FROM dim_missions_heroes m
        LEFT JOIN stg_biometrics b
            ON b.hero_id = m.hero_id AND b.timestamp = date_trunc('hour', m.timestamp)
        LEFT JOIN dim_heroes h ON h.hero_id = m.hero_id)"""
LAYERS = f"WITH {HERO_CTE}, {MISSION_CTE}, {BIOMETRICS_CTE}, {WIDE_CTE}"


def stg_biometrics(t: Tables) -> DataFrame:
    bins = scratch_path(t.spark, "bins")  # their fields are parsed once, as in a run
    return staging.stg_biometrics(staging.raw_biometrics(readings(t), HOUR, work_path=bins))


def dim_heroes(t: Tables) -> DataFrame:
    return marts.dim_heroes(staging.stg_heroes(raw_heroes(t)))


def stg_missions(t: Tables) -> DataFrame:
    return staging.stg_missions(raw_missions(t))


def landed(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table, as the layers hold what several steps read."""
    path = scratch_path(df.sparkSession, label)
    export_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def obt_biometrics(t: Tables) -> DataFrame:
    missions = landed(stg_missions(t), "missions")
    return analytics.obt_biometrics(stg_biometrics(t), missions, dim_heroes(t), HOUR)


def obt_missions(t: Tables, since=None) -> DataFrame:
    bridge = landed(marts.dim_missions_heroes(stg_missions(t)), "bridge")
    fact = marts.fact_biometrics(stg_biometrics(t))
    return analytics.obt_missions(bridge, fact, dim_heroes(t), HOUR, since)


@query(f"{LAYERS} SELECT * FROM stg_heroes")
def model_stg_heroes(t):
    return staging.stg_heroes(raw_heroes(t))


@query(f"{LAYERS} SELECT * FROM stg_missions")
def model_stg_missions(t):
    return stg_missions(t)


@query(f"{LAYERS} SELECT * FROM stg_biometrics")
def model_stg_biometrics(t):
    return stg_biometrics(t)


@query(f"{LAYERS} SELECT * FROM dim_heroes")
def model_dim_heroes(t):
    return dim_heroes(t)


@query(f"{LAYERS} SELECT * FROM dim_missions_heroes")
def model_dim_missions_heroes(t):
    return marts.dim_missions_heroes(stg_missions(t))


@query(f"{LAYERS} SELECT * FROM stg_biometrics WHERE timestamp > TIMESTAMP '2024-01-20 07:00:00'")
def model_fact_biometrics(t):
    """The rows a run appends when the fact ends at the given mark."""
    return marts.fact_biometrics(stg_biometrics(t), clock("2024-01-20 07:00:00"))


@query(f"{LAYERS} SELECT * FROM stg_biometrics")
def fact_after_failed_run(t):
    """A run loses its fact before it commits, another takes the same readings, the first is tried again."""
    settings = Settings(input_dir=t.folder, root=scratch_path(t.spark, "lake"), every=HOUR)
    layers = Layers(t.spark, settings)

    def load(run_id: str, commit: bool = True) -> None:
        with layers.lease(run_id) as lease:
            layers.drop_uncommitted()
            land_readings(layers, readings(t), run_id)
            append_fact(layers, layers.staged(pending=True)["stg_biometrics"], run_id)
            if commit:
                layers.commit(lease)

    load("A", commit=False)
    load("B")
    load("A")
    return layers.models()["fact_biometrics"]


RAW_HEROES_SQL = """SELECT {} AS hero_id, {} AS name, c_mktsegment AS alter_ego,
    CAST(DATE '1940-01-01' + c_nationkey AS VARCHAR) AS first_appearance FROM customer"""


@query(
    RAW_HEROES_SQL.format("'H-' || c_custkey", "c_name")
    + " UNION ALL "
    + RAW_HEROES_SQL.format("CASE WHEN c_mktsegment <> 'BUILDING' THEN 'H-' || c_custkey END", "NULL")
)
def raw_heroes_landed(t):
    """A CSV file of heroes, landed as it is in the raw layer."""
    layers, path = lake(t, "heroes"), scratch_path(t.spark, "heroes-csv")
    export_csv(raw_heroes(t), path)
    land_as_is(layers.raw_heroes, "heroes", read_csv(t.spark, path, schemas.HEROES_FILE), "one")
    return layers.raw_heroes.read()


RAW_MISSIONS_SQL = f"""SELECT CASE WHEN event_type <> 'error' THEN 'M-' || event_id END AS mission_id,
    CASE event_type WHEN 'signup' THEN '[]' WHEN 'view' THEN '["H-' || user_id || '"]'
        ELSE '["H-' || user_id || '","H-' || {K} || '"]' END AS hero_ids,
    CASE WHEN event_type <> 'view' THEN 'Place ' || event_type END AS location, ts AS timestamp,
    CASE WHEN event_type = 'purchase' THEN 'Successful' ELSE event_type END AS outcome,
    CASE WHEN event_type <> 'view' THEN '{{"structural_damage":' || CAST({VALUE_CENTS} * 10 AS BIGINT)
        || ',"civilian_injuries":' || {K} || '}}' END AS damage_report FROM events"""


@query(f"{RAW_MISSIONS_SQL} UNION ALL {RAW_MISSIONS_SQL}")
def raw_missions_landed(t):
    """JSON documents of missions, each one array, landed with nested values as text."""
    layers, path = lake(t, "missions"), scratch_path(t.spark, "missions-json")
    write_missions(t, path)
    land_as_is(layers.raw_missions, "missions", read_json(t.spark, path, schemas.MISSIONS_FILE), "one")
    return layers.raw_missions.read().withColumn("timestamp", to_utc_ntz(F.col("timestamp")))


#: Missions in one document, about.
DOCUMENT_MISSIONS = 25_000


def write_missions(t: Tables, path: str) -> None:
    """The log of missions as 40 documents or more, each one array of some 25,000 missions at most."""
    log = raw_missions(t)
    n = max(40, -(-2 * t.events.count() // DOCUMENT_MISSIONS))  # of file footers
    damage = "structural_damage bigint, civilian_injuries int"
    nested = log.withColumns(
        {"hero_ids": F.from_json("hero_ids", "array<string>"), "damage_report": F.from_json("damage_report", damage)}
    )
    record = F.to_json(F.struct(*log.columns), {"ignoreNullFields": "false"})
    documents = nested.groupBy(F.pmod(F.xxhash64("timestamp"), F.lit(n)).alias("part")).agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list(record), ",\n"), F.lit("\n]")).alias("value")
    )
    documents.select("value", "part").write.partitionBy("part").text(path)


def lake(t: Tables, label: str) -> Layers:
    """The layers below a new folder, in schemas of their own."""
    root = scratch_path(t.spark, label)
    names = {n: f"{n}_{root[-32:]}" for n in LAYER_NAMES}
    return Layers(t.spark, Settings(input_dir=t.folder, root=root, every=HOUR, layer_names=names))


def append_readings(layers: Layers, df: DataFrame, run_id: str) -> None:
    land_readings(layers, df, run_id)
    append_fact(layers, layers.staged(run_id)["stg_biometrics"], run_id)


@query(f"{LAYERS} SELECT * FROM stg_biometrics")
def fact_after_overlapping_runs(t):
    """Another run begins between a run's append and its commit: it is refused, and comes again."""
    layers = lake(t, "overlap")

    def load(run_id: str, meanwhile=None) -> None:
        with layers.lease(run_id) as lease:
            layers.drop_uncommitted()
            append_readings(layers, readings(t), run_id)
            if meanwhile:
                meanwhile()
            layers.commit(lease)

    def intrude() -> None:
        try:
            load("intruder")
        except RunInProgress:
            return
        raise AssertionError("two runs wrote at a time")

    load("first", intrude)
    load("intruder")
    return layers.models()["fact_biometrics"]


EARLY_READINGS = READING_SQL + " WHERE ts < TIMESTAMP '2024-01-16 12:00:00'"


@query(
    f"""WITH {dense_sql('hero_id', 'hour', EARLY_READINGS, staging.MEASURES)}
    SELECT ts AS timestamp, hero_id, heart_rate, stress_level, energy_output FROM dense"""
)
def fact_view_of_committed_runs(t):
    """The fact's SQL view, defined after one run, while a second has appended and not committed."""
    layers = lake(t, "views")
    layers.create_schemas()
    early = readings(t).where(F.col("timestamp") < clock("2024-01-16 12:00:00"))
    with layers.lease("early") as lease:
        append_readings(layers, early, "early")
        layers.commit(lease)
    layers.publish()
    with layers.lease("all"):  # and it is given up
        append_readings(layers, readings(t), "all")
    return t.spark.table(f"{layers.settings.layer('marts')}.fact_biometrics")


def whole_run(t: Tables, meanwhile: Callable[[Settings], None] = lambda _: None, **given: str) -> Settings:
    """One run over the three sources as files, set up by its environment; its settings.

    ``meanwhile`` is called before the missions are there.
    """
    root = scratch_path(t.spark, "whole")
    given = {"every": HOUR, "input_dir": f"{root}/inbox", "root": f"{root}/lake", "run_id": "2024-02-01T00:00+00:00", **given}
    names = {n: f"{n}_{root[-32:]}" for n in LAYER_NAMES}
    before = dict(os.environ)
    os.environ.update({Settings.ENV_PREFIX + k.upper(): v for k, v in given.items()})
    try:
        settings = Settings.from_env(layer_names=names)
    finally:
        for k in given:
            os.environ.pop(Settings.ENV_PREFIX + k.upper())
        os.environ.update(before)
    export_csv(raw_heroes(t), settings.source(settings.heroes_file))
    export_parquet(readings(t), settings.source(settings.biometrics_file))
    meanwhile(settings)
    write_missions(t, settings.source(settings.missions_file))
    run(t.spark, settings)
    return settings


@query(f"{LAYERS} SELECT * FROM obt_missions")
def whole_run_obt_missions(t):
    """From files to the SQL view in the layer's own schema; the run is tried before its missions are
    there, which is named and leaves nothing behind, and is repeated under its id."""

    def too_early(settings: Settings) -> None:
        try:
            run(t.spark, settings)
        except SourceError as e:
            if settings.missions_file in str(e) and not Layers(t.spark, settings).models()["fact_biometrics"].count():
                return
            raise
        raise AssertionError("a run without its missions went through")

    return t.spark.table(f"{whole_run(t, too_early).layer('analytics')}.obt_missions")


@query(f"{LAYERS} SELECT * FROM obt_biometrics")
def whole_run_obt_biometrics(t):
    """The same run's other wide table, its documents cut into records in byte ranges."""
    return t.spark.table(f"{whole_run(t, missions_split='true', heroes_split='true').layer('analytics')}.obt_biometrics")


@query(f"{LAYERS} SELECT * FROM stg_biometrics")
def arrivals_shared_bins(t):
    """Files that arrive one after the other, cut inside an hour that both sides of a cut share."""
    layers = lake(t, "arrivals")
    landing, checkpoint = scratch_path(t.spark, "landing"), scratch_path(t.spark, "arrivals")
    cuts = [clock(c) for c in ("2024-01-16 12:17:00", "2024-01-20 07:43:00")]
    rows, at = readings(t), F.col("timestamp")
    for n in range(len(cuts) + 1):
        after = [at >= c for c in cuts[n - 1 : n] if n] + [at < c for c in cuts[n : n + 1]]
        rows.where(reduce(Column.__and__, after)).write.mode("append").parquet(landing)
        stream = t.spark.readStream.schema(rows.schema).parquet(landing)
        run_arrivals(t.spark, layers.settings, stream, checkpoint, close=n == len(cuts))
    return layers.models()["fact_biometrics"]


@query(
    f"""{LAYERS} SELECT * REPLACE (CASE WHEN CAST(substr(hero_id, 3) AS BIGINT) % 3 = 0
        THEN 'again' || name ELSE name END AS name) FROM dim_heroes"""
)
def model_dim_heroes_second_run(t):
    """The dimension on disk, and a batch in which every third hero has another name."""
    staged = staging.stg_heroes(raw_heroes(t))
    third = staged.where(F.substring("hero_id", 3, 20).cast("bigint") % 3 == 0)
    table = VersionedTable(t.spark, scratch_path(t.spark, "heroes"))
    for batch in (staged, third.withColumn("name", F.concat(F.lit("again"), "name"))):
        table.write(marts.dim_heroes(batch, table.read()))
    return table.read()


@query(
    f"""{LAYERS} SELECT * REPLACE (CASE WHEN CAST(substr(mission_id, 3) AS BIGINT) % 5 = 0
        THEN 'Redone' ELSE outcome END AS outcome) FROM dim_missions_heroes"""
)
def model_dim_missions_heroes_second_run(t):
    """The bridge on disk, dealt by key, and a batch of every fifth mission."""
    staged = landed(stg_missions(t), "missions")
    fifth = staged.where(F.substring("mission_id", 3, 20).cast("bigint") % 5 == 0)
    table = BucketTable(t.spark, scratch_path(t.spark, "bridge"), marts.BRIDGE_KEYS, 8, ["timestamp"])
    for batch in (staged, fifth.withColumn("outcome", F.lit("Redone"))):
        table.upsert(marts.dim_missions_heroes(batch))
    return table.read()


@query(
    f"""{LAYERS} SELECT * REPLACE (CASE WHEN mission_date < (SELECT max(mission_date) FROM obt_missions
        WHERE mission_date <= DATE '2024-01-20') THEN 'old' ELSE mission_outcome END AS mission_outcome)
    FROM obt_missions"""
)
def model_obt_missions_second_run(t):
    """The wide table by day on disk; a run replaces its last day and adds later ones."""
    whole = landed(obt_missions(t), "wide")
    known = whole.where(F.col("mission_date") <= F.lit("2024-01-20").cast("date"))
    table = DayTable(t.spark, scratch_path(t.spark, "wide"), whole.schema, "mission_date")
    table.replace(known.withColumn("mission_outcome", F.lit("old")))
    table.replace(days_from(whole, "mission_date", F.lit(table.last_day()).cast("date")))
    return table.read()


@query(f"{LAYERS} SELECT * FROM obt_missions")
def obt_missions_staged_replace(t):
    """A run that writes days beside the table and fails leaves them unseen; the next one switches."""
    layers, whole = lake(t, "staged"), landed(obt_missions(t), "wide")
    spoiled = whole.withColumn("mission_outcome", F.lit("spoiled"))
    last = "2024-01-20"
    with layers.lease("first") as lease:
        known = whole.where(F.col("mission_date") <= F.lit(last).cast("date"))
        layers.commit(lease, {"obt_missions": layers.wide_missions.replace(known, "")})
    held = layers.log.last()["tables"]["obt_missions"]
    with layers.lease("failed"):
        layers.wide_missions.replace(spoiled, held)
    with layers.lease("second") as lease:
        since = F.lit(layers.marks()["mission_day"]).cast("date")
        fresh = layers.wide_missions.replace(days_from(whole, "mission_date", since), held)
        layers.commit(lease, {"obt_missions": fresh})
    return layers.models()["obt_missions"]


@query(f"{LAYERS} SELECT * FROM obt_biometrics")
def model_obt_biometrics(t):
    return obt_biometrics(t)


@query(f"{LAYERS} SELECT * FROM obt_missions")
def model_obt_missions(t):
    return obt_missions(t)


@query(f"{LAYERS} SELECT * FROM obt_missions WHERE mission_date >= DATE '2024-01-25'")
def model_obt_missions_increment(t):
    """The days a run replaces when the table ends on the given day."""
    return obt_missions(t, F.lit("2024-01-25").cast("date"))


RISK_SQL = """SELECT hero_name, avg(energy_output) AS avg_energy_output FROM {}
    WHERE structural_damage > 10000 {} GROUP BY hero_name
    ORDER BY avg_energy_output DESC NULLS {}, hero_name LIMIT 1"""
RELIABLE_SQL = """SELECT hero_name, count(DISTINCT mission_id) AS successful_missions_count,
    avg(stress_level) AS avg_stress_level FROM {} WHERE mission_outcome = 'Successful'
    GROUP BY hero_name ORDER BY successful_missions_count DESC NULLS {}, hero_name LIMIT 1"""


@query(f"{LAYERS} {RISK_SQL.format('obt_biometrics', 'AND mission_id IS NOT NULL', 'FIRST')}")
def question_risk_by_bin(t):
    return questions.strongest_under_risk(obt_biometrics(t), on_missions_only=True, nulls="first")


@query(f"{LAYERS} {RISK_SQL.format('obt_missions', '', 'LAST')}")
def question_risk_by_mission(t):
    return questions.strongest_under_risk(obt_missions(t))


@query(f"{LAYERS} {RELIABLE_SQL.format('obt_biometrics', 'FIRST')}")
def question_reliable_by_bin(t):
    return questions.most_reliable(obt_biometrics(t), nulls="first")


@query(f"{LAYERS} {RELIABLE_SQL.format('obt_missions', 'LAST')}")
def question_reliable_by_mission(t):
    return questions.most_reliable(obt_missions(t))


def check_sql(check: Check) -> tuple[str, str, str, str]:
    """A declared check as the SQL of its failure count."""
    col, args = check.columns[0], check.args
    if check.test == "unique":
        count = duplicates_sql(
            check.model,
            ", ".join(check.columns),
            " OR ".join(f"{c} IS NOT NULL" for c in check.columns),
        )
    elif check.test == "in_parent":
        parent = f"SELECT {args['parent_col']} FROM {args['parent']}"
        count = rows_sql(check.model, f"{col} IS NOT NULL AND {col} NOT IN ({parent})")
    elif check.test == "in_set":
        values = ", ".join(f"'{v}'" for v in args["values"])
        count = rows_sql(check.model, f"{col} NOT IN ({values})")
    elif check.test == "between":
        bounds = [f"{col} < {args['lo']}"] + ([f"{col} > {args['hi']}"] if "hi" in args else [])
        count = rows_sql(check.model, " OR ".join(bounds))
    else:
        count = rows_sql(check.model, f"{col} IS NULL")
    return check.model, check.test, ",".join(check.columns), count


@query(
    f"{LAYERS}, fact_biometrics AS (SELECT * FROM stg_biometrics) "
    + report_sql([check_sql(c) for c in CHECKS])
)
def model_dq_report(t):
    # The tables that several checks read are on disk, as they are after a run.
    heroes, missions, fact = together(
        lambda: landed(dim_heroes(t), "heroes"),
        lambda: landed(stg_missions(t), "missions"),
        lambda: landed(marts.fact_biometrics(stg_biometrics(t)), "fact"),
    )
    bridge, wide = together(
        lambda: landed(marts.dim_missions_heroes(missions), "bridge"),
        lambda: landed(analytics.obt_biometrics(fact, missions, heroes, HOUR), "wide"),
    )
    models = {
        "dim_heroes": heroes,
        "dim_missions_heroes": bridge,
        "fact_biometrics": fact,
        "obt_biometrics": wide,
    }
    return report(models, CHECKS)
