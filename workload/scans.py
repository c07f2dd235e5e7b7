"""Sources: slices, bounds, projection, conditions, incremental reads."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ferryline import bounds, incremental, slice_df
from ferryline.operators.slices import (
    exact_row, quantile_cuts, quantile_slice_number, range_slice_number, slice_number,
)
from ferryline.plans.verified import copy_verified, read_copy
from ferryline.shared import new_path
from ferryline.sources.catalog import query_rows, select_rows
from ferryline.streaming.late import late_batch
from workload.tables import lineitem, orders, read

QUERY_TEXT = """
SELECT o_orderpriority, count(*) AS line_count,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DECIMAL(28,4)) AS quantity
FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey
WHERE l_returnflag <> 'N' OR o_orderstatus = 'F'
GROUP BY o_orderpriority
"""


def sliced_scan(spark, sf_dir):
    return slice_df(orders(spark, sf_dir), "o_orderkey", 4).groupBy("slice").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("o_custkey").alias("custkeys"),
        F.sum("o_totalprice").alias("price"),
    )


def sliced_scan_signed_keys(spark, sf_dir):
    keyed = read(spark, sf_dir, "customer").withColumn(
        "k", F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey") - 75)
    )
    return slice_df(keyed, "k", 4).select("c_custkey", "k", "slice")


def hashed_slices(spark, sf_dir):
    keys = ["l_returnflag", "l_orderkey", "l_linenumber"]
    per_slice = slice_df(lineitem(spark, sf_dir), keys, 16).groupBy("slice").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("price")
    )
    return per_slice.agg(
        F.count(F.lit(1)).alias("slice_count"),
        F.sum("n").alias("row_count"),
        F.sum("price").cast("decimal(38,4)").alias("price"),
    )


def range_sliced_scan(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    lo, hi = bounds(events, "event_id").first()
    slice_id = range_slice_number(F.col("event_id"), lo, hi, 8)
    return events.groupBy(slice_id.alias("slice")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
    )


def range_sliced_timestamps(spark, sf_dir):
    """Ranges of a time column; the literals do not depend on any process's zone."""
    events = read(spark, sf_dir, "events")
    lo, hi = exact_row(events, F.min("ts"), F.max("ts"))
    slice_id = range_slice_number(F.col("ts"), lo, hi, 4, events.schema["ts"].dataType)
    return events.select("event_id", slice_id.cast("int").alias("slice"))


def split_bounds(spark, sf_dir):
    return bounds(read(spark, sf_dir, "orders"), "o_orderkey")


def query_scan(spark, sf_dir):
    return query_rows(
        spark, QUERY_TEXT,
        orders=read(spark, sf_dir, "orders"), lineitem=read(spark, sf_dir, "lineitem"),
    )


def project_columns(spark, sf_dir):
    return select_rows(
        read(spark, sf_dir, "lineitem"), ["l_shipdate", "l_returnflag", "l_orderkey"]
    )


def select_all(spark, sf_dir):
    return select_rows(read(spark, sf_dir, "supplier"), [])


def where_filter(spark, sf_dir):
    return select_rows(
        read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"],
        "l_quantity > 25 AND l_shipdate < TIMESTAMP '1996-01-01 00:00:00'",
    )


def slice_and_where_or(spark, sf_dir):
    rows = select_rows(
        read(spark, sf_dir, "orders"), ["o_orderkey", "o_orderstatus"],
        "o_orderstatus = 'F' OR o_orderpriority LIKE '1%'",
    )
    return slice_df(rows, "o_orderkey", 3)


def quantile_sliced_scan(spark, sf_dir):
    """Sixteen slices of a skewed key: squares, and a third of all rows with one value."""
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey") * F.col("l_orderkey"))
    items = lineitem(spark, sf_dir).withColumn("k", key)
    cuts = quantile_cuts(items, "k", 16)
    number = quantile_slice_number(items, "k", cuts, spread_by=["l_orderkey", "l_linenumber"])
    per_slice = items.groupBy(number.alias("slice")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("price"),
        F.min("k").alias("first_key"), F.max("k").alias("last_key"))
    after = F.lead("first_key").over(Window.orderBy("slice"))  # sixteen rows
    return per_slice.withColumn("after", after).agg(
        F.count(F.lit(1)).alias("slice_count"),
        F.sum("n").alias("row_count"),
        F.sum("price").cast("decimal(38,4)").alias("price"),
        (F.max("n") * F.lit(16) < F.sum("n") * 2).alias("under_twice_the_mean"),
        F.bool_and(F.coalesce(F.col("last_key") <= F.col("after"), F.lit(True))).alias("in_order"))


def text_sliced_scan(spark, sf_dir):
    """Ranges of names: where each name belongs, as its text alone decides."""
    part = read(spark, sf_dir, "part")
    lo, hi = bounds(part, "p_name").first()
    number = range_slice_number(F.col("p_name"), lo, hi, 8, part.schema["p_name"].dataType)
    per_slice = part.groupBy(number.alias("slice")).agg(
        F.count(F.lit(1)).alias("n"), F.min("p_name").alias("first_name"), F.max("p_name").alias("last_name"),
        F.sum("p_size").alias("sizes"))
    after = F.lead("first_name").over(Window.orderBy("slice"))  # eight rows
    return per_slice.withColumn("after", after).agg(
        (F.count(F.lit(1)) > 1).alias("several"),
        F.sum("n").alias("row_count"), F.sum("sizes").alias("sizes"),
        F.min("first_name").alias("first_name"), F.max("last_name").alias("last_name"),
        F.bool_and(F.coalesce(F.col("last_name") < F.col("after"), F.lit(True))).alias("disjoint"))


def verified_slices(spark, sf_dir):
    """A copy whose source is another at its first read: only the slices that differ are read again."""
    rows, reads = orders(spark, sf_dir), []

    def source():
        reads.append(1)
        if len(reads) > 1:
            return rows
        changed = F.when(F.col("o_orderkey") % 8 == 3, F.lit("?")).otherwise(F.col("o_orderstatus"))
        return rows.where("o_orderkey % 8 <> 5").withColumn("o_orderstatus", changed)

    path = new_path(spark, "verified")
    report = copy_verified(spark, source, lambda df: slice_number(df, "o_orderkey", 8), path)
    repaired = ",".join(map(str, report["repaired"]))
    return read_copy(spark, path, rows.schema).withColumn("repaired", F.lit(repaired))


def incremental_append(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    lo, hi = bounds(events, "event_id").first()
    rows, mark = incremental(events, "event_id", (lo + hi) // 2)
    return rows.select("event_id", "user_id", "event_type", F.lit(mark).cast("bigint").alias("mark"))


def incremental_late_rows(spark, sf_dir):
    """Two runs; every tenth row of the first half arrives after the first run, a quarter of them too late."""
    events, ledger = read(spark, sf_dir, "events").select("event_id", "event_type"), new_path(spark, "ledger")
    lo, hi = bounds(events, "event_id").first()
    middle, look_back = (lo + hi) // 2, (hi - lo) // 4
    early = events.where((F.col("event_id") <= middle) & (F.col("event_id") % 10 != 3))
    parts = []
    for number, arrived in enumerate((early, events)):
        batch = late_batch(arrived, "event_id", ["event_id"], ledger, look_back)
        parts.append(batch.rows.select("*", F.lit(number).alias("run"), F.lit(batch.mark).cast("bigint").alias("mark")))
        batch.commit()
    return parts[0].unionAll(parts[1])


def incremental_lastmodified(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    first = bounds(events, "ts").first()["lo"]
    rows, mark = incremental(events, "ts", first)
    return rows.select("event_id", "ts", F.lit(mark).cast("timestamp_ntz").alias("mark"))


SCANS = [
    sliced_scan, sliced_scan_signed_keys, hashed_slices, range_sliced_scan,
    range_sliced_timestamps, quantile_sliced_scan, text_sliced_scan, verified_slices, split_bounds,
    query_scan, project_columns, select_all, where_filter, slice_and_where_or,
    incremental_append, incremental_late_rows, incremental_lastmodified,
]

SCAN_SQL = {
    "sliced_scan": """
        SELECT CAST(o_orderkey % 4 AS INTEGER) AS slice, count(*) AS row_count,
               CAST(sum(o_custkey) AS BIGINT) AS custkeys,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DECIMAL(28,4)) AS price
        FROM orders GROUP BY 1""",
    "sliced_scan_signed_keys": """
        SELECT c_custkey, k, CAST(coalesce(((k % 4) + 4) % 4, 0) AS INTEGER) AS slice
        FROM (SELECT c_custkey,
                     CASE WHEN c_custkey % 7 <> 0 THEN c_custkey - 75 END AS k
              FROM customer)""",
    "hashed_slices": """
        SELECT CAST(16 AS BIGINT) AS slice_count, count(*) AS row_count,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS price
        FROM lineitem""",
    "range_sliced_scan": """
        WITH b AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events)
        SELECT CAST(least((event_id - lo) * 8 // (hi - lo), 7) AS INTEGER) AS slice,
               count(*) AS row_count, min(event_id) AS first_id, max(event_id) AS last_id
        FROM events, b GROUP BY 1""",
    "range_sliced_timestamps": """
        WITH b AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events)
        SELECT event_id, CAST(
            (epoch_us(ts) >= round_even(lo + (hi - lo) / 4.0, 0))::INT
            + (epoch_us(ts) >= round_even(lo + (hi - lo) * 2 / 4.0, 0))::INT
            + (epoch_us(ts) >= round_even(lo + (hi - lo) * 3 / 4.0, 0))::INT AS INTEGER) AS slice
        FROM events, b""",
    "quantile_sliced_scan": """
        SELECT CAST(16 AS BIGINT) AS slice_count, count(*) AS row_count,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DECIMAL(38,4)) AS price,
               true AS under_twice_the_mean, true AS in_order
        FROM lineitem""",
    "text_sliced_scan": """
        SELECT true AS several, count(*) AS row_count, CAST(sum(p_size) AS BIGINT) AS sizes,
               min(p_name) AS first_name, max(p_name) AS last_name, true AS disjoint
        FROM part""",
    "verified_slices": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,4)) AS o_totalprice,
               o_orderdate, o_orderpriority, '3,5' AS repaired FROM orders""",
    "split_bounds": "SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders",
    "query_scan": QUERY_TEXT.format(orders="orders", lineitem="lineitem"),
    "project_columns": "SELECT l_shipdate, l_returnflag, l_orderkey FROM lineitem",
    "select_all": "SELECT * FROM supplier",
    "where_filter": """
        SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        WHERE l_quantity > 25 AND l_shipdate < TIMESTAMP '1996-01-01 00:00:00'""",
    "slice_and_where_or": """
        SELECT o_orderkey, o_orderstatus, CAST(o_orderkey % 3 AS INTEGER) AS slice
        FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority LIKE '1%'""",
    "incremental_append": """
        WITH b AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events)
        SELECT event_id, user_id, event_type, hi AS mark
        FROM events, b WHERE event_id > (lo + hi) // 2""",
    "incremental_late_rows": """
        WITH b AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events),
        early AS (
            SELECT event_id, event_type FROM events, b WHERE event_id <= (lo + hi) // 2 AND event_id % 10 <> 3),
        first AS (SELECT max(event_id) AS mark FROM early)
        SELECT event_id, event_type, 0 AS run, mark FROM early, first
        UNION ALL
        SELECT event_id, event_type, 1, hi FROM events, b, first
        WHERE event_id > mark - (hi - lo) // 4 AND event_id NOT IN (SELECT event_id FROM early)""",
    "incremental_lastmodified": """
        WITH b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events)
        SELECT event_id, ts, hi AS mark FROM events, b WHERE ts > lo""",
}
