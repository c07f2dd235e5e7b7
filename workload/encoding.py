"""Rows to text: the codec's writing half and the unload."""

from __future__ import annotations

from pyspark.sql import functions as F

from ferryline import UnloadOptions, encode, unload
from ferryline.functions.codec import null_safe_equal
from ferryline.shared import new_path
from ferryline.sources.text import read_lines
from workload.tables import ESCAPED_ENDS, lineitem, read

NULLS = UnloadOptions(null_string="\\\\N")


def encode_fields(spark, sf_dir):
    return encode(lineitem(spark, sf_dir)).select("value")


def escape_delim(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn(
        "text", F.replace("text", F.lit("a"), F.lit("\\"))
    )
    return encode(docs, ESCAPED_ENDS, keep=["doc_id"]).select("doc_id", "value")


def escape_tab_delim(spark, sf_dir):
    talk = read(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.translate("text", " \n", "\t ").alias("text")
    )
    return encode(talk, UnloadOptions(field_delim="\t")).select("value")


def encode_nulls(spark, sf_dir):
    rows = _customers_with_nulls(spark, sf_dir)
    return encode(rows, NULLS, keep=["c_custkey"]).select("c_custkey", "value")


def encode_nulls_row_wise(spark, sf_dir):
    rows = _customers_with_nulls(spark, sf_dir)
    opts = UnloadOptions(null_string="none", null_non_string="0")
    return encode(rows, opts, keep=["c_custkey"]).select("c_custkey", "value")


def _customers_with_nulls(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"),
        F.nullif("c_nationkey", F.lit(5)).alias("c_nationkey"),
        "c_name",
    )


def encode_bool(spark, sf_dir):
    rows = _flagged_orders(spark, sf_dir)
    words = encode(rows, UnloadOptions(bool_style="TRUE_FALSE"), keep=rows.columns)
    words = words.withColumnRenamed("value", "words")
    return encode(words, columns=rows.columns, keep=["o_orderkey", "words"]).select(
        "o_orderkey", "words", F.col("value").alias("letters")
    )


def _flagged_orders(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus") == "O", F.col("o_orderpriority") == "5-LOW").alias("is_open"),
        F.col("o_orderpriority").startswith("1").alias("is_urgent"),
    )


def encode_decimal(spark, sf_dir):
    price = F.col("p_retailprice").cast("decimal(18,4)")
    rows = read(spark, sf_dir, "part").select(
        "p_partkey",
        price.cast("decimal(30,8)").alias("wide"),
        (-price).cast("decimal(12,2)").alias("negative"),
        F.col("p_size").cast("decimal(10,5)").alias("whole"),
    )
    return encode(rows).select("value")


def encode_temporal(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("ts").cast("date").alias("day"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute"),
        F.col("ts").alias("time"),
    )
    return encode(rows, UnloadOptions(time_columns=("time",))).select("value")


def encode_char_pad(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return encode(rows, UnloadOptions(char_widths={"c_mktsegment": 15})).select("value")


def encode_char_too_long(spark, sf_dir):
    """A CHAR value over its width is a reject, never cut."""
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return encode(rows, UnloadOptions(char_widths={"c_mktsegment": 9}), keep=["c_custkey"]).select(
        "c_custkey", F.col("_reject_column").alias("column"), F.col("_reject_reason").alias("reason"))


def newline_space(spark, sf_dir):
    return encode(
        read(spark, sf_dir, "documents").select("doc_id", "text"),
        UnloadOptions(newline_policy="space"),
    ).select("value")


def unload_rejects(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("n_chars") % 2 == 0, F.translate("text", "\n", " "))
        .otherwise(F.col("text")).alias("text"),
        F.when(F.col("n_chars") % 5 == 0, F.concat("lang", F.lit("\b")))
        .otherwise(F.col("lang")).alias("lang"),
    )
    return encode(docs, keep=["doc_id"]).select(
        "doc_id", F.col("_reject_column").alias("column"), F.col("_reject_reason").alias("reason")
    )


def bulk_unload(spark, sf_dir):
    path = new_path(spark, "unload")
    unload(lineitem(spark, sf_dir), path)
    return read_lines(spark, path)


def unload_with_budget(spark, sf_dir):
    talk = read(spark, sf_dir, "conversations")
    path = new_path(spark, "unload")
    unload(talk, path, UnloadOptions(max_errors=talk.count() + 1))
    return read_lines(spark, path)


def unload_summary(spark, sf_dir):
    talk = read(spark, sf_dir, "conversations")
    shared = new_path(spark, "rejects")
    opts = UnloadOptions(max_errors=talk.count() + 1, rejects_path=shared)
    unload(talk, new_path(spark, "unload"), opts)
    rejects = spark.read.schema("raw string, column string, reason string").json(
        f"{shared}/rejects"
    )
    return rejects.groupBy("column", "reason").agg(F.count(F.lit(1)).alias("row_count"))


def unload_log(spark, sf_dir):
    """The one-row log of an unload with rejects."""
    talk = read(spark, sf_dir, "conversations")
    shared = new_path(spark, "rejects")
    opts = UnloadOptions(max_errors=talk.count() + 1, rejects_path=shared)
    unload(talk, new_path(spark, "unload"), opts)
    log = spark.read.schema(
        "rows_read bigint, rows_loaded bigint, rows_rejected bigint, aborted boolean,"
        " by_reason map<string, bigint>").json(f"{shared}/summary")
    return log.select("rows_read", "rows_loaded", "rows_rejected", "aborted",
                      F.col("by_reason")["line_end"].alias("line_end"))


def null_safe_eq(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        F.nullif("l_returnflag", F.lit("N")).alias("a"),
        F.when(F.col("l_linestatus") == "O", F.lit("A")).alias("b"),
    )
    return rows.groupBy("a", "b", null_safe_equal(F.col("a"), F.col("b")).alias("same")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


ENCODINGS = [
    encode_fields, escape_delim, escape_tab_delim, encode_nulls, encode_nulls_row_wise,
    encode_bool, encode_decimal, encode_temporal, encode_char_pad,
    encode_char_too_long, newline_space,
    unload_rejects, bulk_unload, unload_with_budget, unload_summary, unload_log,
    null_safe_eq,
]

LINEITEM_TEXT = r"""
    SELECT concat_ws(',', l_orderkey, l_partkey, l_suppkey, l_linenumber,
        CAST(l_quantity AS DECIMAL(18,4)), CAST(l_extendedprice AS DECIMAL(18,4)),
        CAST(l_discount AS DECIMAL(18,4)), CAST(l_tax AS DECIMAL(18,4)),
        l_returnflag, l_linestatus, l_shipdate) AS value
    FROM lineitem"""

ENCODING_SQL = {
    "encode_fields": LINEITEM_TEXT,
    "escape_delim": r"""
        SELECT doc_id, concat_ws(',', doc_id,
            replace(replace(replace(replace(text, 'a', '\'), '\', '\\'), ',', '\,'),
                    chr(10), '\' || chr(10)),
            lang, replace(replace(source, '\', '\\'), ',', '\,'), n_chars) AS value
        FROM documents""",
    "escape_tab_delim": r"""
        SELECT concat_ws(chr(9), conv_id, turn, role,
            replace(replace(replace(replace(text, ' ', chr(9)), chr(10), ' '), '\', '\\'),
                    chr(9), '\' || chr(9))) AS value
        FROM conversations""",
    "encode_nulls": r"""
        SELECT c_custkey, concat_ws(',', c_custkey,
            coalesce(nullif(c_mktsegment, 'BUILDING'), '\N'),
            coalesce(CAST(nullif(c_nationkey, 5) AS VARCHAR), ''), c_name) AS value
        FROM customer""",
    "encode_nulls_row_wise": r"""
        SELECT c_custkey, concat_ws(',', c_custkey,
            coalesce(nullif(c_mktsegment, 'BUILDING'), 'none'),
            coalesce(CAST(nullif(c_nationkey, 5) AS VARCHAR), '0'), c_name) AS value
        FROM customer""",
    "encode_bool": r"""
        WITH f AS (SELECT o_orderkey,
                CASE WHEN (o_orderstatus = 'O') = (o_orderpriority = '5-LOW') THEN NULL
                     ELSE o_orderstatus = 'O' END AS is_open,
                o_orderpriority LIKE '1%' AS is_urgent FROM orders)
        SELECT o_orderkey,
            concat_ws(',', o_orderkey, coalesce(upper(CAST(is_open AS VARCHAR)), ''),
                      upper(CAST(is_urgent AS VARCHAR))) AS words,
            concat_ws(',', o_orderkey, coalesce(upper(left(CAST(is_open AS VARCHAR), 1)), ''),
                      upper(left(CAST(is_urgent AS VARCHAR), 1))) AS letters
        FROM f""",
    "encode_decimal": r"""
        SELECT concat_ws(',', p_partkey,
            CAST(CAST(p_retailprice AS DECIMAL(18,4)) AS DECIMAL(30,8)),
            CAST(-CAST(p_retailprice AS DECIMAL(18,4)) AS DECIMAL(12,2)),
            CAST(p_size AS DECIMAL(10,5))) AS value
        FROM part""",
    "encode_temporal": r"""
        SELECT concat_ws(',', event_id, ts, CAST(ts AS DATE),
            strftime(ts, '%Y-%m-%d %H:%M:00'), strftime(ts, '%H:%M:%S')) AS value
        FROM events""",
    "encode_char_pad": r"""
        SELECT concat_ws(',', c_custkey, rpad(c_mktsegment, 15, ' '), c_nationkey) AS value
        FROM customer""",
    "encode_char_too_long": """
        SELECT c_custkey, CASE WHEN length(rtrim(c_mktsegment)) > 9 THEN 'c_mktsegment' END AS "column",
            CASE WHEN length(rtrim(c_mktsegment)) > 9 THEN 'too_long' END AS reason
        FROM customer""",
    "newline_space": r"""
        SELECT concat_ws(',', doc_id, replace(replace(replace(text, '\', '\\'), ',', '\,'),
            chr(10), ' ')) AS value
        FROM documents""",
    "unload_rejects": r"""
        SELECT doc_id,
            CASE WHEN n_chars % 2 <> 0 AND contains(text, chr(10)) THEN 'text'
                 WHEN n_chars % 5 = 0 THEN 'lang' END AS "column",
            CASE WHEN n_chars % 2 <> 0 AND contains(text, chr(10)) THEN 'line_end'
                 WHEN n_chars % 5 = 0 THEN 'control_character' END AS reason
        FROM documents""",
    "bulk_unload": LINEITEM_TEXT,
    "unload_with_budget": r"""
        SELECT concat_ws(',', conv_id, turn, role,
            replace(replace(text, '\', '\\'), ',', '\,')) AS value
        FROM conversations WHERE NOT contains(text, chr(10))""",
    "unload_summary": r"""
        SELECT 'text' AS "column", 'line_end' AS reason, count(*) AS row_count
        FROM conversations WHERE contains(text, chr(10))""",
    "unload_log": r"""
        SELECT count(*) AS rows_read, count(*) FILTER (NOT bad) AS rows_loaded,
               count(*) FILTER (bad) AS rows_rejected, false AS aborted, count(*) FILTER (bad) AS line_end
        FROM (SELECT contains(text, chr(10)) AS bad FROM conversations)""",
    "null_safe_eq": r"""
        SELECT a, b, a IS NOT DISTINCT FROM b AS same, count(*) AS row_count
        FROM (SELECT nullif(l_returnflag, 'N') AS a,
                     CASE WHEN l_linestatus = 'O' THEN 'A' END AS b FROM lineitem)
        GROUP BY ALL""",
}
