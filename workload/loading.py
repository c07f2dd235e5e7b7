"""Text to rows: the codec's reading half, loads, appends and updates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline import (
    Directory, LoadOptions, Published, UnloadOptions, accepted, decode, encode, load, load_records,
    rejected, time_field, unload, update_by_key, update_files,
)
from ferryline.shared import new_path
from ferryline.sources.text import read_lines
from workload.tables import ESCAPED_ENDS, ESCAPED_ENDS_IN, lineitem, money, orders, read

NULLS = LoadOptions(null_string="\\\\N")


def _ddl(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity decimal(18,4), l_extendedprice decimal(18,4), l_discount decimal(18,4),"
    " l_tax decimal(18,4), l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def decode_fields(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn(
        "text", F.replace("text", F.lit("a"), F.lit("\\"))
    )
    return accepted(
        decode(encode(docs, ESCAPED_ENDS), docs.schema, ESCAPED_ENDS_IN), docs.schema
    )


def decode_nulls(spark, sf_dir):
    key = F.col("c_custkey")
    lines = read(spark, sf_dir, "customer").select(
        F.concat_ws(
            ",", key,
            F.when(key % 5 == 0, F.lit("\\N")).when(key % 5 == 1, "\\\\N").otherwise(F.col("c_name")),
            F.when(key % 7 == 0, F.lit("\\N")).when(key % 7 == 1, "")
            .otherwise(F.col("c_nationkey").cast("string")),
            F.when(key % 3 == 0, "").otherwise(F.col("c_mktsegment")),
        ).alias("value")
    )
    schema = _ddl("c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string")
    return accepted(decode(lines, schema, NULLS), schema)


def decode_bool(spark, sf_dir):
    key = F.col("o_orderkey")
    word = (
        F.when(key % 5 == 0, "TRUE").when(key % 5 == 1, "false").when(key % 5 == 2, "T")
        .when(key % 5 == 3, "1").otherwise("null")
    )
    lines = read(spark, sf_dir, "orders").select(F.concat_ws(",", key, word).alias("value"))
    return decode(lines, _ddl("o_orderkey bigint, flag boolean")).select(
        "o_orderkey", "flag", F.col("_reject_reason").alias("reason")
    )


def corrupt_lineitem(spark, sf_dir):
    """Lines of ``lineitem``; one in a hundred is broken, in one of four ways."""
    pick = (F.col("l_orderkey") + F.col("l_linenumber")) % 400
    rows = lineitem(spark, sf_dir)
    rows = rows.select(pick.alias("pick"), *[F.col(c).cast("string") for c in rows.columns])
    pick = F.col("pick")
    return rows.select(
        F.concat_ws(
            ",",
            F.when(pick == 0, F.concat(F.lit(" "), F.col("l_orderkey"))).otherwise(F.col("l_orderkey")),
            "l_partkey", "l_suppkey", "l_linenumber",
            F.when(pick == 100, "many").otherwise(F.col("l_quantity")),
            "l_extendedprice",
            F.when(pick == 200, F.concat("l_discount", F.lit("1"))).otherwise(F.col("l_discount")),
            "l_tax", "l_returnflag", "l_linestatus",
            F.when(pick == 300, F.left("l_shipdate", F.lit(10)))
            .otherwise(F.col("l_shipdate")),
        ).alias("value")
    )


def decode_typed(spark, sf_dir):
    schema = _ddl(LINEITEM)
    return accepted(decode(corrupt_lineitem(spark, sf_dir), schema), schema)


def decode_typed_rejects(spark, sf_dir):
    return rejected(decode(corrupt_lineitem(spark, sf_dir), _ddl(LINEITEM)))


def decode_utf8(spark, sf_dir):
    """Names with planted bytes: some are UTF-8, the others are rejects; through files."""
    # A lone byte, an overlong form, a cut-off form, a surrogate, a point too high; then two that are right.
    planted = ("80", "C080", "E282", "EDA080", "F5808080", "C3A9", "F09F9880")
    path, key = new_path(spark, "text"), F.col("c_custkey")
    tail = F.get(F.array(*[F.unhex(F.lit(p)) for p in planted]), F.pmod(key, F.lit(9)).cast("int"))
    line = F.concat(F.concat_ws(",", key, "c_name").cast("binary"), F.coalesce(tail, F.lit(b"")))
    read(spark, sf_dir, "customer").select(line.cast("string").alias("value")).write.text(path)
    decoded = decode(read_lines(spark, path), _ddl("c_custkey bigint, c_name string"))
    right = F.col("_reject_reason").isNull()
    return decoded.select("c_custkey", F.when(right, F.col("c_name")).alias("c_name"),
                          F.col("_reject_reason").alias("reason"))


def decode_time(spark, sf_dir):
    lines = read(spark, sf_dir, "events").select(
        F.concat_ws(
            ",", "event_id",
            F.when(F.col("event_id") % 10 == 0, F.date_format("ts", "HH:mm"))
            .otherwise(F.date_format("ts", "HH:mm:ss")),
            F.col("ts").cast("date"),
        ).alias("value")
    )
    schema = _ddl("event_id bigint").add(time_field("at")).add("day", "date")
    return decode(lines, schema).select(
        "event_id", F.when(F.col("_reject_reason").isNull(), F.col("at")).alias("at"), "day",
        F.col("_reject_reason").alias("reason"),
    )


def truncate_varchar(spark, sf_dir):
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    schema = _ddl("p_partkey bigint, p_name varchar(8), p_type varchar(200), p_brand char(12)")
    return accepted(decode(encode(part), schema), schema)


def decode_arity(spark, sf_dir):
    key = F.col("o_orderkey")
    lines = read(spark, sf_dir, "orders").select(
        F.concat(
            key, F.lit(","), "o_orderstatus",
            F.when(key % 6 == 0, "").when(key % 6 == 1, ",x,y").when(key % 6 == 2, ",x\\,y")
            .when(key % 6 == 3, ",x\\").when(key % 6 == 4, ",x\\\\").otherwise(","),
        ).alias("value")
    )
    return decode(lines, _ddl("o_orderkey bigint, o_orderstatus string, note string")).select(
        F.col("_raw").alias("raw"), F.col("_reject_reason").alias("reason"),
        F.when(F.col("_reject_reason").isNull(), F.col("note")).alias("note"),
    )


def ctrlchars_policy(spark, sf_dir):
    key = F.col("event_id")
    lines = read(spark, sf_dir, "events").select(
        "event_id",
        F.concat(
            "event_type",
            F.when(key % 4 == 0, "\t").when(key % 4 == 1, "\b").when(key % 4 == 2, "\r")
            .otherwise("\\\r"),
        ).alias("value"),
    )
    schema = _ddl("event_type string")
    strict = decode(lines, schema, keep=["event_id"]).select(
        "event_id", F.lit("off").alias("flag"), F.col("_reject_reason").alias("reason")
    )
    loose = decode(lines, schema, LoadOptions(ctrl_chars=True), keep=["event_id"]).select(
        "event_id", F.lit("on").alias("flag"), F.col("_reject_reason").alias("reason")
    )
    return strict.unionAll(loose)


def text_load(spark, sf_dir):
    path, target = new_path(spark, "text"), new_path(spark, "target")
    rows = orders(spark, sf_dir)
    rows.select(F.concat_ws("|", *[F.col(c).cast("string") for c in rows.columns])).write.text(path)
    load(spark, path, Directory(target), LoadOptions(field_delim="|"), schema=rows.schema)
    return spark.read.parquet(target)


def record_export(spark, sf_dir):
    path, target = new_path(spark, "records"), new_path(spark, "target")
    part = read(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_size", money("p_retailprice")
    )
    part.write.parquet(path)
    load_records(spark, path, Directory(target), LoadOptions(field_delim="|"), schema=part.schema)
    return spark.read.parquet(target)


def utf8_roundtrip(spark, sf_dir):
    path, target = new_path(spark, "unload"), new_path(spark, "target")
    docs = read(spark, sf_dir, "documents")
    unload(docs, path, ESCAPED_ENDS)
    load(spark, path, Directory(target), ESCAPED_ENDS_IN, schema=docs.schema)
    return spark.read.parquet(target)


def escaped_newline_load(spark, sf_dir):
    """Texts with line feeds in files of LF-separated records."""
    path, target = new_path(spark, "unload"), new_path(spark, "target")
    docs = read(spark, sf_dir, "documents").withColumn(
        "text", F.concat("text", F.when(F.col("doc_id") % 3 == 0, "\n\\").when(F.col("doc_id") % 3 == 1, "\\\n\r\n")
                         .otherwise("")))
    unload(docs, path, UnloadOptions(newline_policy="continue", null_string="\\\\N"))
    load(spark, path, Directory(target), LoadOptions(continued_lines=True, null_string="\\\\N"), schema=docs.schema)
    return spark.read.parquet(target)


def load_lineitem(spark, sf_dir):
    path, target = new_path(spark, "unload"), new_path(spark, "target")
    unload(lineitem(spark, sf_dir), path)
    load(spark, path, Directory(target), schema=_ddl(LINEITEM))
    return spark.read.parquet(target)


def _load_corrupt(spark, sf_dir):
    path, target, shared = (new_path(spark, p) for p in ("text", "target", "rejects"))
    lines = corrupt_lineitem(spark, sf_dir)
    lines.write.text(path)
    opts = LoadOptions(max_errors=lines.count() + 1, rejects_path=shared)
    load(spark, path, Directory(target), opts, schema=_ddl(LINEITEM))
    return target, shared


def load_with_budget(spark, sf_dir):
    target, _ = _load_corrupt(spark, sf_dir)
    return spark.read.parquet(target)


def rejected_rows(spark, sf_dir):
    _, shared = _load_corrupt(spark, sf_dir)
    return spark.read.schema("raw string, column string, reason string").json(
        f"{shared}/rejects"
    ).select("raw", "column", "reason")


def rejects_by_file(spark, sf_dir):
    """Rejects of two folders of files; each tells its file, where the task's block began, and the partition."""
    path, target, shared = new_path(spark, "text"), new_path(spark, "target"), new_path(spark, "rejects")
    lines = corrupt_lineitem(spark, sf_dir)
    is_first = F.substring_index("value", ",", 1).try_cast("bigint") % 2 == 0
    lines.where(F.coalesce(is_first, F.lit(True))).write.text(f"{path}/first")
    lines.where(~F.coalesce(is_first, F.lit(True))).write.text(f"{path}/second")
    opts = LoadOptions(max_errors=lines.count() + 1, rejects_path=shared)
    load(spark, f"{path}/*", Directory(target), opts, schema=_ddl(LINEITEM))
    rejects = spark.read.schema(
        "reason string, _source_file string, _source_block bigint, _source_partition int"
    ).json(f"{shared}/rejects")
    folder = F.element_at(F.split("_source_file", "/"), -2)
    return rejects.groupBy(folder.alias("folder"), "reason").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("_source_block").alias("first_block"),
        F.bool_and(F.col("_source_partition") >= 0).alias("has_partition"))


def load_summary(spark, sf_dir):
    _, shared = _load_corrupt(spark, sf_dir)
    log = spark.read.schema(
        "rows_read bigint, rows_loaded bigint, rows_rejected bigint, aborted boolean,"
        " by_reason map<string, bigint>"
    ).json(f"{shared}/summary")
    reasons = ("invalid_decimal", "invalid_integer", "invalid_timestamp")
    return log.select(
        "rows_read", "rows_loaded", "rows_rejected", "aborted",
        *[F.col("by_reason")[r].alias(r) for r in reasons],
    )


def bulk_load_append(spark, sf_dir):
    path, target = new_path(spark, "text"), new_path(spark, "target")
    rows = orders(spark, sf_dir)
    rows.write.parquet(target)
    again = rows.withColumn("o_orderkey", -F.col("o_orderkey"))
    unload(again, path)
    load(spark, path, Directory(target), schema=rows.schema)
    return spark.read.parquet(target)


def update_customers(spark, sf_dir):
    last_orders = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
        "o_orderdate", "o_orderkey",
    )
    return update_by_key(
        read(spark, sf_dir, "customer"), last_orders, ["c_custkey"],
        order_by=["o_orderdate", "o_orderkey"],
    )


def published_load(spark, sf_dir):
    """Two loads by their ids; the first is repeated, which adds nothing."""
    target = Published(new_path(spark, "published"))
    rows = orders(spark, sf_dir)
    parts = {"day-1": rows.where("o_orderkey % 2 = 0"), "day-2": rows.where("o_orderkey % 2 = 1")}
    for load_id in ("day-1", "day-2", "day-1"):
        path = new_path(spark, "text")
        unload(parts[load_id], path)
        load(spark, path, target, schema=rows.schema, load_id=load_id)
    return target.read(spark, rows.schema)


def update_touched_files(spark, sf_dir):
    """Customers in 16 files by key; the changes are about the first third of the keys."""
    path = new_path(spark, "files")
    customers = read(spark, sf_dir, "customer")
    customers.repartitionByRange(16, "c_custkey").write.parquet(path)
    (most,) = customers.agg(F.max("c_custkey")).first()
    changes = read(spark, sf_dir, "orders").where(F.col("o_custkey") * 3 <= most).select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"),
        "o_orderdate", "o_orderkey")
    update_files(spark, path, changes, ["c_custkey"], order_by=["o_orderdate", "o_orderkey"])
    return spark.read.parquet(path)


def update_hot_keys(spark, sf_dir):
    items = lineitem(spark, sf_dir)
    changes = items.groupBy("l_returnflag", "l_linestatus").agg(
        F.max("l_shipdate").alias("l_shipdate")
    )
    return update_by_key(items, changes, ["l_returnflag", "l_linestatus"])


def round_trip_styles(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderstatus") == "O", F.col("o_orderpriority") == "5-LOW").alias("is_open"),
    )
    lines = encode(rows, UnloadOptions(bool_style="T_F"))
    return accepted(decode(lines, rows.schema, LoadOptions(bool_style="T_F")), rows.schema)


LOADS = [
    decode_fields, decode_nulls, decode_bool, decode_typed, decode_typed_rejects, decode_utf8,
    decode_time,
    truncate_varchar, decode_arity, ctrlchars_policy, text_load, record_export,
    utf8_roundtrip, escaped_newline_load, load_lineitem, load_with_budget, rejected_rows, rejects_by_file,
    load_summary, bulk_load_append,
    published_load, update_touched_files, update_customers, update_hot_keys, round_trip_styles,
]

_ORDERS = """o_orderkey, o_custkey, o_orderstatus,
    CAST(o_totalprice AS DECIMAL(18,4)) AS o_totalprice, o_orderdate, o_orderpriority"""

_DECIMALS = """CAST(l_quantity AS DECIMAL(18,4)) AS l_quantity,
    CAST(l_extendedprice AS DECIMAL(18,4)) AS l_extendedprice,
    CAST(l_discount AS DECIMAL(18,4)) AS l_discount, CAST(l_tax AS DECIMAL(18,4)) AS l_tax"""

_GOOD_LINES = f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_DECIMALS},
           l_returnflag, l_linestatus, l_shipdate
    FROM lineitem WHERE (l_orderkey + l_linenumber) % 100 <> 0"""

_BAD_LINES = r"""
    SELECT concat_ws(',', CASE WHEN pick = 0 THEN ' ' ELSE '' END || l_orderkey,
            l_partkey, l_suppkey, l_linenumber,
            CASE WHEN pick = 100 THEN 'many' ELSE CAST(CAST(l_quantity AS DECIMAL(18,4)) AS VARCHAR) END,
            CAST(l_extendedprice AS DECIMAL(18,4)),
            CAST(l_discount AS DECIMAL(18,4)) || CASE WHEN pick = 200 THEN '1' ELSE '' END,
            CAST(l_tax AS DECIMAL(18,4)), l_returnflag, l_linestatus,
            CASE WHEN pick = 300 THEN strftime(l_shipdate, '%Y-%m-%d')
                 ELSE CAST(l_shipdate AS VARCHAR) END) AS raw,
        CASE pick WHEN 0 THEN 'l_orderkey' WHEN 100 THEN 'l_quantity'
                  WHEN 200 THEN 'l_discount' ELSE 'l_shipdate' END AS "column",
        CASE pick WHEN 0 THEN 'invalid_integer' WHEN 300 THEN 'invalid_timestamp'
                  ELSE 'invalid_decimal' END AS reason
    FROM (SELECT *, (l_orderkey + l_linenumber) % 400 AS pick FROM lineitem)
    WHERE pick % 100 = 0"""

LOAD_SQL = {
    "decode_fields": r"""
        SELECT doc_id, replace(text, 'a', '\') AS text, lang, source, n_chars FROM documents""",
    "decode_nulls": r"""
        SELECT c_custkey,
            CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '\N' ELSE c_name END AS c_name,
            CASE WHEN c_custkey % 7 > 1 THEN c_nationkey END AS c_nationkey,
            CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment
        FROM customer""",
    "decode_bool": r"""
        SELECT o_orderkey,
            CASE o_orderkey % 5 WHEN 0 THEN true WHEN 1 THEN false END AS flag,
            CASE WHEN o_orderkey % 5 IN (2, 3) THEN 'invalid_boolean' END AS reason
        FROM orders""",
    "decode_typed": _GOOD_LINES,
    "decode_typed_rejects": _BAD_LINES,
    "decode_utf8": r"""
        SELECT c_custkey,
            CASE WHEN c_custkey % 9 >= 5 THEN c_name || CASE c_custkey % 9 WHEN 5 THEN 'é' WHEN 6 THEN '😀' ELSE '' END
            END AS c_name,
            CASE WHEN c_custkey % 9 < 5 THEN 'invalid_utf8' END AS reason
        FROM customer""",
    "decode_time": r"""
        SELECT event_id,
            CASE WHEN event_id % 10 <> 0 THEN strftime(ts, '%H:%M:%S') END AS at,
            CAST(ts AS DATE) AS day,
            CASE WHEN event_id % 10 = 0 THEN 'invalid_time' END AS reason
        FROM events""",
    "truncate_varchar": r"""
        SELECT p_partkey, left(p_name, 8) AS p_name, p_type,
               rpad(left(p_brand, 12), 12, ' ') AS p_brand FROM part""",
    "decode_arity": r"""
        SELECT o_orderkey || ',' || o_orderstatus ||
            CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN ',x,y' WHEN 2 THEN ',x\,y'
                 WHEN 3 THEN ',x\' WHEN 4 THEN ',x\\' ELSE ',' END AS raw,
            CASE o_orderkey % 6 WHEN 0 THEN 'field_count' WHEN 1 THEN 'field_count'
                 WHEN 3 THEN 'dangling_escape' END AS reason,
            CASE o_orderkey % 6 WHEN 2 THEN 'x,y' WHEN 4 THEN 'x\' WHEN 5 THEN '' END AS note
        FROM orders""",
    "ctrlchars_policy": r"""
        SELECT event_id, flag,
            CASE WHEN event_id % 4 = 2 THEN 'line_end'
                 WHEN event_id % 4 < 2 AND flag = 'off' THEN 'control_character' END AS reason
        FROM events, (VALUES ('off'), ('on')) AS f(flag)""",
    "text_load": f"SELECT {_ORDERS} FROM orders",
    "record_export": """
        SELECT p_partkey, p_name, p_type, p_size,
               CAST(p_retailprice AS DECIMAL(18,4)) AS p_retailprice FROM part""",
    "utf8_roundtrip": "SELECT * FROM documents",
    "escaped_newline_load": r"""
        SELECT doc_id, text || CASE doc_id % 3 WHEN 0 THEN chr(10) || '\'
                   WHEN 1 THEN '\' || chr(10) || chr(13) || chr(10) ELSE '' END AS text,
               lang, source, n_chars FROM documents""",
    "load_lineitem": f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_DECIMALS},
               l_returnflag, l_linestatus, l_shipdate FROM lineitem""",
    "load_with_budget": _GOOD_LINES,
    "rejected_rows": _BAD_LINES,
    "rejects_by_file": r"""
        SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'first' ELSE 'second' END AS folder,
               CASE pick WHEN 0 THEN 'invalid_integer' WHEN 300 THEN 'invalid_timestamp'
                    ELSE 'invalid_decimal' END AS reason,
               count(*) AS row_count, CAST(0 AS BIGINT) AS first_block, true AS has_partition
        FROM (SELECT *, (l_orderkey + l_linenumber) % 400 AS pick FROM lineitem)
        WHERE pick % 100 = 0 GROUP BY 1, 2""",
    "load_summary": r"""
        SELECT count(*) AS rows_read, count(*) FILTER (pick % 100 <> 0) AS rows_loaded,
               count(*) FILTER (pick % 100 = 0) AS rows_rejected, false AS aborted,
               count(*) FILTER (pick IN (100, 200)) AS invalid_decimal,
               count(*) FILTER (pick = 0) AS invalid_integer,
               count(*) FILTER (pick = 300) AS invalid_timestamp
        FROM (SELECT (l_orderkey + l_linenumber) % 400 AS pick FROM lineitem)""",
    "bulk_load_append": f"""
        SELECT {_ORDERS} FROM orders
        UNION ALL SELECT {_ORDERS.replace("o_orderkey,", "-o_orderkey AS o_orderkey,", 1)}
        FROM orders""",
    "update_customers": r"""
        WITH last AS (
            SELECT *, row_number() OVER (
                PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
            FROM orders)
        SELECT c_custkey, c_name, c_nationkey,
            CASE WHEN o_custkey IS NULL THEN c_acctbal
                 WHEN o_orderstatus <> 'F' THEN o_totalprice END AS c_acctbal,
            CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE o_orderpriority END AS c_mktsegment
        FROM customer LEFT JOIN last ON o_custkey = c_custkey AND rn = 1""",
    "published_load": f"SELECT {_ORDERS} FROM orders",
    "update_touched_files": r"""
        WITH last AS (
            SELECT *, row_number() OVER (
                PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
            FROM orders WHERE o_custkey * 3 <= (SELECT max(c_custkey) FROM customer))
        SELECT c_custkey, c_name, c_nationkey,
            CASE WHEN o_custkey IS NULL THEN c_acctbal ELSE o_totalprice END AS c_acctbal, c_mktsegment
        FROM customer LEFT JOIN last ON o_custkey = c_custkey AND rn = 1""",
    "update_hot_keys": f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_DECIMALS},
            l_returnflag, l_linestatus,
            max(l_shipdate) OVER (PARTITION BY l_returnflag, l_linestatus) AS l_shipdate
        FROM lineitem""",
    "round_trip_styles": r"""
        SELECT o_orderkey,
            CASE WHEN (o_orderstatus = 'O') = (o_orderpriority = '5-LOW') THEN NULL
                 ELSE o_orderstatus = 'O' END AS is_open
        FROM orders""",
}
