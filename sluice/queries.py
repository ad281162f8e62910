"""One query per operator over the given tables, each with the SQL that must give the same rows.

A query takes (spark, folder of the tables) and returns a DataFrame. Queries that write a target do so
in a new folder below the shared folder and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluice.errors import LoadAborted, LoadPlanError
from sluice.functions import conform as C, epoch
from sluice.operators.address import addressed
from sluice.operators.mapping import map_by_name, map_by_position
from sluice.operators.rejects import null_flags, passthrough, split_rejects, validate
from sluice.operators.sequence import add_sequence
from sluice.operators.shape import (
    FieldMeta,
    abort_after,
    add_random_fields,
    generate_rows,
    replace_formula,
    replace_where,
    route,
    route_merge,
    set_meta,
)
from sluice.plans.load import check_load, load
from sluice.plans.spec import LoadSpec, TargetColumn as Col
from sluice.sources.control import CONTROL_SCHEMA, spec_from_control_table
from sluice.sources.native import NativeTarget, encode_rows, published_rows
from sluice.sources.native_read import read_native
from sluice.sources.target import PathTarget, TableTarget, columns_from_table, create_target
from sluice.sources.workspace import new_folder
from sluice.streaming.stream import NativeStreamTarget, StreamTarget, TableStreamTarget, stream_load

LONG, DOUBLE, TEXT, WALL = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Register a query under its function's name, without a trailing underscore."""

    def register(run):
        name = run.__name__.rstrip("_")
        QUERIES[name] = run
        ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# SQL pieces shared by the oracles

INT_GUARD = r"'^\s*[+-]?\d+\s*$'"
NUMBER_GUARD = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"


def sql_integer(text: str) -> str:
    return f"CASE WHEN regexp_matches({text}, {INT_GUARD}) THEN TRY_CAST({text} AS BIGINT) END"


def sql_number(text: str, kind: str) -> str:
    return f"CASE WHEN regexp_matches({text}, {NUMBER_GUARD}) THEN TRY_CAST({text} AS {kind}) END"


def sql_bytes(text: str) -> str:
    return f"octet_length(encode({text}))"


def sql_little_endian(number: str, size: int = 8) -> str:
    """Hex of an integer, lowest byte first."""
    digits = f"lpad(to_hex(CAST({number} AS BIGINT)), 16, '0')"
    return "concat(" + ", ".join(f"substr({digits}, {15 - 2 * i}, 2)" for i in range(size)) + ")"


def sql_wire_text(text: str) -> str:
    return f"concat({sql_little_endian(sql_bytes(text), 4)}, hex(encode({text})))"


# A. mapping

CUSTOMER_COLUMNS = (
    Col("id", "INTEGER"), Col("full_name", "VARCHAR", 25), Col("nation", "INTEGER"),
    Col("balance", "FLOAT"), Col("segment", "VARCHAR", 10), Col("note", "VARCHAR", 40),
)


@query("SELECT c_custkey AS id, c_name AS full_name, c_nationkey AS nation, c_acctbal AS balance, "
       "c_mktsegment AS segment FROM customer")
def map_by_position_(spark, folder):
    return map_by_position(table(spark, folder, "customer"), CUSTOMER_COLUMNS)


@query("SELECT l_orderkey AS order_id, l_extendedprice AS price, l_extendedprice AS list_price, "
       "l_returnflag AS flag FROM lineitem")
def map_by_name_(spark, folder):
    columns = (Col("order_id", "INTEGER"), Col("price", "FLOAT"), Col("list_price", "FLOAT"), Col("flag", "CHAR", 1),
               Col("not_mapped", "DATE"))
    pairs = [("l_orderkey", "order_id"), ("l_extendedprice", "price"), ("l_extendedprice", "list_price"),
             ("l_returnflag", "flag")]
    return map_by_name(table(spark, folder, "lineitem"), columns, pairs)


DOCUMENT_SPEC = LoadSpec(
    columns=(Col("id", "INTEGER"), Col("body", "VARCHAR", 1000), Col("origin", "VARCHAR", 5)),
    fields=(("doc_id", "id"), ("text", "body"), ("source", "origin")),
    abort_on_error=False,
)
DOCUMENT_BAD = f"{sql_bytes('text')} > 1000"


@query(f"SELECT doc_id, text, lang, source, n_chars FROM documents WHERE NOT ({DOCUMENT_BAD})")
def passthrough_accepted(spark, folder):
    return passthrough(table(spark, folder, "documents"), DOCUMENT_SPEC)


@query("SELECT o_orderkey AS id, substr(o_orderpriority, 1, 1) AS priority, o_custkey AS customer FROM orders")
def map_control_table(spark, folder):
    entries = [("orders", "TABLENAME", None, "daily_orders"), ("orders", "ABORTONERROR", None, "N")]
    streams = ["o_orderkey", "priority_digit", "o_custkey"]
    targets = ["id", "priority", "customer"]
    entries += [("orders", "FIELDSTREAM", 10 * i, s) for i, s in enumerate(streams)]
    entries += [("orders", "FIELDDATABASE", 10 * i, t) for i, t in enumerate(targets)]
    entries = [entries[i] for i in (6, 2, 0, 7, 4, 1, 5, 3)]  # their positions count, not their order
    columns = (Col("id", "INTEGER"), Col("customer", "INTEGER"), Col("priority", "CHAR", 1))
    spec = spec_from_control_table(spark.createDataFrame(entries, CONTROL_SCHEMA), "orders", columns)
    orders = table(spark, folder, "orders").withColumn("priority_digit", F.substring("o_orderpriority", 1, 1))
    return validate(orders, spec, passthrough=False).loaded


# B. conversions

@query(f"SELECT c_custkey, {sql_integer('substr(c_name, 10)')} AS from_name, "
       f"{sql_integer('c_mktsegment')} AS from_segment, "
       f"{sql_integer(chr(39) + '  +' + chr(39) + ' || c_custkey || ' + chr(39) + ' ' + chr(39))} AS from_signed, "
       f"{sql_integer('c_custkey || ' + chr(39) + '99999999999999999' + chr(39))} AS from_long FROM customer")
def conform_integer_text(spark, folder):
    key = F.col("c_custkey").cast("string")
    return table(spark, folder, "customer").select(
        "c_custkey",
        C.to_integer(F.substring("c_name", 10, 100), TEXT).alias("from_name"),
        C.to_integer(F.col("c_mktsegment"), TEXT).alias("from_segment"),
        C.to_integer(F.concat(F.lit("  +"), key, F.lit(" ")), TEXT).alias("from_signed"),
        C.to_integer(F.concat(key, F.lit("99999999999999999")), TEXT).alias("from_long"),
    )


@query("SELECT l_orderkey, CAST(floor(l_extendedprice + 0.5) AS BIGINT) AS price, "
       "CAST(floor(l_discount * -10 + 0.5) AS BIGINT) AS discount, "
       "CASE WHEN l_quantity * 1e18 < 9223372036854775807 THEN CAST(l_quantity * 1e18 AS BIGINT) END AS huge, "
       "CAST(floor(CAST(l_tax * 10 AS DECIMAL(10,2)) + 0.5) AS BIGINT) AS tax FROM lineitem")
def conform_integer_fraction(spark, folder):
    tax = (F.col("l_tax") * 10).cast("decimal(10,2)")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        C.to_integer(F.col("l_extendedprice"), DOUBLE).alias("price"),
        C.to_integer(F.col("l_discount") * -10, DOUBLE).alias("discount"),
        C.to_integer(F.col("l_quantity") * 1e18, DOUBLE).alias("huge"),
        C.to_integer(tax, T.DecimalType(10, 2)).alias("tax"),
    )


@query("SELECT l_orderkey, CAST(CASE WHEN l_orderkey <= 32767 THEN l_orderkey END AS BIGINT) AS two_bytes, "
       "CAST(CASE WHEN l_partkey <= 127 THEN l_partkey END AS BIGINT) AS one_byte, "
       "CAST(CASE WHEN l_orderkey * 1000000 <= 2147483647 THEN l_orderkey * 1000000 END AS BIGINT) AS four_bytes "
       "FROM lineitem")
def conform_integer_narrow(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        C.to_integer_n(F.col("l_orderkey"), LONG, 2).cast("bigint").alias("two_bytes"),
        C.to_integer_n(F.col("l_partkey"), LONG, 1).cast("bigint").alias("one_byte"),
        C.to_integer_n(F.col("l_orderkey") * 1000000, LONG, 4).cast("bigint").alias("four_bytes"),
    )


@query("SELECT doc_id, quality <> 0 AS good, TRY_CAST(CASE toxic WHEN 1 THEN 'Yes' ELSE 'f' END AS BOOLEAN) AS toxic, "
       "TRY_CAST('q' || quality AS BOOLEAN) AS unknown FROM labels")
def conform_boolean(spark, folder):
    word = F.when(F.col("toxic") == 1, "Yes").otherwise("f")
    return table(spark, folder, "labels").select(
        "doc_id",
        C.to_boolean(F.col("quality"), T.IntegerType()).alias("good"),
        C.to_boolean(word, TEXT).alias("toxic"),
        C.to_boolean(F.concat(F.lit("q"), F.col("quality").cast("string")), TEXT).alias("unknown"),
    )


@query(f"SELECT p_partkey, {sql_number(chr(39) + ' ' + chr(39) + ' || p_size || ' + chr(39) + '.25 ' + chr(39), 'DOUBLE')} "
       f"AS from_text, {sql_number('p_size || ' + chr(39) + 'e-2' + chr(39), 'DOUBLE')} AS from_exponent, "
       "CASE WHEN p_size < 40 THEN CAST(p_size || 'e300' AS DOUBLE) END AS from_large, "
       f"{sql_number('p_name', 'DOUBLE')} AS from_name, CAST(p_size AS DOUBLE) AS from_integer FROM part")
def conform_float(spark, folder):
    size = F.col("p_size").cast("string")
    return table(spark, folder, "part").select(
        "p_partkey",
        C.to_float(F.concat(F.lit(" "), size, F.lit(".25 ")), TEXT).alias("from_text"),
        C.to_float(F.concat(size, F.lit("e-2")), TEXT).alias("from_exponent"),
        C.to_float(F.concat(size, F.when(F.col("p_size") < 40, "e300").otherwise("e400")), TEXT).alias("from_large"),
        C.to_float(F.col("p_name"), TEXT).alias("from_name"),
        C.to_float(F.col("p_size"), T.IntegerType()).alias("from_integer"),
    )


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS price, "
       "CAST(TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS VARCHAR) AS short_price, "
       "CAST(CAST(o_totalprice AS DECIMAL(10,1)) AS VARCHAR) AS rounded, "
       f"CAST({sql_number('o_orderkey || ' + chr(39) + '.675' + chr(39), 'DECIMAL(10,2)')} AS VARCHAR) AS from_text, "
       f"CAST({sql_number('o_orderpriority', 'DECIMAL(10,2)')} AS VARCHAR) AS from_priority FROM orders")
def conform_numeric(spark, folder):
    price = F.col("o_totalprice")
    keyed = F.concat(F.col("o_orderkey").cast("string"), F.lit(".675"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        C.to_numeric(price, DOUBLE, 10, 2).cast("string").alias("price"),
        C.to_numeric(price, DOUBLE, 7, 2).cast("string").alias("short_price"),
        C.to_numeric(price, DOUBLE, 10, 1).cast("string").alias("rounded"),
        C.to_numeric(keyed, TEXT, 10, 2).cast("string").alias("from_text"),
        C.to_numeric(F.col("o_orderpriority"), TEXT, 10, 2).cast("string").alias("from_priority"),
    )


def sql_padded(value: str, length: int) -> str:
    return f"CASE WHEN {sql_bytes(value)} <= {length} THEN concat({value}, repeat(' ', {length} - {sql_bytes(value)})) END"


@query(f"SELECT doc_id, {sql_padded('lang', 2)} AS lang, {sql_padded('source', 5)} AS source, {sql_padded('text', 4000)} AS body, "
       f"CASE WHEN {sql_bytes('text')} <= 4000 THEN CAST(4000 AS BIGINT) END AS body_bytes FROM documents")
def conform_char(spark, folder):
    padded = table(spark, folder, "documents").select(
        "doc_id", C.to_char(F.col("lang"), TEXT, 2).alias("lang"), C.to_char(F.col("source"), TEXT, 5).alias("source"),
        C.to_char(F.col("text"), TEXT, 4000).alias("body"))
    return padded.withColumn("body_bytes", F.octet_length("body").cast("bigint"))


@query(f"SELECT doc_id, CASE WHEN {sql_bytes('text')} <= 1500 THEN text END AS body, "
       f"CAST(n_chars AS VARCHAR) AS chars FROM documents")
def conform_varchar(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        C.to_varchar(F.col("text"), TEXT, 1500).alias("body"),
        C.to_varchar(F.col("n_chars"), LONG, 20).alias("chars"),
    )


@query(f"SELECT doc_id, md5(text) AS digest, CASE WHEN {sql_bytes('text')} <= 800 THEN hex(encode(text)) END AS body, "
       f"hex(encode(lang)) AS lang FROM documents")
def conform_varbinary(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        F.md5(C.to_varbinary(F.col("text"), TEXT)).alias("digest"),
        F.hex(C.to_varbinary(F.col("text"), TEXT, 800)).alias("body"),
        F.hex(C.to_varbinary(F.col("lang"), TEXT, 4)).alias("lang"),
    )


@query("SELECT o_orderkey, CASE WHEN octet_length(encode(o_orderpriority)) <= 8 THEN "
       "rpad(hex(encode(o_orderpriority)), 16, '0') END AS priority FROM orders")
def conform_binary(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", F.hex(C.to_binary(F.col("o_orderpriority"), TEXT, 8)).alias("priority")
    )


NEW_YORK = "America/New_York"  # all events fall in January, five hours behind UTC
EVENT_MS = "epoch_us(ts) // 1000 * 1000"


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS wall, "
       "epoch_us(ts) // 1000 * 1000 + 18000000000 AS instant, "
       "strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d') AS new_york_day, "
       "strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S.%g') AS new_york_wall FROM events")
def conform_dates(spark, folder):
    events = table(spark, folder, "events")
    ts, instant = F.col("ts"), F.timestamp_micros(epoch.wall_micros(F.col("ts"), WALL))
    layout = "yyyy-MM-dd HH:mm:ss.SSS"
    return events.select(
        "event_id",
        C.to_date(ts, WALL).cast("string").alias("day"),
        F.date_format(C.to_timestamp(ts, WALL), layout).alias("wall"),
        F.unix_micros(C.to_timestamptz(ts, WALL, NEW_YORK)).alias("instant"),
        C.to_date(instant, T.TimestampType(), NEW_YORK).cast("string").alias("new_york_day"),
        F.date_format(C.to_timestamp(instant, T.TimestampType(), NEW_YORK), layout).alias("new_york_wall"),
    )


GUARDED = (("embeddings", "embedding", "FLOAT"), ("embeddings", "vec_id", "DATE"), ("embeddings", "vec_id", "INTEGER"),
           ("events", "event_id", "TIMESTAMP"), ("events", "props", "TIME"), ("events", "ts", "INTEGER"), ("events", "ts", "TIMETZ"),
           ("events", "value", "INTERVAL"), ("events", "value", "VARCHAR"))
GUARD_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{f}' AS field, '{kind}' AS target, {taken} AS accepted, count(*) AS rows, "
    f"count({f}) FILTER ({taken}) AS loaded FROM {t}"
    for (t, f, kind), taken in zip(GUARDED, ("false", "false", "true", "false", "false", "false", "true", "false", "true")))


@query(GUARD_SQL)
def type_guard(spark, folder):
    """Pairs of a field and a target type: refused before any job, or loaded in full."""
    out = None
    for name, f, kind in GUARDED:
        rows = table(spark, folder, name).select(f)
        try:
            loaded = validate(rows, LoadSpec((Col(f, kind),)), passthrough=False).checked.select(F.col("__load_0").alias("value"))
            accepted = True
        except LoadPlanError:
            loaded, accepted = rows.select(F.lit(None).cast("string").alias("value")), False
        counted = loaded.agg(F.count(F.lit(1)).alias("rows"), F.count("value").alias("loaded")).select(
            F.lit(name).alias("table_name"), F.lit(f).alias("field"), F.lit(kind).alias("target"), F.lit(accepted).alias("accepted"),
            "rows", "loaded")
        out = counted if out is None else out.union(counted)
    return out


# C. encodings

@query("SELECT o_orderkey, date_diff('day', DATE '2000-01-01', CAST(o_orderdate AS DATE)) AS days FROM orders")
def encode_date(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", epoch.encode_date(F.col("o_orderdate"), WALL).alias("days")
    )


@query(f"SELECT event_id, {EVENT_MS} - 946684800000000 AS millis, epoch_us(ts) - 946684800000000 AS micros FROM events")
def encode_timestamp(spark, folder):
    ts = F.col("ts")
    return table(spark, folder, "events").select(
        "event_id",
        epoch.encode_timestamp(ts, WALL).alias("millis"),
        epoch.encode_timestamp(ts, WALL, precision="micros").alias("micros"),
    )


@query(f"SELECT event_id, {EVENT_MS} - 946684800000000 AS utc, "
       f"{EVENT_MS} + 18000000000 - 946684800000000 AS new_york FROM events")
def encode_timestamptz(spark, folder):
    ts = F.col("ts")
    return table(spark, folder, "events").select(
        "event_id",
        epoch.encode_timestamptz(ts, WALL).alias("utc"),
        epoch.encode_timestamptz(ts, WALL, NEW_YORK).alias("new_york"),
    )


@query(f"SELECT event_id, ({EVENT_MS}) % 86400000000 AS clock FROM events")
def encode_time(spark, folder):
    return table(spark, folder, "events").select("event_id", epoch.encode_time(F.col("ts"), WALL).alias("clock"))


@query(f"SELECT event_id, (({EVENT_MS}) % 86400000000) * 16777216 + 86400 AS utc, "
       f"(({EVENT_MS} + 18000000000) % 86400000000) * 16777216 + 86400 AS new_york FROM events")
def encode_timetz(spark, folder):
    ts = F.col("ts")
    return table(spark, folder, "events").select(
        "event_id",
        epoch.encode_timetz(ts, WALL).alias("utc"),
        epoch.encode_timetz(ts, WALL, NEW_YORK).alias("new_york"),
    )


@query("SELECT event_id, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 00:00:00') AS since, user_id AS plain FROM events")
def encode_interval(spark, folder):
    since = F.col("ts") - F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    return table(spark, folder, "events").select(
        "event_id",
        C.to_interval(since, T.DayTimeIntervalType()).alias("since"),
        C.to_interval(F.col("user_id"), LONG).alias("plain"),
    )


# D. rejects

REASONS_SPEC = LoadSpec(
    columns=(Col("id", "INTEGER", width=2), Col("code", "INTEGER"), Col("body", "VARCHAR", 1000),
             Col("origin", "CHAR", 4)),
    fields=(("doc_id", "id"), ("code", "code"), ("text", "body"), ("source", "origin")),
    abort_on_error=False,
)
CODE = "CASE WHEN lang = 'en' THEN '12' WHEN lang = 'fr' THEN 'x1' WHEN doc_id % 7 <> 0 THEN ' 3' END"
REASON = (
    "CASE WHEN doc_id > 32767 THEN 'id: not a INTEGER(2 bytes)' "
    f"WHEN {CODE} IS NOT NULL AND {sql_integer(CODE)} IS NULL THEN 'code: not a INTEGER' "
    f"WHEN {DOCUMENT_BAD} THEN 'body: longer than 1000 bytes' "
    f"WHEN {sql_bytes('source')} > 4 THEN 'origin: longer than 4 bytes' END"
)
REASON_COLUMN = f"split_part({REASON}, ':', 1)"


def coded_documents(spark, folder):
    return table(spark, folder, "documents").withColumn("code", F.expr(CODE))


@query(f"SELECT doc_id, {REASON} AS reject_reason FROM documents")
def validate_reasons(spark, folder):
    return validate(coded_documents(spark, folder), REASONS_SPEC).all_rows.select("doc_id", "reject_reason")


@query(f"SELECT doc_id, doc_id || ' | ' || text || ' | ' || lang || ' | ' || source || ' | ' || n_chars || ' | ' || "
       f"coalesce({CODE}, 'null') AS rejected_line, {REASON} AS reject_reason FROM documents WHERE {REASON} IS NOT NULL")
def reject_rows(spark, folder):
    _, rejected = split_rejects(coded_documents(spark, folder), REASONS_SPEC)
    return rejected.select("doc_id", "rejected_line", "reject_reason")


@query(f'SELECT {REASON_COLUMN} AS "column", '
       f"CASE {REASON_COLUMN} WHEN 'id' THEN 'INTEGER(2 bytes)' WHEN 'code' THEN 'INTEGER' "
       f"WHEN 'body' THEN 'VARCHAR(1000)' ELSE 'CHAR(4)' END AS target_type, "
       f"CASE {REASON_COLUMN} WHEN 'id' THEN CAST(doc_id AS VARCHAR) WHEN 'code' THEN {CODE} "
       f"WHEN 'body' THEN text ELSE source END AS \"value\", {REASON} AS reason FROM documents WHERE {REASON} IS NOT NULL")
def reject_exceptions(spark, folder):
    return validate(coded_documents(spark, folder), REASONS_SPEC).exceptions.drop("rejected_at")


@query(f'SELECT {REASON_COLUMN} AS "column", {REASON} AS reason, count(*) AS "rows" FROM documents '
       f"WHERE {REASON} IS NOT NULL GROUP BY 1, 2")
def reject_summary(spark, folder):
    return validate(coded_documents(spark, folder), REASONS_SPEC, passthrough=False).summary()


@query(f'WITH r AS (SELECT {REASON_COLUMN} AS "column", {REASON} AS reason, '
       f"CASE {REASON_COLUMN} WHEN 'id' THEN CAST(doc_id AS VARCHAR) WHEN 'code' THEN {CODE} "
       f"WHEN 'body' THEN text ELSE source END AS \"value\" FROM documents WHERE {REASON} IS NOT NULL), "
       'c AS (SELECT "column", reason, "value", count(*) AS value_rows FROM r GROUP BY ALL), '
       'n AS (SELECT *, CAST(sum(value_rows) OVER (PARTITION BY "column") AS BIGINT) AS "rows", '
       'count(*) OVER (PARTITION BY "column") AS "values", CAST(row_number() OVER '
       '(PARTITION BY "column" ORDER BY value_rows DESC, "value") AS INTEGER) AS "rank" FROM c) '
       'SELECT "column", reason, "rows", "values", "rank", "value", value_rows FROM n WHERE "rank" <= 10')
def reject_profile(spark, folder):
    return validate(coded_documents(spark, folder), REASONS_SPEC, passthrough=False).profile()


def _report(spark, report, **more):
    counts = {"rows_read": report.rows_read, "rows_accepted": report.rows_accepted,
              "rows_rejected": report.rows_rejected, **more}
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} bigint" for k in counts))


@query(f"SELECT count(*) AS rows_read, count(*) FILTER ({REASON} IS NULL) AS rows_accepted, "
       f"count(*) FILTER ({REASON} IS NOT NULL) AS rows_rejected, count(*) FILTER ({REASON} IS NULL) AS rows_in_target, "
       f"count(*) FILTER ({REASON} IS NOT NULL) AS rows_in_reject_log, "
       f"count(*) FILTER ({REASON} IS NOT NULL) AS rows_in_exception_log FROM documents")
def load_report(spark, folder):
    out = new_folder(spark, "load-report")
    spec = REASONS_SPEC.with_options(rejected_path=f"{out}/rejected", exceptions_path=f"{out}/exceptions")
    report = load(coded_documents(spark, folder), spec, PathTarget(f"{out}/target", spec.columns))
    return _report(
        spark, report,
        rows_in_target=spark.read.parquet(f"{out}/target").count(),
        rows_in_reject_log=spark.read.parquet(f"{out}/rejected").count(),
        rows_in_exception_log=spark.read.parquet(f"{out}/exceptions").count(),
    )


@query(f"SELECT {REASON} AS reason, count(*) AS \"rows\", (SELECT count(*) FILTER ({REASON} IS NULL) FROM documents) AS rows_in_target "
       f"FROM documents WHERE {REASON} IS NOT NULL GROUP BY 1")
def load_reject_reasons(spark, folder):
    """Rejects by reason, as counted by the tasks that write rows and logs."""
    out = new_folder(spark, "load-reasons")
    spec = REASONS_SPEC.with_options(rejected_path=f"{out}/rejected", log_format="json")
    report = load(coded_documents(spark, folder), spec, PathTarget(f"{out}/target", spec.columns))
    counts = spark.createDataFrame(list(report.reasons.items()), "reason string, rows bigint")
    return counts.withColumn("rows_in_target", F.lit(spark.read.parquet(f"{out}/target").count()).cast("bigint"))


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def load_once(spark, folder):
    """A load that is repeated under its id, as after a lost driver: its rows are there once."""
    out = new_folder(spark, "load-once")
    columns = (Col("id", "INTEGER"), Col("name", "VARCHAR", 25), Col("balance", "FLOAT"))
    spec = LoadSpec(columns, (("c_custkey", "id"), ("c_name", "name"), ("c_acctbal", "balance")))
    for _ in range(2):
        load(table(spark, folder, "customer"), spec, PathTarget(out, columns), load_id="customers")
    return spark.read.parquet(out)


NULLED = ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax", "l_quantity", "l_suppkey",
          "l_partkey", "l_extendedprice"]
NULL_VALUES = {"l_returnflag": "'A'", "l_linestatus": "'O'", "l_linenumber": "3", "l_discount": "0.05", "l_tax": "0.02",
               "l_quantity": "10", "l_suppkey": "7", "l_partkey": "11", "l_extendedprice": "0"}


def sql_null_bits(start: int, end: int) -> str:
    return " + ".join(
        f"CASE WHEN {c} = {NULL_VALUES[c]} THEN {1 << (7 - i)} ELSE 0 END" for i, c in enumerate(NULLED[start:end])
    )


@query(f"SELECT l_orderkey, lpad(to_hex({sql_null_bits(0, 8)}), 2, '0') || lpad(to_hex({sql_null_bits(8, 9)}), 2, '0') "
       "AS flags FROM lineitem")
def null_flags_(spark, folder):
    values = [F.expr(f"nullif({c}, {NULL_VALUES[c]})") for c in NULLED]
    return table(spark, folder, "lineitem").select("l_orderkey", F.hex(null_flags(values)).alias("flags"))


@query(f"SELECT count(*) FILTER ({DOCUMENT_BAD}) > 0 AS aborted, "
       f"CASE WHEN count(*) FILTER ({DOCUMENT_BAD}) > 0 THEN 0 ELSE count(*) END AS rows_in_target, "
       f"count(*) FILTER ({DOCUMENT_BAD}) AS rows_in_reject_log FROM documents")
def abort_clean(spark, folder):
    out = new_folder(spark, "abort")
    spec = DOCUMENT_SPEC.with_options(abort_on_error=True, rejected_path=f"{out}/rejected")
    columns = T.StructType([T.StructField(c.name, c.spark_type) for c in spec.columns])
    aborted = False
    try:
        load(table(spark, folder, "documents"), spec, PathTarget(f"{out}/target", spec.columns))
    except LoadAborted:
        aborted = True
    loaded = spark.read.schema(columns).option("ignoreMissingFiles", "true").parquet(f"{out}/target").count()
    logged = spark.read.parquet(f"{out}/rejected").count() if aborted else 0
    return spark.createDataFrame(
        [(aborted, loaded, logged)], "aborted boolean, rows_in_target bigint, rows_in_reject_log bigint"
    )


@query(f"SELECT count(*) FILTER ({DOCUMENT_BAD}) > 0 AS aborted, "
       f"CASE WHEN count(*) FILTER ({DOCUMENT_BAD}) > 0 THEN 0 ELSE count(*) END AS rows_in_target, "
       f"CASE WHEN count(*) FILTER ({DOCUMENT_BAD}) > 0 THEN 1::BIGINT ELSE 0 END AS bad_rows_logged FROM documents")
def abort_first_row(spark, folder):
    """An abort that logs the row which failed, from the pass that met it."""
    out = new_folder(spark, "abort-first")
    spec = DOCUMENT_SPEC.with_options(abort_on_error=True, abort_log="first", rejected_path=f"{out}/rejected")
    aborted = False
    try:
        load(table(spark, folder, "documents"), spec, PathTarget(f"{out}/target", spec.columns))
    except LoadAborted:
        aborted = True
    loaded = 0 if aborted else spark.read.parquet(f"{out}/target").count()
    bad = 0
    if aborted:
        rejected = spark.read.parquet(f"{out}/rejected")
        bad = rejected.join(table(spark, folder, "documents").select("doc_id", "text"), ["doc_id", "text"]).count()
    return spark.createDataFrame([(aborted, loaded, bad)], "aborted boolean, rows_in_target bigint, bad_rows_logged bigint")


# E. sinks

LINEITEM_COLUMNS = (
    Col("order_id", "INTEGER"), Col("part_id", "INTEGER"), Col("supplier_id", "INTEGER"),
    Col("line", "INTEGER", width=4), Col("quantity", "FLOAT"), Col("price", "NUMERIC", 12, 2),
    Col("discount", "DOUBLE PRECISION"), Col("tax", "FLOAT"), Col("flag", "CHAR", 2), Col("status", "VARCHAR", 1),
    Col("shipped", "DATE"), Col("remark", "VARCHAR", 44),
)
LINEITEM_SPEC = LoadSpec(columns=LINEITEM_COLUMNS)
LINEITEM_SQL = (
    "SELECT l_orderkey AS order_id, l_partkey AS part_id, l_suppkey AS supplier_id, CAST(l_linenumber AS BIGINT) AS line, "
    "l_quantity AS quantity, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price, l_discount AS discount, "
    "l_tax AS tax, l_returnflag || ' ' AS flag, l_linestatus AS status, strftime(l_shipdate, '%Y-%m-%d') AS shipped, "
    "CAST(NULL AS VARCHAR) AS remark FROM lineitem"
)


def _plain(df: DataFrame) -> DataFrame:
    """Loaded lineitem rows in types that compare alike in every engine."""
    return df.withColumns({
        "line": F.col("line").cast("bigint"), "price": F.col("price").cast("string"),
        "shipped": F.col("shipped").cast("string"),
    })


@query(LINEITEM_SQL)
def load_table(spark, folder):
    out = new_folder(spark, "load")
    load(table(spark, folder, "lineitem"), LINEITEM_SPEC, PathTarget(out, LINEITEM_COLUMNS))
    return _plain(spark.read.parquet(out))


@query(LINEITEM_SQL)
def load_parallel(spark, folder):
    out = new_folder(spark, "load-parallel")
    load(table(spark, folder, "lineitem"), LINEITEM_SPEC, PathTarget(out, LINEITEM_COLUMNS), parallelism=8)
    return _plain(spark.read.parquet(out))


@query(LINEITEM_SQL)
def load_clustered(spark, folder):
    out = new_folder(spark, "load-clustered")
    load(table(spark, folder, "lineitem"), LINEITEM_SPEC, PathTarget(out, LINEITEM_COLUMNS), parallelism=8,
         cluster_by=["flag", "shipped"])
    return _plain(spark.read.parquet(out))


@query("SELECT c_custkey AS id, c_name AS full_name, CAST(c_nationkey AS BIGINT) AS nation, "
       "CAST(NULL AS VARCHAR) AS note FROM customer")
def create_target_(spark, folder):
    out = new_folder(spark, "created")
    name = "created_" + out.rsplit("-", 1)[1]
    columns = (Col("id", "INTEGER"), Col("full_name", "VARCHAR", 25), Col("nation", "INTEGER"), Col("note", "VARCHAR", 9))
    create_target(spark, name, columns, path=out)
    spec = LoadSpec(
        columns=columns_from_table(spark, name), table=name,
        fields=(("c_name", "full_name"), ("c_custkey", "id"), ("c_nationkey", "nation")),
    )
    load(table(spark, folder, "customer"), spec, TableTarget(name))
    return spark.table(name)


@query("SELECT c_custkey AS id, c_name || CASE WHEN c_nationkey < 12 THEN '' ELSE ' ' || c_mktsegment END AS full_name, "
       "CASE WHEN c_nationkey >= 12 THEN c_mktsegment END AS segment, CASE WHEN c_nationkey >= 12 THEN c_acctbal END AS balance FROM customer")
def evolve_target_(spark, folder):
    """Customers loaded into a table of two columns, and others once it has four."""
    out = new_folder(spark, "evolved")
    name = "evolved_" + out.rsplit("-", 1)[1]
    customers = table(spark, folder, "customer")
    first = (Col("id", "INTEGER"), Col("full_name", "VARCHAR", 40))
    create_target(spark, name, first, path=out)
    load(customers.where("c_nationkey < 12").select("c_custkey", "c_name"), LoadSpec(first), TableTarget(name))
    later = customers.where("c_nationkey >= 12").select(
        "c_custkey", F.concat_ws(" ", "c_name", "c_mktsegment"), "c_mktsegment", "c_acctbal")
    columns = (Col("id", "INTEGER"), Col("full_name", "VARCHAR", 40), Col("segment", "VARCHAR", 10), Col("balance", "FLOAT"))
    load(later, LoadSpec(columns), TableTarget(name), evolve=True)
    return spark.table(name)


@query("WITH n AS (SELECT l_linenumber AS line, count(*) AS rows, sum(l_orderkey) AS keys FROM lineitem GROUP BY l_linenumber), "
       "p AS (SELECT *, (rows + 3999) // 4000 AS parts FROM n) "
       "SELECT line, rows, CAST(keys AS BIGINT) AS keys, parts, CAST(sum(parts) OVER (ORDER BY line) - parts AS BIGINT) AS first_part FROM p")
def addressed_lines(spark, folder):
    """Order lines in partitions by line number, the frequent numbers in several; what each partition really holds."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linenumber") - 1).alias("id"))
    found = addressed(lines, "id", 7, most=4000).rows.groupBy(F.spark_partition_id().alias("part"), F.col("l_linenumber").alias("line")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("l_orderkey").alias("keys"))
    return found.groupBy("line").agg(F.sum("rows").alias("rows"), F.sum("keys").alias("keys"), F.count_distinct("part").alias("parts"),
                                     F.min("part").cast("bigint").alias("first_part"))


def sql_row(columns: list[tuple[str | None, str, str]]) -> str:
    """Hex of one native row from (NULL test, hex of the value, size of the value) per column."""
    flags = []
    for start in range(0, len(columns), 8):
        bits = [f"CASE WHEN {test} THEN {1 << (7 - i)} ELSE 0 END"
                for i, (test, _, _) in enumerate(columns[start:start + 8]) if test]
        flags.append(f"lpad(to_hex({' + '.join(bits) or '0'}), 2, '0')")
    sizes = [f"CASE WHEN {test} THEN 0 ELSE {size} END" if test else size for test, _, size in columns]
    values = [f"CASE WHEN {test} THEN '' ELSE {value} END" if test else value for test, value, _ in columns]
    return f"concat({sql_little_endian(' + '.join(sizes), 4)}, {', '.join(flags)}, {', '.join(values)})"


CUSTOMER_ROW = sql_row([
    (None, sql_little_endian("c_custkey"), "8"),
    (None, sql_wire_text("c_name"), f"4 + {sql_bytes('c_name')}"),
    (None, sql_little_endian("c_nationkey"), "8"),
])


@query(f"SELECT {CUSTOMER_ROW} AS row_hex FROM customer")
def native_row_hex(spark, folder):
    columns = (Col("id", "INTEGER"), Col("name", "VARCHAR", 25), Col("nation", "INTEGER"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    loaded = validate(customers, LoadSpec(columns=columns), passthrough=False).loaded
    return encode_rows(loaded, columns).select(F.hex("row_bytes").alias("row_hex"))


NATIVE_COLUMNS = (
    Col("order_id", "INTEGER"), Col("line", "INTEGER", width=2), Col("quantity", "FLOAT"),
    Col("price", "NUMERIC", 12, 2), Col("flag", "CHAR", 3), Col("status", "VARCHAR", 1), Col("shipped", "DATE"),
    Col("shipped_at", "TIMESTAMP"), Col("is_open", "BOOLEAN"), Col("raw", "VARBINARY", 8), Col("code", "BINARY", 4, fixed=True),
)
NATIVE_FIELDS = tuple(zip(
    ("l_orderkey", "line", "l_quantity", "l_extendedprice", "flag", "l_linestatus", "l_shipdate", "l_shipdate",
     "is_open", "l_returnflag", "l_returnflag"),
    (c.name for c in NATIVE_COLUMNS),
))
PRICE_TEXT = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)"
NATIVE_ROW = sql_row([
    (None, sql_little_endian("l_orderkey"), "8"),
    ("l_linenumber = 2", sql_little_endian("l_linenumber", 2), "2"),
    (None, sql_little_endian("l_quantity::DOUBLE::BIT::BIGINT"), "8"),
    (None, sql_wire_text(PRICE_TEXT), f"4 + {sql_bytes(PRICE_TEXT)}"),
    ("l_returnflag = 'R'", "rpad(hex(encode(l_returnflag)), 6, '20')", "3"),
    (None, sql_wire_text("l_linestatus"), "5"),
    (None, sql_little_endian("date_diff('day', DATE '2000-01-01', CAST(l_shipdate AS DATE))"), "8"),
    (None, sql_little_endian("epoch_us(l_shipdate) - 946684800000000"), "8"),
    ("l_linenumber = 3", "CASE WHEN l_linestatus = 'O' THEN '01' ELSE '00' END", "1"),
    (None, sql_wire_text("l_returnflag"), f"4 + {sql_bytes('l_returnflag')}"),
    (None, "rpad(hex(encode(l_returnflag)), 8, '0')", "4"),
])


def native_lineitem(spark, folder):
    return table(spark, folder, "lineitem").withColumns({
        "line": F.expr("nullif(l_linenumber, 2)"),
        "flag": F.expr("nullif(l_returnflag, 'R')"),
        "is_open": F.expr("if(l_linenumber = 3, null, l_linestatus = 'O')"),
    })


NATIVE_SPEC = LoadSpec(columns=NATIVE_COLUMNS, fields=NATIVE_FIELDS)


@query(f"SELECT {NATIVE_ROW} AS row_hex FROM lineitem")
def native_rows_lineitem(spark, folder):
    loaded = validate(native_lineitem(spark, folder), NATIVE_SPEC, passthrough=False).loaded
    return encode_rows(loaded, NATIVE_COLUMNS).select(F.hex("row_bytes").alias("row_hex"))


@query(f"SELECT md5({NATIVE_ROW}) AS row_digest, octet_length(encode({NATIVE_ROW})) // 2 AS row_bytes, "
       "count(*) OVER () AS rows_accepted FROM lineitem")
def native_export(spark, folder):
    """Every row as it stands in the files that the manifest names."""
    out = new_folder(spark, "native")
    report = load(native_lineitem(spark, folder), NATIVE_SPEC, NativeTarget(out, NATIVE_COLUMNS))
    return published_rows(spark, out, len(NATIVE_COLUMNS)).select(
        F.md5(F.hex("row_bytes").cast("binary")).alias("row_digest"), F.octet_length("row_bytes").cast("bigint").alias("row_bytes"),
        F.lit(report.rows_accepted).cast("bigint").alias("rows_accepted"))


@query("SELECT l_orderkey AS order_id, nullif(l_linenumber, 2)::BIGINT AS line, l_quantity AS quantity, "
       f"{PRICE_TEXT} AS price, CASE WHEN l_returnflag <> 'R' THEN rpad(l_returnflag, 3, ' ') END AS flag, l_linestatus AS status, "
       "strftime(l_shipdate, '%Y-%m-%d') AS shipped, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped_at, "
       "CASE WHEN l_linenumber <> 3 THEN l_linestatus = 'O' END AS is_open, hex(encode(l_returnflag)) AS raw, "
       "rpad(hex(encode(l_returnflag)), 8, '0') AS code FROM lineitem")
def native_read(spark, folder):
    """The values of every row of a native dataset, read back by ranges of bytes."""
    out = new_folder(spark, "native-read")
    load(native_lineitem(spark, folder), NATIVE_SPEC, NativeTarget(out, NATIVE_COLUMNS))
    return read_native(spark, out).withColumns({
        "line": F.col("line").cast("bigint"), "price": F.col("price").cast("string"), "shipped": F.col("shipped").cast("string"),
        "shipped_at": F.date_format("shipped_at", "yyyy-MM-dd HH:mm:ss"), "raw": F.hex("raw"), "code": F.hex("code")})


@query("SELECT l_linestatus AS status, count(*) AS line_count, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1")
def native_read_pruned(spark, folder):
    """Two columns of a native dataset; the others are passed over."""
    out = new_folder(spark, "native-pruned")
    load(native_lineitem(spark, folder), NATIVE_SPEC, NativeTarget(out, NATIVE_COLUMNS))
    rows = read_native(spark, out, ["status", "quantity"])
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("line_count"), F.sum("quantity").alias("quantity"))


EVENT_COLUMNS = (Col("id", "INTEGER"), Col("happened", "TIMESTAMP"), Col("kind", "VARCHAR", 6), Col("value", "NUMERIC", 9, 2))
EVENT_FIELDS = (("event_id", "id"), ("ts", "happened"), ("event_type", "kind"), ("value", "value"))


def _stream_events(spark, folder, out, target=None):
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    spec = LoadSpec(columns=EVENT_COLUMNS, fields=EVENT_FIELDS, abort_on_error=False, rejected_path=f"{out}/rejected")
    target = target or StreamTarget(f"{out}/target", EVENT_COLUMNS)
    stream_load(stream, spec, target, f"{out}/checkpoint", trigger={"availableNow": True}).awaitTermination()


STREAM_SQL = (
    "SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS happened, event_type AS kind, "
    "CAST(CAST(\"value\" AS DECIMAL(9,2)) AS VARCHAR) AS \"value\" FROM events WHERE octet_length(encode(event_type)) <= 6"
)


def _plain_events(df):
    return df.select(
        "id", F.date_format("happened", "yyyy-MM-dd HH:mm:ss.SSS").alias("happened"), "kind",
        F.col("value").cast("string").alias("value"),
    )


@query(STREAM_SQL)
def stream_native_sink(spark, folder):
    """A stream into the native format's own sink, and its values read back."""
    out = new_folder(spark, "stream-native")
    stream = spark.readStream.schema(table(spark, folder, "events").schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    spec = LoadSpec(columns=EVENT_COLUMNS, fields=EVENT_FIELDS, abort_on_error=False)
    target = NativeStreamTarget(f"{out}/target", EVENT_COLUMNS)
    stream_load(stream, spec, target, f"{out}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    return _plain_events(read_native(spark, f"{out}/target"))


@query(STREAM_SQL)
def stream_load_(spark, folder):
    out = new_folder(spark, "stream")
    _stream_events(spark, folder, out)
    return _plain_events(spark.read.parquet(f"{out}/target"))


@query(STREAM_SQL)
def stream_load_table(spark, folder):
    out = new_folder(spark, "stream")
    name = "streamed_" + out.rsplit("-", 1)[1]
    _stream_events(spark, folder, out, TableStreamTarget(name, EVENT_COLUMNS))
    return _plain_events(spark.table(name))


EVENT_PRICE = "CAST(CAST(\"value\" AS DECIMAL(9,2)) AS VARCHAR)"
EVENT_ROW = sql_row([
    (None, sql_little_endian("event_id"), "8"),
    (None, sql_little_endian("epoch_us(ts) // 1000 * 1000 - 946684800000000"), "8"),
    (None, sql_wire_text("event_type"), f"4 + {sql_bytes('event_type')}"),
    (None, sql_wire_text(EVENT_PRICE), f"4 + {sql_bytes(EVENT_PRICE)}"),
])


@query(f"SELECT {EVENT_ROW} AS row_hex FROM events WHERE octet_length(encode(event_type)) <= 6")
def stream_load_native(spark, folder):
    out = new_folder(spark, "stream")
    _stream_events(spark, folder, out, NativeStreamTarget(f"{out}/target", EVENT_COLUMNS))
    return published_rows(spark, f"{out}/target", len(EVENT_COLUMNS)).select(F.hex("row_bytes").alias("row_hex"))


@query("SELECT event_id, 'kind: longer than 6 bytes' AS reject_reason FROM events "
       "WHERE octet_length(encode(event_type)) > 6")
def stream_load_rejects(spark, folder):
    out = new_folder(spark, "stream")
    _stream_events(spark, folder, out)
    return spark.read.parquet(f"{out}/rejected").select("event_id", "reject_reason")


@query("SELECT level, remark, (SELECT count(*) FROM lineitem) AS rows FROM ("
       "SELECT 'warning' AS level, 'field ' || column_name || ' is not loaded' AS remark FROM (DESCRIBE lineitem) "
       "WHERE column_name NOT IN ('l_orderkey', 'l_shipdate', 'l_quantity') UNION ALL "
       "SELECT 'error', 'field l_quantity: a double field cannot be loaded into DATE: it must be a date or timestamp' UNION ALL "
       "SELECT 'warning', 'column remark gets no value from the stream')")
def check_load_(spark, folder):
    """What the check before a load finds on a table's own fields."""
    lines = table(spark, folder, "lineitem")
    spec = LoadSpec((Col("id", "INTEGER"), Col("shipped", "DATE"), Col("wrong", "DATE"), Col("remark", "VARCHAR", 4)),
                    fields=(("l_orderkey", "id"), ("l_shipdate", "shipped"), ("l_quantity", "wrong")))
    found = spark.createDataFrame([(r.level, r.text) for r in check_load(lines.schema, spec)], "level string, remark string")
    return found.crossJoin(F.broadcast(lines.agg(F.count(F.lit(1)).alias("rows"))))


# F. steps around a load

@query("SELECT o_orderkey AS id, o_custkey FROM orders")
def generate_rows_(spark, folder):
    """A row for every key up to the largest, and the orders that have it."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    largest = orders.agg(F.max("o_orderkey")).first()[0]
    return generate_rows(spark, (largest or 0) + 1).join(orders, F.col("id") == F.col("o_orderkey")).select("id", "o_custkey")


RANDOM_FIELDS = {"str": "random string", "uuid": "random uuid", "uuid4": "random uuid4", "integ": "random integer",
                 "numer": "random number"}


def sql_digest(name: str) -> str:
    return f"md5('7/{name}:' || o_orderkey)"


def sql_parts(digest: str, *parts: str) -> str:
    return " || '-' || ".join(p if p.startswith("'") else f"substr({digest}, {p})" for p in parts)


RANDOM_SQL = (
    f"substr({sql_digest('str')}, 1, 13) AS str, {sql_parts(sql_digest('uuid'), '1, 8', '9, 4', '13, 4', '17, 4', '21, 12')} "
    f"AS uuid, {sql_parts(sql_digest('uuid4'), '1, 8', '9, 4')} || '-4' || substr({sql_digest('uuid4')}, 14, 3) || '-8' || "
    f"substr({sql_digest('uuid4')}, 18, 3) || '-' || substr({sql_digest('uuid4')}, 21, 12) AS uuid4, "
    f"('0x' || substr({sql_digest('integ')}, 1, 8))::BIGINT - 2147483648 AS integ, "
    f"('0x' || substr({sql_digest('numer')}, 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS numer"
)


@query(f"SELECT o_orderkey, {RANDOM_SQL} FROM orders")
def random_fields(spark, folder):
    return add_random_fields(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", RANDOM_FIELDS, "7")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey DESC) AS valuename FROM orders")
def sequence_ids(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", (-F.col("o_orderkey")).alias("descending"))
    return add_sequence(orders, "valuename", order_by=["descending"]).select("o_orderkey", "valuename")


@query("WITH n AS (SELECT l_returnflag, 98 + 2 * row_number() OVER (ORDER BY l_returnflag) AS number FROM lineitem) "
       "SELECT l_returnflag, min(number) AS first_number, max(number) AS last_number, count(DISTINCT number) AS numbers "
       "FROM n GROUP BY l_returnflag")
def sequence_hot_keys(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_returnflag")
    numbered = add_sequence(lines, "number", start=100, step=2, order_by=["l_returnflag"])
    return numbered.groupBy("l_returnflag").agg(
        F.min("number").alias("first_number"), F.max("number").alias("last_number"),
        F.count_distinct("number").alias("numbers"),
    )


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '\\.' ELSE o_orderpriority END AS o_orderpriority FROM orders")
def route_merge_(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    status = F.expr("nullif(o_orderstatus, 'F')")  # an unknown status takes the other branch
    merged = route_merge(orders, status == "P", lambda met: replace_formula(met, "o_orderpriority", r"r'\.'"))
    return merged.select("o_orderkey", "o_orderpriority")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IS DISTINCT FROM 'P'")
def route_false_branch(spark, folder):
    orders = table(spark, folder, "orders")
    return route(orders, F.expr("nullif(o_orderstatus, 'F')") == "P")[1].select("o_orderkey")


@query("SELECT p_partkey, upper(p_name) AS p_name, CASE WHEN p_size > 25 THEN CAST(p_size * 2 AS BIGINT) ELSE "
       "CAST(p_size AS BIGINT) END AS p_size FROM part")
def replace_formula_(spark, folder):
    parts = replace_formula(table(spark, folder, "part"), "p_name", "upper(p_name)")
    return replace_where(parts, F.col("p_size") > 25, {"p_size": "p_size * 2"}).select(
        "p_partkey", "p_name", F.col("p_size").cast("bigint").alias("p_size")
    )


@query("SELECT o_orderkey AS id, o_orderpriority AS priority, o_custkey AS customer, "
       "CAST(CAST(o_totalprice AS DECIMAL(12,5)) AS VARCHAR) AS price, "
       "CAST(CAST(floor(o_totalprice) + 0.25 AS DECIMAL(10,0)) AS VARCHAR) AS whole FROM orders")
def meta_conform(spark, folder):
    orders = table(spark, folder, "orders").withColumn("whole", F.floor("o_totalprice") + F.lit(0.25))
    described = set_meta(orders, [
        FieldMeta("o_orderkey", "id", 10), FieldMeta("o_orderpriority", "priority", 15), FieldMeta("o_custkey", "customer", 10, 0),
        FieldMeta("o_totalprice", "price", 12, 5), FieldMeta("whole", length=10, precision=0),
    ])
    return described.withColumns({"price": F.col("price").cast("string"), "whole": F.col("whole").cast("string")})


@query("SELECT count(*) > 50000 AS aborted, CASE WHEN count(*) > 50000 THEN 0 ELSE count(*) END AS rows_passed FROM lineitem")
def abort_threshold(spark, folder):
    try:
        passed, aborted = abort_after(table(spark, folder, "lineitem"), 50000).count(), False
    except LoadAborted:
        passed, aborted = 0, True
    return spark.createDataFrame([(aborted, passed)], "aborted boolean, rows_passed bigint")


@query(f"WITH n AS (SELECT o_orderkey, o_orderkey + 1 AS valuename, {RANDOM_SQL} FROM orders) "
       "SELECT valuename, CASE WHEN valuename % 1000 = 7 THEN '\\.' ELSE str END AS str, uuid, uuid4, integ, "
       "CAST(CAST(numer AS DECIMAL(10,5)) AS VARCHAR) AS numer FROM n")
def sample_load(spark, folder):
    """Numbered rows with random fields, some replaced by an end marker, described, loaded and read back."""
    rows = add_sequence(table(spark, folder, "orders").select("o_orderkey"), "valuename", order_by=["o_orderkey"])
    rows = add_random_fields(rows, "o_orderkey", RANDOM_FIELDS, "7")
    marked = replace_where(rows, F.col("valuename") % 1000 == 7, {"str": r"r'\.'"})
    described = set_meta(marked, [
        FieldMeta("valuename"), FieldMeta("str", length=13), FieldMeta("uuid", length=36),
        FieldMeta("uuid4", length=36), FieldMeta("integ", length=10), FieldMeta("numer", length=10, precision=5),
    ])
    out = new_folder(spark, "sample")
    columns = (Col("valuename", "INTEGER"), Col("str", "VARCHAR", 13), Col("uuid", "CHAR", 36), Col("uuid4", "CHAR", 36),
               Col("integ", "INTEGER"), Col("numer", "NUMERIC", 10, 5))
    load(described, LoadSpec(columns=columns), PathTarget(out, columns))
    return spark.read.parquet(out).withColumn("numer", F.col("numer").cast("string"))
