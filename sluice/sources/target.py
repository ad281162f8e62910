"""Target tables: reading their columns, creating them and writing to them."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluice.errors import LoadPlanError
from sluice.operators.mapping import column
from sluice.plans.spec import TargetColumn

LENGTH = "length"  # metadata key of a text field's declared length
DECLARED = "declared"  # metadata key of a created column's type as it was declared
_CHAR_METADATA = "__CHAR_VARCHAR_TYPE_STRING"
_WIDTHS = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}
_SIMPLE = {
    T.BooleanType: "BOOLEAN",
    T.FloatType: "FLOAT",
    T.DoubleType: "FLOAT",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMPTZ",
    T.DayTimeIntervalType: "INTERVAL",
    T.BinaryType: "VARBINARY",
}


def target_column(f: T.StructField) -> TargetColumn:
    """Target column that takes the values of a field: as it was declared when created, or by its Spark type."""
    if DECLARED in f.metadata:
        return TargetColumn(f.name, *json.loads(f.metadata[DECLARED]))
    kind = type(f.dataType)
    if kind in _WIDTHS:
        return TargetColumn(f.name, "INTEGER", width=_WIDTHS[kind])
    if kind in _SIMPLE:
        return TargetColumn(f.name, _SIMPLE[kind])
    if kind is T.DecimalType:
        return TargetColumn(f.name, "NUMERIC", f.dataType.precision, f.dataType.scale)
    if kind in (T.CharType, T.VarcharType):
        return TargetColumn(f.name, "CHAR" if kind is T.CharType else "VARCHAR", f.dataType.length)
    if kind is T.StringType:
        declared = re.fullmatch(r"(char|varchar)\((\d+)\)", f.metadata.get(_CHAR_METADATA, ""))
        if declared:
            return TargetColumn(f.name, declared[1].upper(), int(declared[2]))
        return TargetColumn(f.name, "VARCHAR", f.metadata.get(LENGTH))
    raise LoadPlanError(f"column {f.name}: type {f.dataType.simpleString()} is not supported")


def columns_from_schema(schema: T.StructType) -> tuple[TargetColumn, ...]:
    return tuple(target_column(f) for f in schema.fields)


def columns_from_table(spark: SparkSession, table: str | None) -> tuple[TargetColumn, ...]:
    """Columns of an existing table."""
    if not table or not table.strip():
        raise LoadPlanError("no target table is named")
    if not spark.catalog.tableExists(table):
        raise LoadPlanError(f"table {table} does not exist")
    prefix = DECLARED + "."
    declared = {row["key"][len(prefix):]: json.loads(row["value"])
                for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if row["key"].startswith(prefix)}
    return tuple(TargetColumn(f.name, *declared[f.name.lower()]) if f.name.lower() in declared else target_column(f)
                 for f in spark.table(table).schema.fields)


def declaration(c: TargetColumn) -> list:
    """A column's declared type as it is kept with a table."""
    return [c.type_name, c.length, c.scale, c.width, c.fixed]


def create_target(spark: SparkSession, table: str, columns, path: str | None = None, source: str = "parquet") -> None:
    """Create the table for these target columns, unless it exists; an existing one must have the same columns.

    The declared types are kept with the columns, so that ``columns_from_table`` finds TIME or BINARY(3) again.
    """
    if spark.catalog.tableExists(table):
        there = [(f.name.lower(), target_column(f).spark_type) for f in spark.table(table).schema.fields]
        if there != [(c.name.lower(), c.spark_type) for c in columns]:
            raise LoadPlanError(f"table {table} exists with other columns")
        return
    schema = T.StructType([T.StructField(c.name, c.table_type, True, {DECLARED: json.dumps(declaration(c))}) for c in columns])
    spark.catalog.createTable(table, path=path, source=source, schema=schema)


def full_row(loaded: DataFrame, columns) -> DataFrame:
    """Loaded rows widened to all target columns; columns that are not mapped are NULL."""
    present = set(loaded.columns)
    return loaded.select([
        column(c.name) if c.name in present else F.lit(None).cast(c.spark_type).alias(c.name) for c in columns
    ])


@dataclass(frozen=True)
class PathTarget:
    """Files of the full target row, published by Spark's output commit."""

    path: str
    columns: tuple[TargetColumn, ...]
    format: str = "parquet"
    mode: str = "append"
    options: dict = field(default_factory=dict)
    atomic = True

    def write(self, loaded: DataFrame) -> None:
        full_row(loaded, self.columns).write.format(self.format).mode(self.mode).options(**self.options).save(self.path)


@dataclass(frozen=True)
class TableTarget:
    """Append to a catalog table; columns that are not mapped take their default or NULL."""

    table: str
    atomic = True

    def write(self, loaded: DataFrame) -> None:
        spark = loaded.sparkSession
        intervals = {f.name for f in spark.table(self.table).schema if isinstance(f.dataType, T.DayTimeIntervalType)}
        values = [
            (F.lit(timedelta(microseconds=1)) * column(c)).alias(c) if c in intervals else column(c)
            for c in loaded.columns
        ]
        names = ", ".join("`" + c.replace("`", "``") + "`" for c in loaded.columns)
        names = names.replace("{", "{{").replace("}", "}}")  # braces mark the statement's parameters
        spark.sql(
            f"INSERT INTO {self.table} ({names}) SELECT {names} FROM {{loaded}}", loaded=loaded.select(values)
        )


@dataclass(frozen=True)
class JdbcTarget:
    """Append to a database table, each partition over its own connection and transaction.

    Partitions commit one by one, so a load that may abort counts its rejects before it sends rows.
    """

    url: str
    table: str
    options: dict = field(default_factory=dict)
    batch_size: int = 10000
    isolation: str = "READ_COMMITTED"
    connections: int | None = None
    atomic = False

    def writer_options(self) -> dict:
        options = {
            "url": self.url, "dbtable": self.table, "batchsize": str(self.batch_size), "isolationLevel": self.isolation,
        }
        if self.connections:
            options["numPartitions"] = str(self.connections)
        return {**options, **self.options}

    def write(self, loaded: DataFrame) -> None:
        loaded.write.format("jdbc").options(**self.writer_options()).mode("append").save()
