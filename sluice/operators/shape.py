"""Steps around a load: making rows, routing them, replacing and describing fields, stopping early."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sluice.errors import LoadAborted, LoadPlanError
from sluice.operators.mapping import column, find_field
from sluice.sources.target import LENGTH

# Shapes of random fields.
STRING_LENGTH = 13
UUID_GROUPS = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))  # first digit and length of each group
FRACTION_DIGITS = 13  # hex digits, 52 bits
RANDOM_KINDS = ("random string", "random uuid", "random uuid4", "random integer", "random number")


def generate_rows(spark: SparkSession, n: int, name: str = "id", partitions: int | None = None) -> DataFrame:
    """``n`` rows, made inside the tasks."""
    return spark.range(0, n, 1, partitions).withColumnRenamed("id", name)


def _digest(key: Column, salt: str) -> Column:
    return F.md5(F.concat(F.lit(salt + ":"), key.cast("string")))


def _hex_number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("bigint")


def random_field(kind: str, key: Column, seed: str) -> Column:
    """Random-looking value that depends on the key and the seed only, so reruns give the same rows.

    Strings are 13 hex digits, integers signed 32-bit, numbers in [0, 1).
    """
    digest = _digest(key, seed)
    if kind == "random string":
        return F.substring(digest, 1, STRING_LENGTH)
    if kind in ("random uuid", "random uuid4"):
        groups = [F.substring(digest, at, length) for at, length in UUID_GROUPS]
        if kind == "random uuid4":  # version 4, variant 8
            groups[2] = F.concat(F.lit("4"), F.substring(digest, 14, 3))
            groups[3] = F.concat(F.lit("8"), F.substring(digest, 18, 3))
        return F.concat_ws("-", *groups)
    if kind == "random integer":
        return _hex_number(F.substring(digest, 1, 8)) - F.lit(1 << 31)
    if kind == "random number":
        return _hex_number(F.substring(digest, 1, FRACTION_DIGITS)) / F.lit(float(1 << 4 * FRACTION_DIGITS))
    raise LoadPlanError(f"{kind} is not one of: {', '.join(RANDOM_KINDS)}")


def add_random_fields(df: DataFrame, key: str, fields: dict[str, str], seed: str = "0") -> DataFrame:
    """Add fields by name and kind; each field has its own values."""
    made = [random_field(kind, column(key), f"{seed}/{name}").alias(name) for name, kind in fields.items()]
    return df.select("*", *made)


def add_uuid(df: DataFrame, name: str) -> DataFrame:
    """Truly random UUIDs. They differ on every read, so load such rows with ``stage=True``."""
    return df.withColumn(name, F.uuid())


def route(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the condition, and all others; an unknown condition counts as not met."""
    met = F.coalesce(condition, F.lit(False))
    return df.where(met), df.where(~met)


def route_merge(df: DataFrame, condition: Column, on_true=None, on_false=None) -> DataFrame:
    """Send rows through one of two branches and merge what comes out.

    This reads the input once per branch; where a branch only changes fields, use ``replace_where``.
    """
    met, rest = route(df, condition)
    return (on_true(met) if on_true else met).unionByName(on_false(rest) if on_false else rest)


def replace_where(df: DataFrame, condition: Column, formulas: dict[str, str]) -> DataFrame:
    """``replace_formula`` on the rows that meet the condition, in a single pass."""
    met = F.coalesce(condition, F.lit(False))
    changes = {}
    for name, formula in formulas.items():
        f = _field(df, name)
        changes[f.name] = F.when(met, F.expr(formula).cast(f.dataType)).otherwise(column(f.name))
    return df.withColumns(changes)


def replace_formula(df: DataFrame, name: str, formula: str) -> DataFrame:
    """Replace a field by an expression over the row, keeping its type."""
    f = _field(df, name)
    return df.withColumn(f.name, F.expr(formula).cast(f.dataType))


def _field(df: DataFrame, name: str) -> T.StructField:
    found = find_field(df.schema, name)
    if found is None:
        raise LoadPlanError(f"field [{name}] is not in the stream")
    return found


@dataclass(frozen=True)
class FieldMeta:
    """Declared shape of a field: a new name, a length and the digits after the point."""

    name: str
    rename: str | None = None
    length: int | None = None
    precision: int | None = None


def set_meta(df: DataFrame, fields, select_unspecified: bool = False) -> DataFrame:
    """Select, rename and declare lengths.

    Numbers with a precision become DECIMAL(length, precision), whole ones with precision 0 keep their type; one that does
    not fit fails the job rather than turning NULL. Lengths of other fields are kept in the schema, where table creation
    finds them; values are not cut.
    """
    out, named = [], set()
    for meta in fields:
        f = _field(df, meta.name)
        named.add(f.name)
        value = column(f.name)
        name = meta.rename or f.name
        if meta.length and meta.precision == 0 and isinstance(f.dataType, T.IntegralType):
            message = F.concat(F.lit(f"field {f.name} has more than {meta.length} digits: "), value.cast("string"))
            fits = value.cast("decimal(20,0)").between(1 - 10**meta.length, 10**meta.length - 1) if meta.length < 19 else F.lit(True)
            value = F.when(value.isNotNull() & ~fits, F.raise_error(message).cast(f.dataType)).otherwise(value)
        elif meta.length and meta.precision is not None and isinstance(f.dataType, T.NumericType):
            kind = T.DecimalType(meta.length, meta.precision)
            fitted = value.try_cast(kind)
            message = F.concat(F.lit(f"field {f.name} does not fit {kind.simpleString()}: "), value.cast("string"))
            value = F.when(value.isNotNull() & fitted.isNull(), F.raise_error(message).cast(kind)).otherwise(fitted)
        out.append(value.alias(name, metadata={LENGTH: meta.length}) if meta.length else value.alias(name))
    if select_unspecified:
        out += [column(c) for c in df.columns if c not in named]
    return df.select(out)


def abort_after(df: DataFrame, threshold: int) -> DataFrame:
    """The rows, unless there are more than ``threshold`` of them. Reads no more rows than it takes to tell."""
    if df.limit(threshold + 1).count() > threshold:
        raise LoadAborted(f"more rows than the limit of {threshold}; nothing was loaded")
    return df
