"""Mapping of stream fields to target columns, by position or by name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluice.errors import LoadPlanError
from sluice.plans.spec import LoadSpec, TargetColumn


def column(name: str) -> Column:
    """Column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class MappedField:
    source: T.StructField
    target: TargetColumn


def find_field(schema: T.StructType, name: str | None) -> T.StructField | None:
    """Field by name: an exact match wins over one that differs in case only."""
    if name is None:
        return None
    for field in schema.fields:
        if field.name == name:
            return field
    alike = [f for f in schema.fields if f.name.lower() == name.lower()]
    if len(alike) > 1:
        raise LoadPlanError(f"field [{name}] is ambiguous in the stream")
    return alike[0] if alike else None


def resolve_mapping(schema: T.StructType, spec: LoadSpec) -> list[MappedField]:
    """Pairs of stream field and target column, in load order."""
    if spec.fields is None:
        if len(schema.fields) > len(spec.columns):
            extra = [f.name for f in schema.fields[len(spec.columns):]]
            raise LoadPlanError(f"too many fields for {len(spec.columns)} target columns: {', '.join(extra)}")
        return [MappedField(f, c) for f, c in zip(schema.fields, spec.columns)]

    mapped, used = [], set()
    for stream_name, target_name in spec.fields:
        source = find_field(schema, stream_name)
        if source is None:
            raise LoadPlanError(f"column {target_name} is fed by field [{stream_name}], which the stream does not have")
        target = spec.column(target_name)
        if target is None:
            raise LoadPlanError(f"column [{target_name}] is not in the target table")
        if target.name in used:
            raise LoadPlanError(f"column [{target.name}] is mapped twice")
        used.add(target.name)
        mapped.append(MappedField(source, target))
    return mapped


def _project(df: DataFrame, spec: LoadSpec) -> DataFrame:
    mapped = resolve_mapping(df.schema, spec)
    return df.select([column(m.source.name).alias(m.target.name) for m in mapped])


def map_by_position(df: DataFrame, columns) -> DataFrame:
    """Field *i* becomes target column *i* and takes its name."""
    return _project(df, LoadSpec(columns=columns))


def map_by_name(df: DataFrame, columns, pairs) -> DataFrame:
    """Each (stream field, target column) pair selects and renames; other fields are left out."""
    return _project(df, LoadSpec(columns=columns, fields=pairs))
