"""Bulk loading of DataFrames and streams on Spark: map, conform, reject, write, report."""

from sluice.errors import LoadAborted, LoadPlanError
from sluice.operators.mapping import map_by_name, map_by_position
from sluice.operators.rejects import null_flags, passthrough, split_rejects, validate
from sluice.operators.sequence import add_sequence
from sluice.plans.load import LoadReport, check_load, load
from sluice.plans.spec import LoadSpec, TargetColumn
from sluice.sources.control import spec_from_control_table
from sluice.sources.native import NativeTarget, encode_rows
from sluice.sources.target import JdbcTarget, PathTarget, TableTarget, columns_from_table, create_target
from sluice.streaming.stream import StreamTarget, stream_load

__all__ = [
    "JdbcTarget", "LoadAborted", "LoadPlanError", "LoadReport", "LoadSpec", "NativeTarget", "PathTarget",
    "StreamTarget", "TableTarget", "TargetColumn", "add_sequence", "check_load", "columns_from_table",
    "create_target", "encode_rows", "load", "map_by_name", "map_by_position", "null_flags", "passthrough",
    "spec_from_control_table", "split_rejects", "stream_load", "validate",
]
