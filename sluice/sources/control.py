"""Load settings kept as data: a control table with one row per setting or list entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sluice.errors import LoadPlanError
from sluice.plans.spec import LoadSpec
from sluice.sources.target import JdbcTarget, TableTarget, columns_from_table

# The keys a control table may hold.
SETTING_KEYS = (
    "SCHEMANAME", "TABLENAME", "DIRECT", "ABORTONERROR", "EXCEPTIONSFILENAME",
    "REJECTEDDATAFILENAME", "STREAMNAME", "CONNECTIONNAME",
)
LIST_KEYS = ("FIELDSTREAM", "FIELDDATABASE")
CONTROL_SCHEMA = "load_id string, key string, position int, value string"
UNKNOWN_SHOWN = 10  # unknown keys that an error names
TRUE_WORDS = ("y", "yes", "true", "1")


def _switch(text: str | None, default: bool) -> bool:
    return default if text is None else text.strip().lower() in TRUE_WORDS


def _entries(rows: DataFrame, most: int, what: str) -> list:
    """Entries of a bounded number; more than a load can hold are refused, not cut."""
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise LoadPlanError(what)
    return found


def _by_position(entries, key: str) -> dict[int, str]:
    places = {}
    for e in entries:
        if e.key == key:
            if e.position is None:
                raise LoadPlanError(f"{key} entry {e.value} has no position")
            if e.position in places:
                raise LoadPlanError(f"{key} has position {e.position} twice")
            places[e.position] = e.value
    return places


def _pairs(entries) -> list[tuple[str, str]] | None:
    """Stream fields and target columns that share a position, in the order of positions.

    Columns after the last stream field get an empty name, which fails as a required field when the load is planned.
    """
    streams, targets = (_by_position(entries, key) for key in LIST_KEYS)
    if not targets and not streams:
        return None
    lonely = [targets[p] for p in sorted(targets.keys() - streams.keys()) if p < max(streams, default=p)]
    if lonely:
        raise LoadPlanError(f"columns without a stream field: {', '.join(map(str, lonely))}")
    extra = [streams[p] for p in sorted(streams.keys() - targets.keys())]
    if extra:
        raise LoadPlanError(f"stream fields without a column: {', '.join(map(str, extra))}")
    return [(streams.get(p), targets[p]) for p in sorted(targets)]


def spec_from_control_table(control: DataFrame, load_id: str, columns=None) -> LoadSpec:
    """The load named ``load_id``.

    A stream field and a column belong together if their list entries have the same position; positions
    may have gaps and entries may come in any order. Entries without a position, positions that repeat, gaps in the
    stream fields and stream fields without a column are refused. Without ``columns`` the named table's own columns are used.
    DIRECT is a storage hint of the target and has no effect here.
    """
    rows = control.where(F.col("load_id") == load_id).select(F.upper("key").alias("key"), "position", "value")
    known = F.col("key").isin(*SETTING_KEYS, *LIST_KEYS)
    unknown = [r.key for r in rows.where(~known).select("key").distinct().orderBy("key").limit(UNKNOWN_SHOWN).collect()]
    if unknown:
        raise LoadPlanError(f"unknown control keys: {', '.join(unknown)}")

    # what a load can hold: every setting once, and two lists with an entry for each target column
    twice = f"load {load_id} sets a key twice"
    entries = _entries(rows.where(F.col("key").isin(*SETTING_KEYS)), len(SETTING_KEYS), twice)
    settings = {e.key: e.value for e in entries}
    if len(settings) < len(entries):
        raise LoadPlanError(twice)
    table = settings.get("TABLENAME")
    if table and settings.get("SCHEMANAME"):
        table = f"{settings['SCHEMANAME']}.{table}"
    lists = rows.where(F.col("key").isin(*LIST_KEYS))
    if not entries and lists.isEmpty():
        raise LoadPlanError(f"the control table has no load {load_id}")
    columns = columns if columns is not None else columns_from_table(control.sparkSession, table)
    listed = _entries(lists, len(LIST_KEYS) * len(columns), f"load {load_id} lists more fields than the target has columns")
    return LoadSpec(
        columns=columns,
        fields=_pairs(listed),
        table=table,
        abort_on_error=_switch(settings.get("ABORTONERROR"), True),
        rejected_path=settings.get("REJECTEDDATAFILENAME"),
        exceptions_path=settings.get("EXCEPTIONSFILENAME"),
        stream_name=settings.get("STREAMNAME"),
        connection=settings.get("CONNECTIONNAME"),
    )


def target_for(spec: LoadSpec, connections: dict[str, dict] | None = None):
    """Where a load goes: the table of its named connection, or else the catalog table.

    ``connections`` holds JDBC options by name, ``url`` among them.
    """
    if not spec.table:
        raise LoadPlanError("no target table is named")
    if spec.connection is None:
        return TableTarget(spec.table)
    options = dict((connections or {}).get(spec.connection, ()))
    if "url" not in options:
        raise LoadPlanError(f"connection {spec.connection} is not defined")
    return JdbcTarget(options.pop("url"), spec.table, options)
