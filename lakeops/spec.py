"""Declared datasets: columns with roles, load and validation modes, thresholds, and the checks on all of them."""

from __future__ import annotations

from dataclasses import dataclass, field

INTEGER, SHORT, LONG, FLOAT, DOUBLE = "integer", "short", "long", "float", "double"
STRING, BOOLEAN, DECIMAL, DATE, DATETIME, BINARY, ARRAY, STRUCT = "string", "boolean", "decimal", "date", "datetime", "binary", "array", "struct"
TYPES = {INTEGER, SHORT, LONG, FLOAT, DOUBLE, STRING, BOOLEAN, DECIMAL, DATE, DATETIME, BINARY, ARRAY, STRUCT}
FULL_SNAPSHOT, INCREMENTAL, LAST_CHANGES = "full_snapshot", "incremental", "last_changes"
FAIL_FAST, PERMISSIVE = "fail_fast", "permissive"
ABSOLUTE, PERCENTAGE = "absolute", "percentage"
WARNING, REJECT = "warning", "reject"


@dataclass(frozen=True)
class ColumnSpec:
    """A column. ``parent`` names the struct or array it is nested in; ``element`` is an array's element type (``struct`` if it has children).

    ``transform``: "comma" (1.234,5), "comma-eng" (1,234.5) or a name in the function catalog; ``pattern``: of dates and times."""

    name: str
    type: str = STRING
    transform: str | None = None
    pattern: str | None = None
    precision: int | None = None
    scale: int | None = None
    parent: str | None = None
    element: str | None = None
    primary_key: bool = False
    timestamp: bool = False
    partitionable: bool = False
    sensitive: bool = False
    alias: str | None = None
    ignore_persistence: bool = False
    lenient: bool = False

    @property
    def stored_name(self) -> str:
        return self.alias or self.name


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    load_mode: str = FULL_SNAPSHOT
    validation_mode: str = FAIL_FAST
    threshold: float = 0
    threshold_kind: str = ABSOLUTE
    quality_mode: str = WARNING
    rules: tuple = ()
    partition_by: tuple[str, ...] = ()
    file_pattern: str | None = None
    allow_partition_change: bool = True
    keep_history: bool = False
    problems: tuple[str, ...] = field(default=(), init=False)

    def __post_init__(self) -> None:
        if found := list(lint(self)):
            raise ValueError(f"dataset {self.name}: " + "; ".join(found))

    def role(self, flag: str) -> list[ColumnSpec]:
        return [c for c in self.columns if getattr(c, flag)]


def lint(spec: DatasetSpec):
    """The problems of a spec, in words."""
    for c in spec.columns:
        if c.type not in TYPES:
            yield f"{c.name} has the unknown type {c.type}"
        if c.type == DECIMAL and (c.precision is None or c.scale is None):
            yield f"decimal {c.name} needs precision and scale"
        if c.timestamp and c.type not in (DATE, DATETIME):
            yield f"timestamp {c.name} is neither date nor datetime"
    keys, times, hidden = spec.role("primary_key"), spec.role("timestamp"), spec.role("sensitive")
    if spec.load_mode not in (FULL_SNAPSHOT, INCREMENTAL, LAST_CHANGES):
        yield f"unknown load mode {spec.load_mode}"
    if spec.load_mode == LAST_CHANGES and not (keys and times):
        yield "last_changes needs a primary key and a timestamp"
    if len(times) > 1:
        yield "more than one timestamp"
    if hidden and not keys:
        yield "sensitive columns need a primary key"
    used = {c for r in spec.rules for c in getattr(r, "columns", ())}
    for c in hidden:
        if c.timestamp:
            yield f"sensitive {c.name} can't be the timestamp"
        if c.partitionable or c.name in spec.partition_by:
            yield f"sensitive {c.name} can't partition the table"
        if c.name in used:
            yield f"sensitive {c.name} is used in a quality rule"
    names = [c.stored_name for c in spec.columns if c.parent is None]
    if len(set(names)) < len(names):
        yield "two columns have one name"


#: JDBC type names to declared types (fixed values).
JDBC_TYPES = {
    "BIGINT": LONG, "INTEGER": INTEGER, "INT": INTEGER, "SMALLINT": SHORT, "TINYINT": SHORT, "REAL": FLOAT, "FLOAT": DOUBLE, "DOUBLE": DOUBLE, "BIT": BOOLEAN, "BOOLEAN": BOOLEAN,
    "DECIMAL": DECIMAL, "NUMERIC": DECIMAL, "DATE": DATE, "TIMESTAMP": DATETIME, "DATETIME": DATETIME, "DATETIME2": DATETIME, "BLOB": BINARY, "VARBINARY": BINARY, "BINARY": BINARY,
}


def from_jdbc_columns(rows: list[tuple[str, str, int | None, int | None]], keys: tuple[str, ...] = ()) -> tuple[ColumnSpec, ...]:
    """Column specs from (name, type, precision, scale) rows of a database's catalog; unknown types become strings."""
    out = []
    for name, kind, precision, scale in rows:
        declared = JDBC_TYPES.get(kind.upper().split("(")[0].strip(), STRING)
        sized = declared == DECIMAL
        out.append(ColumnSpec(name, declared, precision=precision if sized else None, scale=scale if sized else None, primary_key=name in keys))
    return tuple(out)
