"""Driver-side specifications that parameterise the operators.

A spec is metadata of bounded size (a column list, a partition list, a constraint):
it lives on the driver as a dataclass and is turned into literals or into a small,
broadcastable DataFrame.  The data itself never passes through these objects.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values (must equal the source catalog's conventions).
IDENTIFIER_MAX_BYTES = 63          # identifiers are cut to 63 bytes, on a character boundary
BIGINT_MIN = -(2 ** 63)
BIGINT_MAX = 2 ** 63 - 1
MINVALUE = "MINVALUE"              # open lower end of a range bound
MAXVALUE = "MAXVALUE"              # open upper end of a range bound
DELETE_RULES = ("NO ACTION", "RESTRICT", "CASCADE", "SET NULL", "SET DEFAULT")
TRIGGER_EVENTS = ("INSERT", "UPDATE", "DELETE")


@dataclass(frozen=True)
class ColumnSpec:
    """One declared column: target name, source spelling, type and rules."""

    name: str
    type_name: str = "string"
    position: int = 0
    source_name: str | None = None
    nullable: bool = True
    default: str | None = None          # SQL expression text, applied only when the column is absent

    @property
    def source(self) -> str:
        return self.source_name or self.name


def ordered(columns: list[ColumnSpec]) -> list[ColumnSpec]:
    """Columns in declared ``position`` order (stable for equal positions)."""
    return sorted(columns, key=lambda c: c.position)


@dataclass(frozen=True)
class Partition:
    """One partition of a level.

    ``values`` holds SQL literals: the list members (LIST), ``[lower, upper]`` (RANGE,
    with ``MINVALUE``/``MAXVALUE`` open ends and ``"(a, b)"`` for composite keys) or
    ``[remainder]`` (HASH).  ``is_default`` marks the catch-all partition.
    """

    name: str
    values: tuple[str, ...] | None = None
    is_default: bool = False


@dataclass(frozen=True)
class PartitionLevel:
    """All partitions of one table (or of one parent partition) share method and key."""

    method: str                          # LIST | RANGE | HASH
    key: str                             # SQL expression, comma separated for composite keys
    partitions: tuple[Partition, ...] = ()

    def __post_init__(self):
        if self.method.upper() not in ("LIST", "RANGE", "HASH"):
            raise ValueError(f"unknown partition method {self.method!r}")
        object.__setattr__(self, "method", self.method.upper())

    @property
    def names(self) -> list[str]:
        return [p.name for p in self.partitions]


@dataclass(frozen=True)
class PartitionScheme:
    """Top level plus optional per-partition sub levels (two levels at most)."""

    top: PartitionLevel
    sub: dict[str, PartitionLevel] = field(default_factory=dict)

    def leaves(self) -> list[tuple[str, str | None]]:
        """Every declared (partition, subpartition) pair; leaf partitions carry ``None``."""
        out: list[tuple[str, str | None]] = []
        for p in self.top.partitions:
            level = self.sub.get(p.name)
            if level is None or not level.partitions:
                out.append((p.name, None))
            else:
                out.extend((p.name, s.name) for s in level.partitions)
        return out


@dataclass(frozen=True)
class KeySpec:
    """Primary key or unique constraint (``where`` makes it partial).

    ``expressions`` tells for each of ``columns`` whether it is SQL text; where it is empty, a
    name of a column is that column and everything else SQL text."""

    name: str
    columns: tuple[str, ...]
    primary: bool = False
    where: str | None = None
    deferrable: bool = False
    deferred: bool = False
    migrate: bool = True
    expressions: tuple[bool, ...] = ()


@dataclass(frozen=True)
class ForeignKeySpec:
    name: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    delete_rule: str = "NO ACTION"
    deferrable: bool = False
    deferred: bool = False
    migrate: bool = True
    reduce_parent: bool = False          # validate a small child batch against a huge parent


@dataclass(frozen=True)
class CheckSpec:
    name: str
    condition: str | None
    migrate: bool = True


@dataclass(frozen=True)
class SequenceSpec:
    """A sequence as catalogued: ``last_value`` is the last value handed out remotely."""

    name: str
    increment_by: int = 1
    last_value: int = 0
    min_value: int | float | None = None
    max_value: int | float | None = None
    cyclical: bool = False
    cache_size: int = 1                  # numbers drawn at a time (assign_sequence_blocks)


@dataclass(frozen=True)
class TriggerSpec:
    """A row or statement trigger re-expressed as a transform of a change set."""

    name: str
    timing: str                           # BEFORE | AFTER | INSTEAD OF
    events: tuple[str, ...]               # subset of TRIGGER_EVENTS
    for_each_row: bool = True
    when: str | None = None
    assignments: tuple[tuple[str, str], ...] = ()   # (column, SQL expression), applied in order
    drop_if: str | None = None
    migrate: bool = True
