"""tableload: load tables with declared columns, route them into partitions, write them
all-or-nothing, and prove with Spark jobs that keys, references and checks hold."""

from .specs import (CheckSpec, ColumnSpec, ForeignKeySpec, KeySpec, Partition, PartitionLevel,
                    PartitionScheme, SequenceSpec, TriggerSpec)

__all__ = ["CheckSpec", "ColumnSpec", "ForeignKeySpec", "KeySpec", "Partition", "PartitionLevel",
           "PartitionScheme", "SequenceSpec", "TriggerSpec"]
