"""What a keyed table is: its keys, ordering, partitioning and merge rules."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace

COW = "cow"
MOR = "mor"

OVERWRITE_LATEST = "overwrite_latest"
EVENT_TIME = "event_time"
DELETE = "delete"

# Columns kept by the table itself; never part of a schema comparison.
COMMIT_TIME = "_commit_time"
COMMIT_SEQNO = "_commit_seqno"
RECORD_KEY = "_record_key"
PARTITION_PATH = "_partition_path"
FILE_NAME = "_file_name"
METADATA_COLUMNS = (COMMIT_TIME, COMMIT_SEQNO, RECORD_KEY, PARTITION_PATH, FILE_NAME)

MIB = 1024 * 1024


@dataclass(frozen=True)
class TableSpec:
    """Declares a keyed table.

    ``order_by`` picks the winning row when a batch holds a key more than once
    (largest value wins); ``tie_breakers`` continue the comparison.  ``policy``
    says what happens when the stored row has the larger ordering value:
    ``overwrite_latest`` takes the incoming row anyway, ``event_time`` keeps the
    stored one.  A replaced file larger than ``rewrite_bytes`` is written by several
    tasks, as files of about that size.  The rows that one task sorts take about ``sort_bytes``
    of memory at most, so files end before ``target_file_bytes`` where rows pack well.  With ``global_key`` a key is unique over the whole table and may
    move between partitions; otherwise it is unique within its partition.
    """

    keys: tuple[str, ...]
    order_by: tuple[str, ...] = ()
    tie_breakers: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    storage: str = COW
    policy: str = OVERWRITE_LATEST
    global_key: bool = False
    strict_ties: bool = False
    target_file_bytes: int = 1024 * MIB
    small_file_bytes: int = 64 * MIB
    rewrite_bytes: int = 256 * MIB
    sort_bytes: int = 512 * MIB

    def __post_init__(self):
        for name in ("keys", "order_by", "tie_breakers", "partition_by"):
            value = getattr(self, name)
            value = (value,) if isinstance(value, str) else value
            object.__setattr__(self, name, tuple(c.lower() for c in value))
        if not self.keys:
            raise ValueError("a keyed table needs at least one key column")
        if self.storage not in (COW, MOR):
            raise ValueError(f"storage must be {COW!r} or {MOR!r}, not {self.storage!r}")
        if self.policy not in (OVERWRITE_LATEST, EVENT_TIME):
            raise ValueError(f"unknown merge policy {self.policy!r}")
        if self.policy == EVENT_TIME and not self.order_by:
            raise ValueError("event_time needs an ordering column")

    @property
    def identity(self) -> tuple[str, ...]:
        """Columns that decide whether two rows are the same record."""
        if self.global_key:
            return self.keys
        return tuple(dict.fromkeys((*self.partition_by, *self.keys)))

    def with_(self, **changes) -> "TableSpec":
        return replace(self, **changes)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "TableSpec":
        return cls(**json.loads(text))
