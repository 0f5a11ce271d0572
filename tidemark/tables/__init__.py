from .keyed_table import KeyedTable
from .log import CommitLog

__all__ = ["CommitLog", "KeyedTable"]
