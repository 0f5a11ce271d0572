from .events import event_struct, file_events, kafka_events, kafka_options, parse_events
from .files import full_load, jdbc_options, json_records, read_files, read_jdbc
from .records import generated_records, spread_month

__all__ = [
    "event_struct", "file_events", "full_load", "generated_records", "jdbc_options", "json_records",
    "kafka_events", "kafka_options", "parse_events", "read_files", "read_jdbc", "spread_month",
]
