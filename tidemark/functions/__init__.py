from .keys import (
    any_null,
    derive_keys,
    lowercase_columns,
    partition_path,
    partition_values,
    record_key,
    require_keys,
)
from .local import local_frame
from .scratch import delete_path, list_folder, path_bytes, path_exists, scratch_dir
from .text import letter, metric_name, metric_table, parse_list, parse_timestamp, to_number

__all__ = [
    "any_null", "delete_path", "derive_keys", "letter", "list_folder", "local_frame", "lowercase_columns", "metric_name",
    "metric_table", "parse_list", "parse_timestamp", "partition_path", "partition_values",
    "path_bytes", "path_exists", "record_key", "require_keys", "scratch_dir", "to_number",
]
