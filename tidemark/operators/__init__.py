from .counts import affected_rows, count_all, counted, observed, partition_counts
from .merge import (
    blank_values,
    delete_candidates,
    delete_candidates_semi,
    delete_where,
    hard_delete,
    merge_on_read,
    newest_delta,
    pending_changes,
    soft_delete,
    update_where,
    upsert,
)
from .precombine import precombine, precombine_window, tied_keys
from .schema import (
    SchemaDiff,
    SchemaMismatch,
    changes_report,
    conform,
    diff_schemas,
    evolve,
    fill_missing,
    is_valid,
    validate,
    widen,
    without_metadata,
)

__all__ = [
    "SchemaDiff", "SchemaMismatch", "affected_rows", "blank_values", "changes_report", "conform",
    "count_all", "counted", "delete_candidates", "delete_candidates_semi", "delete_where",
    "diff_schemas", "evolve", "fill_missing", "hard_delete", "is_valid", "merge_on_read",
    "newest_delta", "observed", "partition_counts", "pending_changes", "precombine",
    "precombine_window", "soft_delete", "tied_keys", "update_where", "upsert", "validate",
    "widen", "without_metadata",
]
