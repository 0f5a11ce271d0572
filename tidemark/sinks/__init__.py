from .catalog import create_ddl, drop_from_catalog, keep_synced, register_view, sync_catalog
from .manifest import (
    latest_files,
    manifest_counts,
    manifest_entries,
    manifest_text,
    read_manifest,
    write_manifest,
)

__all__ = [
    "create_ddl", "drop_from_catalog", "keep_synced", "latest_files", "manifest_counts", "manifest_entries",
    "manifest_text", "read_manifest", "register_view", "sync_catalog", "write_manifest",
]
