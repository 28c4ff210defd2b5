"""Writers: stored tables (overwrite, upsert, clustered, DDL), documents, their
commit point and read-back validation (K1-K7)."""

from .documents import load_documents_overwrite, stage_documents
from .keyed import (
    keyed_layout,
    read_keyed_table,
    rows_of_key,
    upsert_keyed_table,
    write_keyed_table,
)
from .tables import (
    bucket_bytes,
    checksum,
    commit,
    conform,
    create_result_tables,
    even_buckets,
    hot_keys,
    load_table_overwrite,
    own_table,
    point_table,
    register_clustered,
    result_table_statements,
    result_tables_ddl,
    stage_clustered,
    stage_range_clustered,
    stage_table,
    upsert_by_key,
    upsert_frames,
    write_clustered_by_key,
)
from .validate import Written, validate_stored_counts
from .versions import ConflictError, latest, publish, table_entry, table_folders, vacuum

__all__ = [
    "ConflictError", "Written", "bucket_bytes", "checksum", "commit", "conform",
    "create_result_tables", "even_buckets", "hot_keys", "keyed_layout", "latest",
    "load_documents_overwrite", "load_table_overwrite", "own_table", "point_table", "publish",
    "read_keyed_table", "register_clustered", "result_table_statements", "result_tables_ddl",
    "rows_of_key", "stage_clustered", "stage_documents", "stage_range_clustered", "stage_table",
    "table_entry", "table_folders", "upsert_by_key", "upsert_frames", "upsert_keyed_table",
    "vacuum", "validate_stored_counts", "write_clustered_by_key", "write_keyed_table",
]
