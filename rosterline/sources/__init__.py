from .landing import as_type, clean_table, land_tables, read_tab, tab_names, typed
from .records import read_records
from .rejects import Landed, TooManyRejects, judged, land_typed, read_landed, read_rejects
from .tables import (default_shared_dir, exists, read, read_first, read_table, register,
                     save_table, scratch, scratch_path, settle, settle_by, staged_overwrite,
                     stored_max, write, write_partitions)
from .versions import (CommitConflict, commit, latest, new_version, open_version, read_version,
                       stage_version, version_path, versions, write_version)

__all__ = [
    "CommitConflict", "Landed", "TooManyRejects", "as_type", "clean_table", "commit",
    "default_shared_dir", "exists", "judged", "land_tables", "land_typed", "latest",
    "new_version", "open_version", "read", "read_first", "read_landed", "read_records", "read_rejects", "read_tab", "read_table",
    "read_version", "register", "save_table", "scratch", "scratch_path", "settle", "settle_by",
    "stage_version", "staged_overwrite", "stored_max", "tab_names", "typed", "version_path",
    "versions", "write", "write_partitions", "write_version",
]
