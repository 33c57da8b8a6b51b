from .declared import declare, declare_sql, read_log, rule_totals
from .feeds import track_changes
from .merge import create_or_upsert, upsert
from .partitioned import create_partitioned
from .tables import (
    append_evolving,
    declare_view,
    materialize,
    overwrite_files,
    publish_version,
    recover_table,
    register_table,
    reused,
    stored,
    table_detail,
)

__all__ = [
    "append_evolving",
    "create_or_upsert",
    "create_partitioned",
    "declare",
    "declare_sql",
    "declare_view",
    "materialize",
    "overwrite_files",
    "publish_version",
    "read_log",
    "recover_table",
    "register_table",
    "reused",
    "rule_totals",
    "stored",
    "table_detail",
    "track_changes",
    "upsert",
]
