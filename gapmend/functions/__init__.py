from gapmend.functions.conform import (
    SchemaMismatch,
    conform,
    conform_with_rejects,
    project_to_target,
    rejects,
    schema_drift,
    widen_decimals,
)
from gapmend.functions.stamps import (
    business_day,
    change_envelope,
    file_name,
    partition_stamp,
    run_day,
    split_path,
)

__all__ = [
    "SchemaMismatch",
    "business_day",
    "change_envelope",
    "conform",
    "conform_with_rejects",
    "file_name",
    "partition_stamp",
    "project_to_target",
    "rejects",
    "run_day",
    "schema_drift",
    "split_path",
    "widen_decimals",
]
