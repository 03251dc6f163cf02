from gapmend.sinks.files import replace_files, stage, write_files
from gapmend.sinks.rewrite import RewriteReport, rewrite_duplicates
from gapmend.sinks.tables import (
    append_dynamic,
    append_once,
    append_static,
    avro_file_extension,
    avro_table_ddl,
    create_avro_table,
    create_table,
    declare_landing,
    drop_null_partition,
    drop_partition,
    null_partition_rows,
    partition_names,
    partition_states,
    sync_partitions,
    table_schema,
)

__all__ = [
    "RewriteReport",
    "append_dynamic",
    "append_once",
    "append_static",
    "avro_file_extension",
    "avro_table_ddl",
    "create_avro_table",
    "create_table",
    "declare_landing",
    "drop_null_partition",
    "drop_partition",
    "null_partition_rows",
    "partition_names",
    "partition_states",
    "replace_files",
    "rewrite_duplicates",
    "stage",
    "sync_partitions",
    "table_schema",
    "write_files",
]
