from millrace.sources.stages import run_stages
from millrace.sources.storage import (
    discard,
    normalize_names,
    read_parquet,
    read_parquet_widened,
    read_table,
    stage,
    staged_job,
    staging_path,
    table_name,
    write_connector,
    write_parquet,
)
from millrace.sources.tables import land_raw, point_published, publish_tables, published, read_published, replace_table

__all__ = [
    "discard",
    "land_raw",
    "normalize_names",
    "point_published",
    "publish_tables",
    "published",
    "read_parquet",
    "read_parquet_widened",
    "read_published",
    "read_table",
    "replace_table",
    "run_stages",
    "stage",
    "staged_job",
    "staging_path",
    "table_name",
    "write_connector",
    "write_parquet",
]
