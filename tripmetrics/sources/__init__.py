"""Reading and writing. Only this package and ``plans.jobs`` touch storage."""

from tripmetrics.sources.folders import delete
from tripmetrics.sources.reading import (
    layouts,
    load_year,
    month_paths,
    read_months,
    read_staged,
    read_table,
    read_zones,
)
from tripmetrics.sources.shared import cleanup, shared_path, store
from tripmetrics.sources.writing import (
    add_partitions,
    check_table,
    copy_parquet,
    drop_partitions,
    publish_table,
    register_table,
    write_observed,
    write_partitions,
    write_table,
)

__all__ = [
    "add_partitions",
    "check_table",
    "cleanup",
    "copy_parquet",
    "delete",
    "drop_partitions",
    "layouts",
    "load_year",
    "month_paths",
    "publish_table",
    "read_months",
    "read_staged",
    "read_table",
    "read_zones",
    "register_table",
    "shared_path",
    "store",
    "write_observed",
    "write_partitions",
    "write_table",
]
