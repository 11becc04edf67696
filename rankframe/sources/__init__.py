"""Tables, splits and fitted state on storage."""

from rankframe.sources.buckets import BucketedTable, append_buckets, open_buckets, write_buckets
from rankframe.sources.catalog import TableCatalog
from rankframe.sources.days import WrittenDay, read_days, write_days, written_days
from rankframe.sources.splits import (
    read_optional_split,
    read_split,
    write_projected,
    write_split,
)
from rankframe.sources.state import (
    PreprocessorState,
    load_artifacts,
    publish_artifacts,
    publish_state,
    published_state,
    write_artifacts,
)
from rankframe.sources.versions import Version, open_version, publish, versions

__all__ = [
    "BucketedTable",
    "PreprocessorState",
    "TableCatalog",
    "Version",
    "WrittenDay",
    "append_buckets",
    "load_artifacts",
    "open_buckets",
    "open_version",
    "publish",
    "publish_artifacts",
    "publish_state",
    "published_state",
    "read_days",
    "read_optional_split",
    "read_split",
    "versions",
    "write_artifacts",
    "write_buckets",
    "write_days",
    "write_projected",
    "write_split",
    "written_days",
]
