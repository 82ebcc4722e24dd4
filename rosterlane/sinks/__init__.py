"""Writing snapshots and reports."""

from rosterlane.sinks.files import export_report, lay_out, shared_folder, write_snapshot
from rosterlane.sinks.published import publish_day, published_runs, read_published

__all__ = [
    "export_report",
    "lay_out",
    "publish_day",
    "published_runs",
    "read_published",
    "shared_folder",
    "write_snapshot",
]
