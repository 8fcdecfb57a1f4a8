"""Sinks: partitioned tables, exports and reports."""

from pagemark.sinks.reports import (  # noqa: F401
    evaluation_markdown,
    job_markdown,
    productivity_markdown,
    progress_markdown,
    write_lines,
)
from pagemark.sinks.results import read_results, write_results  # noqa: F401
from pagemark.sinks.stores import scan_store, update_store, write_store  # noqa: F401
from pagemark.sinks.tables import (  # noqa: F401
    latest_version,
    write_annotations,
    write_annotator_views,
    write_csv,
    write_json,
    write_version,
)
