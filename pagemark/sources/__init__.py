"""Scans: files as they lie on disk become the tables the operators expect."""

from pagemark.sources.files import (  # noqa: F401
    file_position,
    list_files,
    scan_annotations,
    scan_assignments,
    scan_datasets,
    scan_images,
    scan_json_pages,
    scan_pages,
    scan_predictions,
    scan_tokens,
    scan_updates,
)
