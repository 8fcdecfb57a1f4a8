"""Whole workflows composed from the operators."""

from pagemark.plans.workflows import (  # noqa: F401
    cleanup,
    evaluate_annotations,
    evaluate_predictions,
    export_columns,
    export_folder,
    fill,
    prepare,
    track,
)
