"""Table schemas and id-column resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Columns of a token file as written by the document model, in file order.
TOKEN_FILE_COLUMNS = ["image_id", "block_ids", "word_ids", "words", "bboxes", "labels", "pred", "prob"]
PAGE_COLUMNS = ["case_id", "page_id"]
ASSIGNMENT_COLUMNS = [
    "case_id",
    "page_id",
    "image_file_path",
    "label_file_path",
    "assignee1",
    "has_assignee1_completed",
    "assignee2",
    "has_assignee2_completed",
    "notes",
]
UPDATE_COLUMNS = ["case_id", "image_id", "annotator", "status"]
PREDICTION_REQUIRED = ["bboxes", "pred", "prob", "labels"]
ANNOTATORS = ("annotator1", "annotator2")

# Every column is text at rest; numbers are cast where they are used, so `pred` never changes type
# from one file to the next.
TOKEN_FILE = T.StructType(_strings(*TOKEN_FILE_COLUMNS))
PAGES = T.StructType(_strings(*PAGE_COLUMNS))
ASSIGNMENTS = T.StructType(_strings(*ASSIGNMENT_COLUMNS))
UPDATES = T.StructType(_strings(*UPDATE_COLUMNS))


def page_column(columns: list[str]) -> str:
    """The column holding the page id: `page_id`, else `image_id`, else the first one."""
    for name in ("page_id", "image_id"):
        if name in columns:
            return name
    return columns[0]


def resolve_page_id(df: DataFrame) -> DataFrame:
    """Give the page id its one name, `page_id`."""
    return df.withColumnRenamed(page_column(df.columns), "page_id")


def require_columns(df: DataFrame, names, what: str = "table") -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


def annotator_column(annotator: str) -> str:
    if annotator not in ANNOTATORS:
        raise ValueError(f"annotator must be one of {ANNOTATORS}, not {annotator!r}")
    return f"{annotator}_label"
