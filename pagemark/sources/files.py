"""CSV, JSON, image and Parquet scans of the annotation workflow."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemark.functions.text import file_stem, real_number
from pagemark.operators.tracking import status_known
from pagemark.schemas import (
    PREDICTION_REQUIRED,
    TOKEN_FILE_COLUMNS,
    require_columns,
    resolve_page_id,
)

# Where a case keeps its files, below the folder of cases.
TOKEN_FILES = "*/processing/form-recogniser/df_check.csv"
IMAGE_FILES = "*/images/*.jpeg"
JSON_FILES = "*/extracted_text_json/*.json"
# Suffixes of the files that count as datasets.
DATASET_SUFFIXES = (".csv", ".json", ".parquet")
_CORRUPT = "_corrupt_record"
_PATH = "_metadata.file_path"
_SPLIT_BITS = 12


def file_position() -> Column:
    """Row order inside a file as one number.

    The start of the split in units of 4 KB tells the splits of a file apart, and the lower 33 bits of
    the running id count rows inside a task. Smaller splits are an error, except at the end of a file.
    Valid right after a scan only.
    """
    start = F.col("_metadata.file_block_start").cast("bigint")
    length = F.col("_metadata.file_block_length").cast("bigint")
    ends = start + length >= F.col("_metadata.file_size").cast("bigint")
    unit = F.shiftright(start, _SPLIT_BITS)
    split = F.when(ends | (length >= 1 << _SPLIT_BITS), unit).otherwise(
        F.raise_error(F.lit("splits of a file must hold 4 KB at least")).cast("bigint")
    )
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.shiftleft(split, 33).bitwiseOR(inside)


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _csv(spark: SparkSession, columns: list[str], multi_line: bool = False):
    """A CSV reader that checks every file's header against ``columns`` instead of trusting order."""
    return (
        spark.read.schema(_strings(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def _header(spark: SparkSession, path) -> list[str]:
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def _plain(path) -> Column:
    """A file path with its %XX codes undone; a plus sign is a plus sign."""
    return F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))


def _case_from(path, below: str) -> Column:
    return F.regexp_extract(path, rf"/([^/]+)/{below}/", 1)


def _single_layout(
    spark: SparkSession, path: str, columns: list[str], case_id, multi_line: bool
) -> DataFrame:
    raw = _csv(spark, columns, multi_line).csv(path)
    case = _case_from(_plain(_PATH), "processing") if case_id is None else case_id(F.col(_PATH))
    scanned = raw.select(case.alias("case_id"), "*", file_position().alias("pos"))
    out = scanned if "page_id" in columns else scanned.withColumnRenamed(
        "image_id" if "image_id" in columns else columns[0], "page_id"
    )
    if "prob" in columns:
        out = out.withColumn("prob_text", F.col("prob")).withColumn(
            "prob", real_number("prob")
        )
    return out


def scan_tokens(
    spark: SparkSession,
    cases_dir: str | None = None,
    layouts: dict[str, list[str]] | None = None,
    case_id=None,
    multi_line: bool = False,
) -> DataFrame:
    """Word predictions of all cases: one scan, the case id taken from the path.

    ``layouts`` maps path globs to the header of the files found there, for files whose columns
    differ; missing columns are NULL then. A file whose header does not match is an error.
    ``case_id`` turns the path column into the case id for other folder layouts. ``pos`` keeps the
    row order of a file, `prob_text` the probability as written.
    """
    layouts = layouts or {f"{cases_dir}/{TOKEN_FILES}": TOKEN_FILE_COLUMNS}
    out = None
    for path, columns in layouts.items():
        part = _single_layout(spark, path, columns, case_id, multi_line)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def scan_pages(spark: SparkSession, path: str, strip: bool = False) -> DataFrame:
    """The list of pages to annotate in file order, repetitions kept. ``strip`` removes quotes and
    spaces inside the ids."""
    header = _header(spark, path)
    df = resolve_page_id(_csv(spark, header).csv(path).select("*", file_position().alias("ord")))
    require_columns(df, ["case_id", "page_id"], "the page list")
    if strip:
        for c in ("case_id", "page_id"):
            df = df.withColumn(c, F.translate(c, '" ', ""))
    return df.select("case_id", "page_id", "ord")


def scan_assignments(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Assignments and quarantined rows; unknown columns are kept.

    A row goes to quarantine when its fields do not fit the header or a status is not yes or no.
    """
    header = _header(spark, path)
    schema = T.StructType([*_strings(header).fields, T.StructField(_CORRUPT, T.StringType())])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
    )
    raw = resolve_page_id(raw).na.fill("", ["notes"] if "notes" in header else [])
    status = ["has_assignee1_completed", "has_assignee2_completed"]
    require_columns(raw, ["case_id", "assignee1", "assignee2", *status], "the assignments")
    # one condition over status and record: the reader refuses queries on the record column alone
    fits = status_known(status) & F.col(_CORRUPT).isNull()
    return raw.filter(fits).drop(_CORRUPT), raw.filter(~fits)


def scan_updates(spark: SparkSession, path: str) -> DataFrame:
    """Status updates with their order in the file; without an annotator column all are for both."""
    header = _header(spark, path)
    df = resolve_page_id(_csv(spark, header).csv(path).select("*", file_position().alias("ord")))
    require_columns(df, ["case_id", "page_id", "status"], "the updates")
    if "annotator" not in df.columns:
        df = df.withColumn("annotator", F.lit(None).cast("string"))
    return df.select("case_id", "page_id", "annotator", "status", "ord")


def scan_predictions(spark: SparkSession, directory: str) -> DataFrame:
    """Prediction files of a folder, one page per file; `file` names the page."""
    path = f"{directory}/*.csv"
    header = _header(spark, path)
    missing = [c for c in PREDICTION_REQUIRED if c not in header]
    if missing:
        raise ValueError(f"prediction files lack columns {missing}")
    raw = _csv(spark, header).csv(path)
    return raw.select(
        "*", F.col("_metadata.file_name").alias("file"), file_position().alias("pos")
    ).withColumn("prob", real_number("prob"))


def scan_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Annotation documents written by `sinks.write_annotations`; `file` names the document.

    Ids are text, also those kept in folder names, where they look like numbers or dates.
    """
    ids = ("case_id", "page_id")
    found = spark.read.parquet(path).schema
    schema = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name in ids else f for f in found.fields]
    )
    return spark.read.schema(schema).parquet(path).withColumn("file", F.concat_ws("_", *ids))


def scan_json_pages(spark: SparkSession, cases_dir: str, files: str = JSON_FILES) -> DataFrame:
    """Extracted text of all pages: case_id, page_id and the document as text."""
    raw = spark.read.text(f"{cases_dir}/{files}", wholetext=True)
    return raw.select(
        _case_from(_plain(_PATH), "extracted_text_json").alias("case_id"),
        file_stem(F.col("_metadata.file_name")).alias("page_id"),
        F.col("value").alias("json"),
    )


def scan_images(spark: SparkSession, cases_dir: str, files: str = IMAGE_FILES) -> DataFrame:
    """Page images by path and size; the image bytes are never read."""
    raw = spark.read.format("binaryFile").load(f"{cases_dir}/{files}")
    return raw.select(
        _case_from("path", "images").alias("case_id"),
        file_stem("path").alias("page_id"),
        "path",
        "length",
        "modificationTime",
    )


def list_files(spark: SparkSession, folder: str, recursive: bool = False) -> list[str]:
    """Paths of the files in a folder of any file system Spark reads, in order; with ``recursive`` also
    those below. Names that begin with a dot or an underscore are left out, and so are the insides of
    folders that Spark has written (``name.parquet``), which count as one file each."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found, waiting = [], [root]
    while waiting:
        for status in system.listStatus(waiting.pop()):
            path = status.getPath()
            if path.getName().startswith((".", "_")):
                continue
            if status.isFile() or path.getName().endswith(DATASET_SUFFIXES):
                found.append(path.toString())
            elif recursive:
                waiting.append(path)
    return sorted(found)


def scan_datasets(
    spark: SparkSession, folder: str, recursive: bool = False
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Datasets of a folder by name (the path below the folder, without suffix), and why others failed.

    CSV files with a header, JSON lines and Parquet are read; other files are passed over. Only headers and
    schemas are looked at here. Two files of one name keep their suffix.
    """
    paths = [p for p in list_files(spark, folder, recursive) if p.endswith(DATASET_SUFFIXES)]
    base = spark._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath().rstrip("/") + "/"
    names = [p.partition(base)[2] for p in paths]
    stems = [n.rpartition(".")[0] for n in names]
    frames, failures = {}, {}
    for path, name, stem in zip(paths, names, stems):
        name = name if stems.count(stem) > 1 else stem
        try:
            if path.endswith(".csv"):
                frame = spark.read.option("header", True).option("escape", '"').csv(path)
            else:
                frame = spark.read.format(path.rpartition(".")[2]).load(path)
            if not frame.columns:
                raise ValueError("the dataset has no columns")
            frames[name] = frame
        except (AnalysisException, SparkRuntimeException, Py4JJavaError, ValueError) as e:
            failures[name] = str(e).strip().partition("\n")[0][:200]
    return frames, failures
