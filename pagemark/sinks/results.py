"""All results of one run in one folder: configuration, summary, frames, and a manifest that comes last."""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_MANIFEST, _CONFIG, _SUMMARY = "manifest.json", "config.json", "summary.json"


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there in whole or not at all: it gets its name when it is closed."""
    part, system = _files(spark, f"{path}.part")
    stream = system.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not system.rename(part, _files(spark, path)[0]):
        raise FileExistsError(path)


def _read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def _plain(value):
    """A value as JSON has it; what is no number is null there."""
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value if value is None or isinstance(value, (bool, int, float, str)) else str(value)


def one_row(frames: dict[str, DataFrame], names: list[str]) -> dict:
    """The columns of one-row frames side by side, later ones last; an empty frame has none."""
    out = {}
    for name in names:
        rows = frames[name].limit(2).collect()
        if len(rows) > 1:
            raise ValueError(f"{name} has more than one row")
        for row in rows:
            out.update({k: _plain(v) for k, v in row.asDict().items()})
    return out


def write_results(
    frames: dict[str, DataFrame], path: str, config: dict, summary: list[str] = ()
) -> dict:
    """Write a run to `path` and return its manifest.

    ``config`` is what the run was called with. ``summary`` names frames of one row whose columns make
    `summary.json`; they are written as frames, too. Every frame is computed by the pass that writes it, and
    that pass counts its rows. The manifest (rows and schema of each frame) is written last: without it the
    run has not ended, and `read_results` does not take it. An existing run is never written over.
    """
    spark = next(iter(frames.values())).sparkSession if frames else SparkSession.active()
    manifest, system = _files(spark, f"{path}/{_MANIFEST}")
    if system.exists(manifest):
        raise FileExistsError(f"{path} holds a finished run")
    _write_text(spark, f"{path}/{_CONFIG}", json.dumps(config, indent=2, default=str))
    written = {}
    for name, frame in frames.items():
        counted = Observation(f"rows of {name}")
        observed = frame.observe(counted, F.count(F.lit(1)).alias("rows"))
        observed.write.mode("errorifexists").parquet(f"{path}/frames/{name}")
        written[name] = {"rows": counted.get["rows"], "schema": json.loads(frame.schema.json())}
    stored = {name: spark.read.parquet(f"{path}/frames/{name}") for name in summary}
    _write_text(spark, f"{path}/{_SUMMARY}", json.dumps(one_row(stored, list(summary)), indent=2))
    _write_text(spark, f"{path}/{_MANIFEST}", json.dumps({"frames": written}, indent=2))
    return {"frames": written}


def read_results(spark: SparkSession, path: str) -> tuple[dict, dict, dict[str, DataFrame]]:
    """Configuration, summary and frames of a finished run.

    A folder without a manifest is a run that has not ended or has failed, and an error; so is a frame that the
    manifest names and that is not there.
    """
    manifest, system = _files(spark, f"{path}/{_MANIFEST}")
    if not system.exists(manifest):
        raise FileNotFoundError(f"no finished run in {path}")
    known = json.loads(_read_text(spark, f"{path}/{_MANIFEST}"))["frames"]
    missing = [n for n in known if not system.exists(_files(spark, f"{path}/frames/{n}/_SUCCESS")[0])]
    if missing:
        raise FileNotFoundError(f"{path} lacks {', '.join(sorted(missing))}")
    frames = {name: spark.read.parquet(f"{path}/frames/{name}") for name in known}
    return json.loads(_read_text(spark, f"{path}/{_CONFIG}")), json.loads(_read_text(spark, f"{path}/{_SUMMARY}")), frames
