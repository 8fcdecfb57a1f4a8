"""Markdown reports as DataFrames of ordered lines.

Tables in a report have a row per case or document, which may be many, so lines are formatted by
Spark and written as text; only the order is fixed by a final sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemark.functions.text import column, report_time

# Headings and table heads of the reports, word for word.
PROGRESS_TITLE = "# Annotation Progress Report"
PROGRESS_TOTALS = "## Overall Statistics"
PROGRESS_CASES = "## Progress by Case"
PROGRESS_HEAD = "| Case ID | Total Images | Annotator 1 | Annotator 2 | Both Complete |"
PROGRESS_RULE = "|---------|--------------|-------------|-------------|---------------|"
PRODUCTIVITY_TITLE = "# Annotator Productivity Report"
PRODUCTIVITY_SECTION = "## Annotator Statistics"
PRODUCTIVITY_HEAD = "| Annotator | Assigned | Completed | Completion Rate |"
PRODUCTIVITY_RULE = "|-----------|----------|-----------|----------------|"
JOB_TOTALS = "## Summary Statistics"
JOB_FILES = "## Per-File Details"
EVALUATION_TITLE = "# NER Evaluation Report"
EVALUATION_SUMMARY = "## Evaluation Summary"
EVALUATION_METRICS = "## Overall Performance Metrics"
EVALUATION_TOKENS = "### Token-Level Performance (Flat Label Comparison)"
EVALUATION_FLAT = "### Entity Classification (Flat Labels)"
EVALUATION_BIO = "### Entity Classification (BIO Format)"
EVALUATION_SEQUENCES = "### Sequence-Level NER Performance"
EVALUATION_ERRORS = "## Error Analysis"
EVALUATION_CONFUSIONS = "### Top Confusion Patterns"
CONFUSIONS_HEAD = "| True Label → Predicted Label | Count |"
CONFUSIONS_RULE = "|-------------------------------|-------|"
EVALUATION_AGREEMENT = "## Inter-Annotator Agreement"
EVALUATION_FILES = "## Per-File Performance Summary"
FILES_HEAD = "| File | Token Accuracy | Entity F1 (Flat) | Entity F1 (BIO) | Total Tokens |"
FILES_RULE = "|------|----------------|------------------|-----------------|-------------|"


def _share(part, whole) -> Column:
    part, whole = column(part), column(whole)
    rate = F.coalesce(F.try_divide(part.cast("double") * 100, whole.cast("double")), F.lit(0.0))
    return F.format_string("%d/%d (%.1f%%)", part, whole, rate)


def _fixed(spark: SparkSession, section: int, *texts: str) -> DataFrame:
    rows = F.posexplode(F.array(*[F.lit(t) for t in texts])).alias("ord", "line")
    return spark.range(1).select(
        F.lit(section).alias("section"), rows
    ).select("section", F.format_string("%09d", F.col("ord")).alias("ord"), "line")


def _lines(df: DataFrame, section: int, order, line: Column) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"),
        column(order).cast("string").alias("ord"),
        line.alias("line"),
    )


def _bullets(df: DataFrame, section: int, bullets: list[Column]) -> DataFrame:
    """Several lines from a one-row frame."""
    return df.select(
        F.lit(section).alias("section"), F.posexplode(F.array(*bullets)).alias("_o", "line")
    ).select("section", F.format_string("%09d", F.col("_o")).alias("ord"), "line")


def _report(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def write_lines(report: DataFrame, path: str) -> None:
    """Write a report's lines in order."""
    report.orderBy("section", "ord").select("line").write.mode("errorifexists").text(path)


def progress_markdown(progress: DataFrame) -> DataFrame:
    """Report of `operators.tracking.progress`."""
    spark = progress.sparkSession
    overall = progress.filter(F.col("level") == "overall")
    cases = progress.filter(F.col("level") == "group")
    done = ["completed1", "completed2", "completed_both"]
    names = ["Annotator 1 completion", "Annotator 2 completion", "Both annotators completion"]
    return _report(
        [
            _fixed(spark, 0, PROGRESS_TITLE),
            _bullets(spark.range(1), 1, [F.concat(F.lit("Generated: "), report_time()), F.lit("")]),
            _fixed(spark, 2, PROGRESS_TOTALS),
            _bullets(
                overall,
                3,
                [
                    F.format_string("- Total images: %d", F.col("total")),
                    *[
                        F.concat(F.lit(f"- {n}: "), _share(c, "total"))
                        for n, c in zip(names, done)
                    ],
                    F.lit(""),
                ],
            ),
            _fixed(
                spark,
                4,
                PROGRESS_CASES,
                PROGRESS_HEAD,
                PROGRESS_RULE,
            ),
            _lines(
                cases,
                5,
                "case_id",
                F.format_string(
                    "| %s | %d | %s | %s | %s |",
                    F.col("case_id"),
                    F.col("total"),
                    *[_share(c, "total") for c in done],
                ),
            ),
        ]
    )


def productivity_markdown(productivity: DataFrame) -> DataFrame:
    """Report of `operators.tracking.productivity`."""
    spark = productivity.sparkSession
    rate = F.try_divide(F.col("completed").cast("double") * 100, F.col("assigned").cast("double"))
    return _report(
        [
            _fixed(spark, 0, PRODUCTIVITY_TITLE),
            _bullets(spark.range(1), 1, [F.concat(F.lit("Generated: "), report_time()), F.lit("")]),
            _fixed(
                spark,
                2,
                PRODUCTIVITY_SECTION,
                PRODUCTIVITY_HEAD,
                PRODUCTIVITY_RULE,
            ),
            _lines(
                productivity,
                3,
                "annotator",
                F.format_string(
                    "| %s | %d | %d | %.1f%% |",
                    F.col("annotator"),
                    F.col("assigned"),
                    F.col("completed"),
                    rate,
                ),
            ),
        ]
    )


def job_markdown(
    statistics: DataFrame, title: str, scope: str, measures: dict[str, str]
) -> DataFrame:
    """Report of a batch job's statistics: totals, then one table row per document.

    ``measures`` maps columns to their headings.
    """
    spark = statistics.sparkSession
    overall = statistics.filter(F.col("level") == "overall")
    documents = statistics.filter(F.col("level") == "group")
    headings = ["File", *measures.values()]
    return _report(
        [
            _fixed(spark, 0, f"# {title}", "", JOB_TOTALS),
            documents.agg(
                F.format_string("- **Files Processed**: %d", F.count(F.lit(1))).alias("line")
            ).select(F.lit(1).alias("section"), F.lit("0").alias("ord"), "line"),
            _bullets(
                overall,
                2,
                [
                    F.format_string(f"- **Total {heading}**: %,d", F.col(c))
                    for c, heading in measures.items()
                ],
            ),
            _fixed(
                spark,
                3,
                "",
                JOB_FILES,
                "",
                f"| {' | '.join(headings)} |",
                f"|{'|'.join('-' * (len(h) + 2) for h in headings)}|",
            ),
            _lines(
                documents,
                4,
                scope,
                F.format_string(
                    "| %s |" + " %,d |" * len(measures), F.col(scope), *[F.col(c) for c in measures]
                ),
            ),
        ]
    )


def evaluation_markdown(
    frames: dict[str, DataFrame], annotator: str, scope: str = "file"
) -> DataFrame:
    """Report of `plans.workflows.evaluate_annotations`; the list of errors shows the first ten."""
    spark = frames["summary"].sparkSession

    def overall(name: str) -> DataFrame:
        return frames[name].filter(F.col("level") == "overall")

    def number(label: str, c: str) -> Column:
        return F.format_string(f"- **{label}**: %.3f", F.col(c))

    def count(label: str, c: str) -> Column:
        return F.format_string(f"- **{label}**: %,d", F.col(c))

    def files(name: str, *columns: str) -> DataFrame:
        return frames[name].filter(F.col("level") == "group").select(scope, *columns)

    per_file = (
        files("averages_flat", "accuracy", "weighted_f1", "total")
        .join(files("averages_bio", F.col("weighted_f1").alias("bio_f1")), scope, "left")
    )
    pairs = frames["error_pairs"]
    # with one annotator there is nothing to agree with
    agreement = [] if "kappa" not in frames else [
        _fixed(spark, 12, "", EVALUATION_AGREEMENT),
        _bullets(
            overall("kappa"),
            13,
            [
                number("Cohen's Kappa", "kappa_score"),
                number("Agreement Percentage", "agreement_percentage"),
                count("Total Dual Annotations", "total_dual_annotations"),
            ],
        ),
    ]
    parts = [
        _fixed(spark, 0, EVALUATION_TITLE, "", EVALUATION_SUMMARY),
        _bullets(
            frames["summary"],
            1,
            [
                count("Total Files Evaluated", "total_files"),
                F.lit(f"- **Ground Truth Annotator**: {annotator}"),
                count("Total Entity Labels", "total_entity_labels"),
            ],
        ),
        _fixed(spark, 2, "", EVALUATION_METRICS, "",
               EVALUATION_TOKENS),
        _bullets(
            overall("averages_flat"),
            3,
            [
                number("Token Accuracy", "accuracy"),
                count("Total Tokens", "total"),
                count("Correct Predictions", "correct"),
                F.lit(""),
                F.lit(EVALUATION_FLAT),
                number("Accuracy", "accuracy"),
                number("Macro F1-Score", "macro_f1"),
                number("Weighted F1-Score", "weighted_f1"),
                number("Macro Precision", "macro_precision"),
                number("Macro Recall", "macro_recall"),
                F.lit(""),
            ],
        ),
        _bullets(
            overall("averages_bio"),
            4,
            [
                F.lit(EVALUATION_BIO),
                number("Accuracy", "accuracy"),
                number("Macro F1-Score", "macro_f1"),
                number("Weighted F1-Score", "weighted_f1"),
                F.lit(""),
            ],
        ),
        _fixed(spark, 5, EVALUATION_SEQUENCES),
        _bullets(
            frames["sequence_accuracy"],
            6,
            [number("Sequence Accuracy", "sequence_accuracy"),
             count("Total Sequences", "total_sequences")],
        ),
        _bullets(
            frames["sequence_scores"].filter(F.col("scope") == "micro"),
            7,
            [number("Sequence F1-Score", "f1"), F.lit("")],
        ),
        _fixed(spark, 8, EVALUATION_ERRORS),
        _bullets(
            frames["error_rate"],
            9,
            [count("Total Errors", "total_errors"), number("Error Rate", "error_rate"), F.lit("")],
        ),
        _fixed(spark, 10, EVALUATION_CONFUSIONS, "",
               CONFUSIONS_HEAD,
               CONFUSIONS_RULE),
        _lines(
            pairs.orderBy(F.col("n").desc(), "truth", "pred").limit(10),
            11,
            F.concat(F.format_string("%019d", F.lit(10**18) - F.col("n")), "truth",
                     F.lit("\u0000"), "pred"),
            F.format_string("| %s → %s | %d |", F.col("truth"), F.col("pred"), F.col("n")),
        ),
        *agreement,
        _fixed(spark, 14, "", EVALUATION_FILES, "",
               FILES_HEAD,
               FILES_RULE),
        _lines(
            per_file,
            15,
            scope,
            F.format_string("| %s | %.3f | %.3f | %.3f | %,d |", F.col(scope), F.col("accuracy"),
                            F.col("weighted_f1"), F.coalesce("bio_f1", F.lit(0.0)), F.col("total")),
        ),
    ]
    return _report(parts)
