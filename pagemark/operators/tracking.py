"""Assignments of pages to two annotators: creation, status updates and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemark.functions.text import from_template, is_blank, percent
from pagemark.operators.confusion import with_overall
from pagemark.operators.pages import PAGE_KEY
from pagemark.schemas import ANNOTATORS, ASSIGNMENT_COLUMNS, resolve_page_id

SLOTS = (1, 2)
# Where a share keeps page images and label files.
IMAGE_TEMPLATE = "{share}\\annotation_images\\{case_id}_{page_id}.jpeg"
LABEL_TEMPLATE = "{share}\\annotation_labels\\{case_id}_{page_id}.xlsx"


def done(slot: int) -> str:
    return f"has_assignee{slot}_completed"


def is_done(slot: int) -> Column:
    return F.coalesce(F.lower(done(slot)) == "yes", F.lit(False))


def two_annotators(annotators) -> list[str]:
    names = list(annotators or [])
    if len(names) < 2:
        return list(ANNOTATORS)
    if len(names) > 2:
        raise ValueError(f"an assignment has two slots, got {names}")
    return names


def tracking_rows(
    pages: DataFrame,
    share: str,
    annotators=None,
    image_template: str = IMAGE_TEMPLATE,
    label_template: str = LABEL_TEMPLATE,
) -> DataFrame:
    """A fresh assignment per page: file paths, both annotators, nothing done, no notes."""
    first, second = two_annotators(annotators)
    names = {"share": F.lit(share), "case_id": "case_id", "page_id": "page_id"}
    return pages.select(
        "case_id",
        "page_id",
        from_template(image_template, **names).alias("image_file_path"),
        from_template(label_template, **names).alias("label_file_path"),
        F.lit(first).alias("assignee1"),
        F.lit("no").alias("has_assignee1_completed"),
        F.lit(second).alias("assignee2"),
        F.lit("no").alias("has_assignee2_completed"),
        F.lit("").alias("notes"),
    )


def annotator_view(assignments: DataFrame) -> DataFrame:
    """One row per page and slot with that slot's assignee and status only."""
    slots = F.array(
        *[
            F.struct(
                F.lit(s).alias("slot"),
                F.col(f"assignee{s}").alias("assignee"),
                F.col(done(s)).alias("has_completed"),
            )
            for s in SLOTS
        ]
    )
    hidden = [c for s in SLOTS for c in (f"assignee{s}", done(s))]
    kept = [c for c in assignments.columns if c not in hidden and c != "notes"]
    return assignments.select(*kept, F.explode(slots).alias("_s"), "notes").select(
        "_s.slot", *kept, "_s.assignee", "_s.has_completed", "notes"
    )


def case_index(assignments: DataFrame, annotators=None, suffix: str = "") -> DataFrame:
    """Pages per case and the place of each annotator's part of it, sorted by case."""
    links = [
        F.concat(F.lit(f"{a}/"), F.col("case_id"), F.lit(suffix)).alias(a)
        for a in two_annotators(annotators)
    ]
    return (
        assignments.groupBy("case_id")
        .agg(F.count(F.lit(1)).alias("num_images"))
        .select("case_id", "num_images", *links)
        .orderBy("case_id")
    )


def status_known(columns: list[str]) -> Column:
    """Whether all status columns say yes or no."""
    good = F.lit(True)
    for c in columns:
        good = good & F.coalesce(F.lower(c).isin("yes", "no"), F.lit(False))
    return good


def rejected_updates(updates: DataFrame) -> DataFrame:
    """Updates with a status other than yes or no."""
    return updates.filter(~status_known(["status"]))


def apply_updates(assignments: DataFrame, updates: DataFrame, ord: str = "ord") -> DataFrame:
    """Apply a batch of status updates; the latest one for a slot wins.

    A blank annotator means both slots. Updates are folded per (page, annotator) before they meet
    the assignments, so a page with very many updates is one row then. Adds `slot_writes`: how many
    single updates hit the row's slots.
    """
    assignments = resolve_page_id(assignments)
    updates = resolve_page_id(updates)
    valid = updates.filter(status_known(["status"]))
    who = F.when(~is_blank("annotator", False), F.col("annotator"))
    folded = (
        valid.select(*PAGE_KEY, who.alias("_who"), F.lower("status").alias("_status"), F.col(ord).alias("_ord"))
        .groupBy(*PAGE_KEY, "_who")
        .agg(
            F.max(F.struct("_ord", "_status")).alias("_last"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    both = folded.filter(F.col("_who").isNull()).select(
        *PAGE_KEY, F.col("_last").alias("_last0"), F.col("_n").alias("_n0")
    )
    out = assignments.join(both, PAGE_KEY, "left")
    named = folded.filter(F.col("_who").isNotNull())
    for s in SLOTS:
        mine = named.select(
            *PAGE_KEY,
            F.col("_who").alias(f"assignee{s}"),
            F.col("_last").alias(f"_last{s}"),
            F.col("_n").alias(f"_n{s}"),
        )
        out = out.join(mine, [*PAGE_KEY, f"assignee{s}"], "left")
    writes = F.coalesce("_n0", F.lit(0)) * len(SLOTS)
    for s in SLOTS:
        writes = writes + F.coalesce(f"_n{s}", F.lit(0))
        latest = F.greatest("_last0", f"_last{s}")
        out = out.withColumn(done(s), F.coalesce(latest["_status"], F.col(done(s))))
    return out.withColumn("slot_writes", writes).select(*assignments.columns, "slot_writes")


def set_status(
    assignments: DataFrame,
    status: str = "yes",
    case_ids=None,
    page_ids=None,
    annotators=None,
) -> DataFrame:
    """Set the status of the slots that meet every given condition; at least one is needed.

    A condition is a list, or a one-column DataFrame for long lists. Adds `slot_writes`.
    """
    status = status.lower()
    if status not in ("yes", "no"):
        raise ValueError(f"status must be yes or no, not {status!r}")
    if case_ids is None and page_ids is None and annotators is None:
        raise ValueError("give case_ids, page_ids or annotators")
    assignments = resolve_page_id(assignments)
    out = assignments

    def matches(column: str, wanted) -> Column:
        nonlocal out
        if wanted is None:
            return F.lit(True)
        if isinstance(wanted, DataFrame):
            mark = f"_in_{column}"
            listed = wanted.toDF(column).distinct().withColumn(mark, F.lit(True))
            out = out.join(listed, column, "left")
            return F.col(mark).isNotNull()
        return F.coalesce(F.col(column).isin(list(wanted)), F.lit(False))

    page_hit = matches("case_id", case_ids) & matches("page_id", page_ids)
    hits = {s: page_hit & matches(f"assignee{s}", annotators) for s in SLOTS}
    writes = sum((F.when(h, 1).otherwise(0) for h in hits.values()), F.lit(0))
    out = out.withColumn("slot_writes", writes.cast("bigint"))
    for s, hit in hits.items():
        out = out.withColumn(done(s), F.when(hit, F.lit(status)).otherwise(F.col(done(s))))
    return out.select(*assignments.columns, "slot_writes")


def progress(assignments: DataFrame, overall: str = "all") -> DataFrame:
    """Pages, pages done per slot and by both with percentages, per case and overall."""
    sums = ["total", "completed1", "completed2", "completed_both"]
    per_case = assignments.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_done(1)).alias("completed1"),
        F.count_if(is_done(2)).alias("completed2"),
        F.count_if(is_done(1) & is_done(2)).alias("completed_both"),
    )
    out = with_overall(per_case, "case_id", [], sums, overall)
    return out.select(
        "level",
        "case_id",
        *sums,
        *[percent(c, "total").alias(f"{c}_pct") for c in sums[1:]],
    )


def productivity(assignments: DataFrame) -> DataFrame:
    """Pages assigned to and completed by each annotator over both slots."""
    combos = assignments.groupBy(
        "assignee1", "assignee2", is_done(1).alias("_d1"), is_done(2).alias("_d2")
    ).agg(F.count(F.lit(1)).alias("_n"))
    slots = F.array(
        *[
            F.struct(F.col(f"assignee{s}").alias("annotator"), F.col(f"_d{s}").alias("done"))
            for s in SLOTS
        ]
    )
    return (
        combos.select(F.explode(slots).alias("_s"), "_n")
        .groupBy(F.col("_s.annotator").alias("annotator"))
        .agg(
            F.sum("_n").alias("assigned"),
            F.sum(F.when(F.col("_s.done"), F.col("_n")).otherwise(0)).alias("completed"),
        )
        .withColumn("completion_rate", percent("completed", "assigned"))
    )


def assignment_columns(df: DataFrame) -> DataFrame:
    """The assignment columns in file order, further columns after them."""
    extra = [c for c in df.columns if c not in ASSIGNMENT_COLUMNS]
    return df.select(*[c for c in ASSIGNMENT_COLUMNS if c in df.columns], *extra)
