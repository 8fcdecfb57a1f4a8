"""Label expressions: class-id decoding and B-/I- prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemark.functions.text import column, is_blank, stripped, whole_number


def decode(pred, vocabulary: list[str], missing: str, numeric: bool = False) -> Column:
    """Label of a class id.

    An id outside the vocabulary gives ``UNK_<id>``, text that is no integer stays as it is, NULL
    gives ``missing``. A numeric column (``numeric``) is truncated to an integer first, as ids turn
    into floats when a column has gaps. The vocabulary, a fixed model property, is a literal array:
    a lookup needs neither a join nor a broadcast.
    """
    pred = column(pred)
    labels = F.array(*[F.lit(v) for v in vocabulary])
    if numeric:
        value = pred.cast("double")
        pred = F.when(~F.isnan(value), value.cast("bigint"))
    text = pred.cast("string")
    number = whole_number(text)
    unknown = (
        F.when(text.isNull(), F.lit(missing))
        .when(number.isNull(), text)
        .otherwise(F.concat(F.lit("UNK_"), number.cast("string")))
    )
    # nearly every row ends at the lookup, which gives NULL for an index out of range
    return F.coalesce(F.get(labels, whole_number(text, "int")), unknown)


def has_prefix(c: Column) -> Column:
    return c.startswith("B-") | c.startswith("I-")


def strip_bio(label) -> Column:
    """Entity type of a BIO tag; flat labels pass, a missing one is ``O``."""
    named = F.regexp_replace(F.coalesce(column(label), F.lit("nan")), "^nan$", "O")
    return F.regexp_replace(stripped(named), "^[BI]-", "")


def flat_label(label) -> Column:
    """A label ready for BIO conversion: trimmed, every kind of blank is ``O``."""
    c = column(label)
    return F.when(is_blank(c), F.lit("O")).otherwise(stripped(c))


def bio_type(tag) -> Column:
    """Entity type of a tag inside a sequence: NULL for ``O``; a tag without prefix is a type of its own."""
    c = column(tag)
    return (
        F.when(c == "O", F.lit(None).cast("string"))
        .when(has_prefix(c), F.substring(c, 3, 1 << 30))
        .otherwise(F.concat(F.lit("bare:"), c))
    )
