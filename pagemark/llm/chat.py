"""Chat formatting: a finite-state machine over roles, segments with loss flags, and the way back.

Only SQL functions. A conversation becomes one text, as a document is one text: its size is bounded
by what one row may hold.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How turns are written: `opening` role `divider` text `closing`.

    `escapes` replaces the control strings inside roles and texts, in this order; the backslash comes
    first, so that afterwards a backslash occurs only as the first character of a code. Codes are two
    characters long, thus undoing them in reverse order gives the text back. `moves` holds the state
    machine over roles: (state, role) -> state; a role that has no move is a violation and leaves the
    state as it is.
    """

    opening: str = "### "
    divider: str = ": "
    closing: str = "</turn>\n"
    escapes: tuple[tuple[str, str], ...] = (
        ("\\", "\\s"),
        ("###", "\\h"),
        ("</turn>", "\\e"),
    )
    role_escapes: tuple[tuple[str, str], ...] = ((":", "\\c"),)
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    final: tuple[str, ...] = ("answered",)
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "briefed",
            ("start", "user"): "asked",
            ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )


def _swap(text: Column, pairs, back: bool = False) -> Column:
    for plain, code in reversed(pairs) if back else pairs:
        text = F.replace(text, F.lit(code if back else plain), F.lit(plain if back else code))
    return text


def escape(text: Column, t: Template) -> Column:
    return _swap(text, t.escapes)


def unescape(text: Column, t: Template) -> Column:
    return _swap(text, t.escapes, back=True)


def _order_check(turns: Column, t: Template) -> Column:
    """Run the state machine: the last state and the places of the roles that had no move."""
    moves = F.create_map(
        *[F.lit(x) for (state, role), to in t.moves.items() for x in (f"{state}>{role}", to)]
    )

    def step(acc: Column, turn: Column) -> Column:
        to = F.try_element_at(moves, F.concat(acc.state, F.lit(">"), turn.role))
        bad = F.when(to.isNull(), F.lit(1)).otherwise(F.lit(0))
        return F.struct(
            F.coalesce(to, acc.state).alias("state"),
            (acc.violations + bad).alias("violations"),
        )

    return F.aggregate(
        turns, F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("violations")), step
    )


def format_conversations(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """`rows(conv_id, turn, role, text)` -> one row per conversation.

    Columns: conv_id, n_turns, formatted (the text), segments (array of text, loss), state and
    violations of the turn-order machine, valid. Rows are ordered by turn, then role, then text, NULLs
    first, so equal turns have a defined order and repeated rows stay. NULL role or text: empty. Rows
    with NULL conv_id form one conversation. Conversations that break the turn order are formatted as
    well; `valid` tells them apart. Other columns of `rows` are ignored.
    """
    t = template or Template()
    turns = rows.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "turn",
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                )
            )
        ).alias("turns")
    )

    def piece(turn: Column) -> Column:
        role = _swap(escape(turn.role, t), t.role_escapes)
        head = F.concat(F.lit(t.opening), role, F.lit(t.divider))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn.text, t).alias("text"), turn.role.isin(*t.learned).alias("loss")),
            F.struct(F.lit(t.closing).alias("text"), F.lit(False).alias("loss")),
        )

    out = turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.flatten(F.transform("turns", piece)).alias("segments"),
        _order_check(F.col("turns"), t).alias("machine"),
    )
    return out.select(
        "conv_id",
        "n_turns",
        "segments",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        F.col("machine.state").alias("state"),
        F.col("machine.violations").alias("violations"),
        ((F.col("machine.violations") == 0) & F.col("machine.state").isin(*t.final)).alias("valid"),
    )


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """The turns in a formatted text: array of role, text, with escapes undone."""
    t = template or Template()
    # closing strings occur only at the ends of turns, as those inside texts are escaped
    parts = F.split(formatted, "\\Q" + t.closing + "\\E")
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def parse(part: Column) -> Column:
        head = F.substring_index(part, t.divider, 1)
        role = F.substr(head, F.lit(len(t.opening) + 1))
        text = F.substr(part, F.char_length(head) + F.lit(len(t.divider) + 1))
        return F.struct(
            unescape(_swap(role, t.role_escapes, back=True), t).alias("role"),
            unescape(text, t).alias("text"),
        )

    return F.transform(parts, parse)


def read_loss_text(segments: Column, template: Template | None = None) -> Column:
    """All text under the loss flags, escapes undone, nothing between."""
    t = template or Template()
    marked = F.filter(segments, lambda s: s.loss)
    return F.array_join(F.transform(marked, lambda s: unescape(s.text, t)), "")
