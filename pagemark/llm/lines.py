"""Line dedup: equal lines by hash, near-equal ones by a segment-partition edit join. SQL functions only.

A line within `edits` edits of a shorter or equally long one holds at least one of the edits + 1 segments
the other is cut into, near the segment's place. So every line files its segments under (length,
number, content), and probes the segments of all lengths it may reach at the few shifts that leave enough
edits for either side. A pair that meets is compared by letter counts inside the join, and what is left is
verified: a bit vector over the band of diagonals moves along the shorter line, one per number of edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemark.llm.common import stored

#: Lines shorter than this are only compared for equality.
NEAR_FROM = 30
#: What is trimmed off both ends of a line before it is compared.
BLANKS = " \t\r\x0b\x0c"
#: Letters whose counts are compared inside the join, a byte for each.
LETTERS = "etainsro"
#: Line keys up to this number may be broadcast, at some 30 bytes each.
BROADCAST_ROWS = 1_000_000
_LINE_BITS = 1 << 31


def row_place(docs: DataFrame) -> Column:
    """A decimal that orders rows by doc_id, NULL last, and tells rows of one id by their texts."""
    text = F.xxhash64("text")
    known = F.col("doc_id").cast("decimal(20,0)") * F.lit(_LINE_BITS).cast("decimal(10,0)") + text.bitwiseAND(
        _LINE_BITS - 1
    ).cast("decimal(10,0)")
    unknown = F.lit(str(1 << 95)).cast("decimal(30,0)") + text.bitwiseAND((1 << 63) - 1).cast("decimal(20,0)")
    row = F.when(F.col("doc_id").isNotNull(), known).otherwise(unknown)
    return (row * F.lit(_LINE_BITS).cast("decimal(10,0)")).cast("decimal(38,0)")


def raw_lines(docs: DataFrame) -> DataFrame:
    """row, line_no, line of every line that is not blank."""
    found = docs.select(row_place(docs).alias("row"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "raw"))
    return found.select("row", "line_no", F.trim("raw", F.lit(BLANKS)).alias("line")).where("line <> ''")


def lines_of(docs: DataFrame) -> DataFrame:
    """place, line, h1, h2, size for every line that is not blank.

    `place` orders all lines by document and line number, NULL doc_id last, in one decimal.
    """
    return raw_lines(docs).select(
        _place().alias("place"),
        "line",
        F.xxhash64("line").alias("h1"),
        _second_hash().alias("h2"),
        F.char_length("line").alias("size"),
    )


def _place() -> Column:
    return (F.col("row") + F.col("line_no").cast("decimal(10,0)")).cast("decimal(38,0)")


def _second_hash() -> Column:
    return F.xxhash64(F.lit(7), "line")


def letter_counts(line: Column) -> Column:
    total = F.lit(0).cast("long")
    for i, letter in enumerate(LETTERS):
        # letters are bytes of their own, so the characters need not be counted
        held = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))
        total = total.bitwiseOR(F.shiftleft(held.cast("long").bitwiseAND(255), 8 * i))
    return total


def counts_apart(a: Column, b: Column) -> Column:
    """Sum of the letters' differences, modulo 256 each; an edit moves it by two at most."""
    total = F.lit(0)
    for i in range(len(LETTERS)):
        x, y = (F.shiftrightunsigned(c, 8 * i).bitwiseAND(255) for c in (a, b))
        apart = F.abs(x - y)
        total = total + F.least(apart, 256 - apart)
    return total


def _segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Where segment i of a line of this length begins, and how long it is; the last ones are longer."""
    base = F.floor(length / parts).cast("int")
    longer = length - base * parts  # so many segments have one character more
    begin = i * base + F.greatest(F.lit(0), i - (parts - longer))
    return begin, base + F.when(F.lit(i) >= parts - longer, 1).otherwise(0)


def segment_keys(line: Column, size: Column, edits: int) -> Column:
    """What a line is filed under."""
    keys = []
    for i in range(edits + 1):
        begin, length = _segment(size, i, edits + 1)
        keys.append(F.xxhash64(size, F.lit(i), F.substr(line, begin + 1, length)))
    return F.array(*keys)


def probe_keys(line: Column, size: Column, edits: int, near_from: int) -> Column:
    """Where a line looks for shorter lines, and for equally long ones at shifted places.

    With i segments to the left, at most i edits may lie there, and edits - i to the right. Places
    outside the line and lengths below `near_from` give NULL.
    """
    keys = []
    for shorter in range(edits + 1):
        target = size - shorter
        for i in range(edits + 1):
            begin, length = _segment(target, i, edits + 1)
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1):
                if shorter == 0 and shift == 0:
                    continue  # met among the filed keys themselves
                at = begin + shift
                inside = (at >= 0) & (at + length <= size) & (target >= near_from)
                key = F.xxhash64(target, F.lit(i), F.substr(line, at + 1, length))
                keys.append(F.when(inside, key))
    return F.array(*keys)


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether two lines are at most `edits` edits apart, by bit vectors over a band of diagonals.

    Bit d + edits of vector e is set if e edits can turn what was read of `a` into as many characters of
    `b` plus d. Reading a character of `a` keeps the diagonals where `b` has the same one (no edit), all
    diagonals (substitution), or moves them down by one (deletion); an insertion moves them up.
    """
    band = 2 * edits + 1
    full = (1 << band) - 1
    chars, other = (F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0)) for c in (a, b))
    # beside every character of `a`, those of `b` on all diagonals of the band
    gap = F.lit(None).cast("string")
    diagonals = [
        F.concat(F.array_repeat(gap, -d), other) if d < 0 else F.slice(other, d + 1, F.size(other))
        for d in range(-edits, edits + 1)
    ]
    items = F.slice(F.arrays_zip(chars, *diagonals), F.lit(1), F.size(chars))

    def insert(vectors: list[Column]) -> list[Column]:
        out = [vectors[0]]
        for e in range(1, edits + 1):
            out.append(vectors[e].bitwiseOR(F.shiftleft(out[e - 1], 1).bitwiseAND(full)))
        return out

    names = [f"v{e}" for e in range(edits + 1)]

    def state(vectors: list[Column]) -> Column:
        return F.struct(*[v.alias(n) for v, n in zip(insert(vectors), names, strict=True)])

    def step(acc: Column, item: Column) -> Column:
        same = F.lit(0)
        for d in range(band):
            same = same.bitwiseOR(F.when(item["0"] == item[str(d + 1)], 1 << d).otherwise(0))
        out = [acc[names[0]].bitwiseAND(same)]
        for e in range(1, edits + 1):
            before = acc[names[e - 1]]
            out.append(
                acc[names[e]].bitwiseAND(same).bitwiseOR(before).bitwiseOR(F.shiftright(before, 1))
            )
        return state(out)

    last = F.size(other) - F.size(chars) + edits

    def finish(acc: Column) -> Column:
        reached = acc[names[0]]
        for n in names[1:]:
            reached = reached.bitwiseOR(acc[n])
        return reached

    reached = F.aggregate(items, state([F.lit(1 << edits)] + [F.lit(0)] * edits), step, finish)
    marks = F.array(*[F.lit(1 << d) for d in range(band)])
    near = reached.bitwiseAND(F.get(marks, last)) != 0
    return F.when(F.abs(F.size(other) - F.size(chars)) <= edits, near).otherwise(F.lit(False))


def candidate_pairs(lines: DataFrame, edits: int, near_from: int) -> DataFrame:
    """Pairs of line hashes that share a segment and nearly the same letters: a, b."""
    line, size = F.col("line"), F.col("size")
    # letters are counted and segments hashed once, and read twice
    long = stored(
        lines.where(size >= near_from).select(
            F.col("h1").alias("id"),
            letter_counts(line).alias("letters"),
            segment_keys(line, size, edits).alias("filed"),
            probe_keys(line, size, edits, near_from).alias("probes"),
        ),
        "line_segments",
    )

    def keyed(keys: str) -> DataFrame:
        rows = long.select("id", "letters", F.explode(keys).alias("key")).where("key is not null")
        # a line that occurs often files its segments once; each task brings them down before the shuffle
        return rows.groupBy("key", "id", "letters").agg(F.lit(1).alias("one")).drop("one")

    filed, probes = keyed("filed"), keyed("probes")

    def meet(other: DataFrame, once: bool) -> DataFrame:
        x, y = filed.alias("x"), other.alias("y")
        on = (F.col("x.key") == F.col("y.key")) & (
            counts_apart(F.col("x.letters"), F.col("y.letters")) <= 2 * edits
        )
        different = F.col("x.id") < F.col("y.id") if once else F.col("x.id") != F.col("y.id")
        return x.join(y, on & different).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))

    pairs = meet(filed, True).unionByName(meet(probes, False))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_lines(docs: DataFrame, edits: int, near_from: int) -> DataFrame:
    """Links between different lines within `edits` edits: h1, h2 of both and their first places."""
    pairs = stored(candidate_pairs(lines_of(docs), edits, near_from), "line_pairs")
    chosen = pairs.select(F.col("a").alias("h1")).union(pairs.select("b")).distinct()
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    # all but one hash is worked out for the lines that are chosen
    found = raw_lines(docs).withColumn("h1", F.xxhash64("line")).join(chosen, "h1", "left_semi")
    texts = stored(
        found.where(F.char_length("line") >= near_from)
        .groupBy("h1", _second_hash().alias("h2"))
        .agg(F.first("line").alias("line"), F.min(_place()).alias("place")),
        "line_texts",
    )
    a = texts.select(F.col("h1").alias("a"), F.col("h2").alias("a2"), F.col("line").alias("line_a"), F.col("place").alias("place_a"))
    b = texts.select(F.col("h1").alias("b"), F.col("h2").alias("b2"), F.col("line").alias("line_b"), F.col("place").alias("place_b"))
    both = pairs.join(a, "a").join(b, "b")
    return both.where(within_edits(F.col("line_a"), F.col("line_b"), edits)).select(
        "a", "a2", "place_a", "b", "b2", "place_b"
    )


def dedup_lines(docs: DataFrame, edits: int = 1, near_from: int = NEAR_FROM) -> DataFrame:
    """`docs` with repeated lines taken out of `text`, plus n_lines and n_kept (lines that are not blank).

    Lines are what line feeds separate, compared without the white space at their ends. In the order of
    doc_id and line number, a line goes if an earlier line is equal to it, or at most `edits` edits (of
    characters) away, kept or not; the shorter of such a pair has at least `near_from` characters. Blank
    lines stay, and so a text without repeated lines comes back unchanged. NULL text has no lines and stays
    NULL; a text all of whose lines go is left with its blank lines. NULL doc_id comes last. Rows are told by doc_id
    and text, so rows that are equal in both count as one document, and their lines stay in all of them. Other
    columns stay as they are, those named n_lines or n_kept are replaced.
    """
    docs = docs.drop("n_lines", "n_kept")
    named = docs.select("doc_id", "text")
    near = near_lines(named, edits, near_from)
    later = stored(
        near.select(
            F.when(F.col("place_a") > F.col("place_b"), F.struct(F.col("a").alias("h1"), F.col("a2").alias("h2")))
            .otherwise(F.struct(F.col("b").alias("h1"), F.col("b2").alias("h2")))
            .alias("line")
        )
        .select("line.*")
        .distinct(),
        "later_lines",
    )
    firsts = lines_of(named).groupBy("h1", "h2").agg(F.min("place").alias("place"))
    number = F.pmod("place", F.lit(_LINE_BITS).cast("decimal(10,0)")).cast("decimal(10,0)")
    kept = (
        firsts.join(later, ["h1", "h2"], "left_anti")
        .select((F.col("place") - number).cast("decimal(38,0)").alias("_doc"), number.cast("int").alias("line_no"))
        .groupBy("_doc")
        .agg(F.collect_set("line_no").alias("_kept"))
    )
    parts = F.split("text", "\n", -1)
    blank = F.filter(
        F.transform("_parts", lambda x, i: F.when(F.trim(x, F.lit(BLANKS)) == "", i)),
        lambda i: i.isNotNull(),
    )
    numbers = F.array_sort(F.array_union(F.col("_blank"), F.coalesce("_kept", F.array().cast("array<int>"))))
    return (
        docs.withColumn("_doc", row_place(docs))
        .join(kept, "_doc", "left")
        .withColumn("_parts", parts)
        .withColumn("_blank", blank)
        .withColumn("_numbers", F.filter(numbers, lambda i: i < F.size("_parts")))
        .withColumn("text", F.array_join(F.transform("_numbers", lambda i: F.get("_parts", i)), "\n"))
        .withColumn("n_lines", F.coalesce(F.size("_parts") - F.size("_blank"), F.lit(0)).cast("long"))
        .withColumn("n_kept", F.coalesce(F.size("_numbers") - F.size("_blank"), F.lit(0)).cast("long"))
        .select(*docs.columns, "n_lines", "n_kept")
    )
