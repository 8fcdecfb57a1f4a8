"""Merkle manifest by time-forward processing: digests climb to the roots, proof suffixes come down.

Every tree is cut into blocks of 16 ** 3 consecutive nodes, and blocks are dealt to tasks, each sorted by node
label. A label is (last node covered, level), so children come before their parents. A task sweeps over the
sorted nodes of its blocks; what a node has for its parent goes into a priority queue ordered by label
and comes out when the sweep reaches the parent. The sort is Spark's, which spills; the queue holds the
pending runs of one block and no more. The roots of the blocks are the nodes of the next round. Then the
rounds are swept in reverse, from the root down: a parent sends each child the siblings' digests, followed
by all that came to the parent itself, and a leaf receives its whole proof.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagemark.llm.common import stored

#: Nodes of a run, levels of a block, and so nodes of a block.
RUN, LEVELS = 16, 3
BLOCK = RUN**LEVELS
#: Leaves handed on together; each holds its whole proof.
PORTION = 512
PROOF = "array<struct<before:string,after:string>>"
_PROOF_ARROW = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def leaf_digest(*fields: Column) -> Column:
    """sha256 of the fields: `-` for NULL, else the byte count, a colon and the value."""
    coded = []
    for field in fields:
        text = field.cast("string")
        coded.append(
            F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        )
    return F.sha2(F.concat(*coded), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    return F.aggregate(proof, digest, lambda d, s: F.sha2(F.concat(s.before, d, s.after), 256))


def proof_text(proof: Column) -> Column:
    """All sibling digests of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s.before, s.after)), "")


def block_shape(size: int, height: int, block: int) -> tuple[int, int]:
    """Nodes and levels of a block, `height` blocks above the leaves of a tree of `size` leaves."""
    nodes = -(-size // BLOCK**height)
    if nodes > BLOCK:
        return min(BLOCK, nodes - block * BLOCK), LEVELS
    levels = 0
    while RUN**levels < nodes:
        levels += 1
    return nodes, levels


def label(level: int, index: int, nodes: int) -> tuple[int, int]:
    return min((index + 1) * RUN**level, nodes) - 1, level


def climb(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    """Nodes in label order -> the nodes above them with their children's digests; `top` is a block's root."""
    at, queue = None, []
    for batch in batches:
        rows = []
        columns = (batch.column(i).to_pylist() for i in range(batch.num_columns))
        for tree, block, place, digest, size in zip(*columns, strict=True):
            if at != (tree, block):
                at, queue = (tree, block), []
                nodes, top = block_shape(size, height, block)
            if top == 0:
                rows.append((tree, block, place, 0, True, size, digest, digest))
                continue
            heappush(queue, (*label(1, place // RUN, nodes), place % RUN, digest))
            # all children of a node whose last leaf this is have been delivered
            while queue and queue[0][0] == place:
                level, children = queue[0][1], []
                while queue and queue[0][:2] == (place, level):
                    children.append(heappop(queue)[3])
                joined = "".join(children)
                digest = hashlib.sha256(joined.encode()).hexdigest()
                rows.append((tree, block, place, level, level == top, size, digest, joined))
                if level < top:
                    index = place // RUN**level
                    heappush(queue, (*label(level + 1, index // RUN, nodes), index % RUN, digest))
        if rows:
            names = ["tree", "block", "place", "level", "top", "size", "digest", "children"]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )


def descend(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    """The same nodes against the label order, each block after its own proof -> a proof for every leaf."""
    queue, nodes, subroot, size = [], 0, None, 0
    for batch in batches:
        found, proofs, subroots, sizes = [], [], [], []
        kept = batch.column("kept")
        names = ["tree", "block", "place", "level", "children", "size", "proof", "subroot"]
        columns = (batch.column(n).to_pylist() for n in names)

        def portion() -> pa.RecordBatch:
            out = {
                "tree": batch.column("tree").take(pa.array(found)),
                "pos": pa.array(positions, pa.int64()),
                "size": pa.array(sizes, pa.int64()),
                "subroot": pa.array(subroots, pa.string()),
                "proof": pa.array(proofs, _PROOF_ARROW),
                "kept": kept.take(pa.array(found)),
            }
            return pa.RecordBatch.from_pydict(out)

        positions = []
        for i, (_, block, place, level, children, total, proof, top_digest) in enumerate(zip(*columns, strict=True)):
            if proof is not None:
                # the proof of the block's root comes first
                nodes, top = block_shape(total, height, block)
                queue, subroot, size = [(-(nodes - 1), -top, proof)], top_digest, total
                continue
            suffix = heappop(queue)[2]
            if level == 0:
                found.append(i)
                positions.append(block * BLOCK + place)
                proofs.append(suffix)
                subroots.append(subroot)
                sizes.append(size)
                if len(found) == PORTION:
                    yield portion()
                    found, proofs, subroots, sizes, positions = [], [], [], [], []
                continue
            first = place // RUN**level * RUN
            for j in range(len(children) // 64):
                end, below = label(level - 1, first + j, nodes)
                siblings = {"before": children[: 64 * j], "after": children[64 * (j + 1) :]}
                heappush(queue, (-end, -below, [siblings, *suffix]))
        if found:
            yield portion()


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """`nodes` with pos (from 0) and size by tree, in the given order; ties in any order.

    Rows are dealt to ranges of the whole order, numbered in each, and the counts of the ranges before are
    added, so no task sees a whole tree.
    """
    rows = stored(nodes.withColumn("_salt", F.monotonically_increasing_id()), "merkle_rows")
    ranges = rows.repartitionByRange("tree", *order, "_salt").withColumn("_part", F.spark_partition_id())
    ranges = stored(ranges, "merkle_ranges")
    counts = ranges.groupBy("tree", "_part").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree",
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("size"),
    )
    row = F.row_number().over(Window.partitionBy("tree", "_part").orderBy(*order, "_salt"))
    return (
        ranges.withColumn("_row", row)
        .join(counts, ["tree", "_part"])
        .withColumn("pos", F.col("_before") + F.col("_row") - 1)
        .drop("_salt", "_part", "_row", "_before")
    )


def swept(rows: DataFrame, *order: Column | str) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *order)


def build(nodes: DataFrame) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame | None]:
    """Rounds of (nodes, nodes above them), and the root of every tree; None without any node.

    `nodes` has tree, pos, size, digest and kept, a struct that is handed on to the proofs.
    """
    largest = nodes.agg(F.max("size")).first()[0]
    rounds, roots = [], None
    schema = "tree string, block long, place int, level int, top boolean, size long, digest string, children string"
    while largest is not None:
        height = len(rounds)
        place = (F.col("pos") % BLOCK).cast("int")
        block = F.floor(F.col("pos") / BLOCK)
        nodes = nodes.select("tree", block.alias("block"), place.alias("place"), "digest", "size", "kept")
        rows = swept(nodes.drop("kept"), "place").select("tree", "block", "place", "digest", "size")
        above = stored(rows.mapInArrow(lambda b, h=height: climb(b, h), schema), "merkle_nodes")
        rounds.append((nodes, above))
        tops = above.where("top")
        unfinished = F.col("size") > BLOCK ** (height + 1)
        done = tops.where(~unfinished).select("tree", "size", "digest")
        roots = done if roots is None else roots.unionByName(done)
        if largest <= BLOCK ** (height + 1):
            break
        nodes = tops.where(unfinished).select(
            "tree", F.col("block").alias("pos"), "size", "digest", F.struct(F.lit(0).alias("none")).alias("kept")
        )
    return rounds, roots


def proofs_of(rounds: list[tuple[DataFrame, DataFrame]], tops: DataFrame) -> DataFrame:
    """tree, pos, size, subroot, proof, kept for every leaf; `tops` has tree, size, subroot and proof of the roots."""
    found = None
    for height in reversed(range(len(rounds))):
        nodes, above = rounds[height]
        in_round = F.col("size") <= BLOCK ** (height + 1)
        if height:
            in_round &= F.col("size") > BLOCK**height
        heads = tops.where(in_round).select("tree", F.lit(0).cast("long").alias("block"), "size", "subroot", "proof")
        if found is not None:
            heads = heads.unionByName(found.select("tree", F.col("pos").alias("block"), "size", "subroot", "proof"))
        kind = nodes.schema["kept"].dataType
        no_kept = F.lit(None).cast(kind).alias("kept")
        no_proof = F.lit(None).cast(PROOF).alias("proof")
        no_text = F.lit(None).cast("string")
        rows = (
            heads.select("tree", "block", F.lit(BLOCK).alias("place"), F.lit(LEVELS + 1).alias("level"), no_text.alias("children"), "size", "proof", "subroot", no_kept)
            .unionByName(
                above.where("level > 0").select("tree", "block", "place", "level", "children", "size", no_proof, no_text.alias("subroot"), no_kept)
            )
            .unionByName(
                nodes.select("tree", "block", "place", F.lit(0).alias("level"), no_text.alias("children"), "size", no_proof, no_text.alias("subroot"), "kept")
            )
        )
        schema = StructType().add("tree", "string").add("pos", "long").add("size", "long").add("subroot", "string")
        schema = schema.add("proof", heads.schema["proof"].dataType).add("kept", kind)
        found = swept(rows, F.desc("place"), F.desc("level")).mapInArrow(lambda b, h=height: descend(b, h), schema)
    return found


def manifest(leaves: DataFrame, tree: str = "source", order: str = "doc_id", digest: str = "leaf") -> DataFrame:
    """`leaves` with subroot (of their tree), root (of all trees) and proof.

    The leaves of a tree ascend by `order`, then by digest. While a tree has several nodes, every 16 in a row (the last
    ones may be fewer, also one) are replaced by the sha256 of their hex digests, one behind the other; a
    lone leaf is its own subroot. The subroots, ordered by the tree's name, make the root in the same way. A
    proof lists the siblings before and after the leaf's own path, level by level up to the root.

    NULL names a tree of its own, ordered first, and NULL `order` comes first in a tree. Rows that share
    `order` and digest are leaves of their own, in any order. An empty table has no root and gives no rows.
    The other columns of `leaves` are handed on through the sweep, so they should be small; those named
    subroot, root or proof are replaced.
    """
    leaves = leaves.drop("subroot", "root", "proof")
    named = leaves.select(
        F.coalesce(F.concat(F.lit("s"), F.col(tree).cast("string")), F.lit("n")).alias("tree"),
        F.col(order).alias("_order"),
        F.col(digest).alias("digest"),
        F.struct(*[F.col(f"`{c}`") for c in leaves.columns]).alias("kept"),
    )
    nodes = stored(numbered(named, ["_order", "digest"]).drop("_order"), "merkle_leaves")
    rounds, roots = build(nodes)
    if roots is None:
        return leaves.select("*", *[F.lit(None).cast("string").alias(c) for c in ("subroot", "root")], F.lit(None).cast(PROOF).alias("proof"))
    upper = roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("_name"), "digest", F.struct("tree", "size", "digest").alias("kept")
    )
    upper = stored(numbered(upper, ["_name"]).drop("_name"), "merkle_subroots")
    upper_rounds, top = build(upper)
    root = top.first().digest
    above = top.select("tree", "size", F.col("digest").alias("subroot"), F.array().cast(PROOF).alias("proof"))
    tops = proofs_of(upper_rounds, above).select(
        "kept.tree", "kept.size", F.col("kept.digest").alias("subroot"), "proof"
    )
    found = proofs_of(rounds, stored(tops, "merkle_tops"))
    return found.select("kept.*", "subroot", F.lit(root).alias("root"), "proof")
