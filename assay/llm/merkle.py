"""Operator 11: a Merkle manifest of a dataset, with a proof for every row.

The leaves of a source stand in order of their keys; every 16 neighbours, level by level, become
one node until one is left, the source's subroot. The subroots, in order of their sources, give the
root. A row's proof is the siblings on its way to the root.

Trees are kept in blocks: aligned subtrees of ``BLOCK_LEVELS`` levels, each one binary value in van
Emde Boas layout. A subtree is split at half its height; its upper half is stored first and then the
lower subtrees from left to right, each split the same way again. Where a node lies follows from its
level and number by arithmetic alone, and so do its siblings, which lie together. The roots of blocks
are the leaves of the blocks above them, so the same step is applied to their table, a 4096th of
the size, until each source has one block.

Leaves are hashed in the JVM and dealt out by range, so a source of any size spreads over tasks;
their numbers follow from the rows of each task before. A block holds at most 4096 leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from assay.llm.common import staged

FANOUT = 16
BLOCK_LEVELS = 3
BLOCK_LEAVES = FANOUT**BLOCK_LEVELS
DIGEST = 32
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# Every such key, by its checksum, is folded from a tampered row.
TAMPER_EVERY = 5


def tree_size(height: int) -> int:
    """Nodes of a full tree of ``height`` levels of nodes."""
    return (FANOUT**height - 1) // (FANOUT - 1)


def address(height: int, level: int, number: np.ndarray) -> np.ndarray:
    """Place of the nodes ``number`` of ``level`` (0: the root) in a tree of ``height`` levels of nodes."""
    number = np.asarray(number, np.int64)
    if height == 1:
        return np.zeros_like(number)
    upper = height // 2
    if level < upper:
        return address(upper, level, number)
    lower = height - upper
    width = FANOUT ** (level - upper)  # nodes of this level in one lower subtree
    return tree_size(upper) + number // width * tree_size(lower) + address(lower, level - upper, number % width)


def _hash(parts: list[bytes]) -> bytes:
    """SHA-256 over digests written as lowercase hex."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def height_of(leaves: int, alone: bool) -> int:
    """Levels of nodes above the leaves of a block: what its leaves need, or all where others follow."""
    if not alone:
        return BLOCK_LEVELS
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FANOUT), levels + 1
    return levels


def build_block(leaves: list[bytes], levels: int) -> bytes:
    """The nodes over ``leaves`` in van Emde Boas layout, absent ones as zeros."""
    height = levels + 1
    block = np.zeros((tree_size(height), DIGEST), np.uint8)
    for level in range(levels, -1, -1):
        places = address(height, level, np.arange(len(leaves)))
        block[places] = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, DIGEST)
        if level:
            leaves = [_hash(leaves[i : i + FANOUT]) for i in range(0, len(leaves), FANOUT)]
    return block.tobytes()


class Siblings:
    """Siblings of the leaves of one block, by addresses in its layout."""

    def __init__(self, block: bytes, n_leaves: int):
        size, self.levels = len(block) // DIGEST, 0
        while tree_size(self.levels + 1) < size:
            self.levels += 1
        self.block, self.counts = block, [n_leaves]
        self.places = []
        for level in range(self.levels, 0, -1):
            self.places.append(address(self.levels + 1, level, np.arange(self.counts[-1])))
            self.counts.append(-(-self.counts[-1] // FANOUT))

    def of(self, leaf: int) -> list[tuple[int, bytes]]:
        """From the lowest level up: the node's place among its siblings, and these one after another."""
        out = []
        for places, count in zip(self.places, self.counts, strict=False):
            first = leaf - leaf % FANOUT
            last = min(first + FANOUT, count)
            # Siblings are leaves of one lowest subtree or roots of neighbouring ones.
            start, step = int(places[first]), int(places[first + 1] - places[first]) if last > first + 1 else 1
            parts = [
                self.block[(start + i * step) * DIGEST : (start + i * step + 1) * DIGEST]
                for i in range(last - first)
                if first + i != leaf
            ]
            out.append((leaf - first, b"".join(parts)))
            leaf //= FANOUT
        return out


def written(value: Column) -> Column:
    """A value as the leaf's input: ``-`` for null, else its bytes' number, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[written(v) for v in values]), 256))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _numbered(leaves: DataFrame) -> DataFrame:
    """``leaves`` (tree, key, leaf, place, ...) with their ``number`` in their tree, from 0.

    Rows are dealt out by range of (tree, key, leaf, place), written with their numbers within task
    and tree, and moved on by what earlier tasks hold of the tree: only the first tree of a task
    goes on from another task, so that is one number per task.
    """
    order = [F.asc_nulls_first("tree"), F.asc_nulls_first("key"), F.asc("leaf"), F.asc("place")]
    names = leaves.drop("place").columns
    out = StructType([*leaves.drop("place").schema.fields, *StructType.fromDDL("task int, run int, within long").fields])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, tree, run, following = TaskContext.get().partitionId(), None, -1, 0
        for batch in batches:
            runs, within = [], []
            for value in batch.column(batch.schema.get_field_index("tree")).to_pylist():
                if run < 0 or value != tree:
                    tree, run, following = value, run + 1, 0
                runs.append(run)
                within.append(following)
                following += 1
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            columns += [pa.array([task] * len(runs), pa.int32()), pa.array(runs, pa.int32()), pa.array(within, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    dealt = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    held = staged(dealt.mapInArrow(number, out), "numbered")
    # The first and last tree of each task: at most two rows a task.
    ends = (
        held.groupBy("task", "run")
        .agg(F.count("*").alias("n"), F.first("tree").alias("tree"))
        .withColumn("last", F.max("run").over(Window.partitionBy("task")))
        .where("run = 0 or run = last")
        .orderBy("task", "run")
        .collect()
    )
    carried, before = None, []
    for row in ends:
        goes_on = carried is not None and row["run"] == 0 and carried[0] == row["tree"]
        start = carried[1] if goes_on else 0
        if row["run"] == 0:
            before.append((row["task"], start))
        carried = (row["tree"], start + row["n"])
    moved = held.sparkSession.createDataFrame(before, "task int, before long")
    start = F.when(F.col("run") == 0, F.col("before")).otherwise(0)
    return (
        held.join(F.broadcast(moved), "task")
        .withColumn("number", F.col("within") + start)
        .drop("task", "run", "within", "before")
    )


def _blocks(leaves: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Rows (tree, number, leaf, ...) as blocks (tree, block, n, nodes, top), a list of each carried column."""
    block = F.floor(F.col("number") / F.lit(BLOCK_LEAVES)).cast("long")
    source = leaves.select("tree", block.alias("block"), "number", "leaf", *carried)
    lists = [StructField(c, ArrayType(source.schema[c].dataType)) for c in carried]
    out = StructType(
        [source.schema["tree"], *StructType.fromDDL("block long, n int, nodes binary, top binary").fields, *lists]
    )

    def build(table: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        table = table.sort_by("number").combine_chunks()
        leaves, block = table["leaf"].to_pylist(), table["block"][0].as_py()
        nodes = build_block(leaves, height_of(len(leaves), _alone(block, len(leaves))))
        values = [table["tree"][0].as_py(), block, len(leaves), nodes, nodes[:DIGEST]]
        values += [table[c].to_pylist() for c in carried]
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(values, target, strict=True)], schema=target)

    return staged(source.groupBy("tree", "block").applyInArrow(build, out), "blocks")


def _alone(block: int, leaves: int) -> bool:
    """Whether a block is its whole tree. A full first block may have others beside it; its levels
    are the same then, and the block over it holds one leaf, its own root."""
    return block == 0 and leaves < BLOCK_LEAVES


def _is_alone() -> Column:
    return (F.col("block") == 0) & (F.col("n") < BLOCK_LEAVES)


_STEPS = StructType(
    [StructField("places", ArrayType(IntegerType())), StructField("siblings", ArrayType(BinaryType()))]
)


def _steps_of_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each leaf of each block: the leaf's steps inside it, then the block's own."""
    for batch in batches:
        for row in batch.to_pylist():
            inside = Siblings(row["nodes"], row["n"])
            places, siblings = [], []
            for leaf in range(row["n"]):
                steps = inside.of(leaf)
                places.append([place for place, _ in steps] + row["places"])
                siblings.append([others for _, others in steps] + row["siblings"])
            first = row["block"] * BLOCK_LEAVES
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["tree"]] * row["n"], batch.schema.field("tree").type),
                    pa.array(range(first, first + row["n"]), pa.int64()),
                    pa.array(places, pa.list_(pa.int32())),
                    pa.array(siblings, pa.list_(pa.binary())),
                ],
                names=["tree", "number", "places", "siblings"],
            )


def _with_steps(blocks: DataFrame, above: DataFrame | None) -> DataFrame:
    """Blocks with the steps from their tops to their trees' roots."""
    none = [F.array().cast(f.dataType).alias(f.name) for f in _STEPS.fields]
    alone = blocks.where(_is_alone()).select("*", *none)
    if above is None:
        return alone
    steps = above.select(F.col("tree").alias("tree_"), F.col("number").alias("block_"), "places", "siblings")
    others = blocks.where(~_is_alone())
    same = others["tree"].eqNullSafe(steps["tree_"]) & (others["block"] == steps["block_"])
    return alone.unionByName(others.join(steps, same).drop("tree_", "block_"))


def grow(leaves: DataFrame, carried: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(lowest blocks with the steps from their tops to the root, (tree, root) of each tree).

    Each turn takes the tops of blocks that are not whole trees as the leaves of larger blocks.
    """
    tiers = [_blocks(leaves, carried)]
    while True:
        others = tiers[-1].where(~_is_alone())
        if others.isEmpty():
            break
        tiers.append(_blocks(others.select("tree", F.col("block").alias("number"), F.col("top").alias("leaf"))))
    roots = reduce(
        DataFrame.unionByName,
        [tier.where(_is_alone()).select("tree", F.col("top").alias("root")) for tier in tiers],
    )
    above = None
    for tier in reversed(tiers[1:]):
        placed = _with_steps(tier, above)
        out = StructType([tier.schema["tree"], *StructType.fromDDL("number long").fields, *_STEPS.fields])
        above = staged(placed.mapInArrow(_steps_of_leaves, out), "steps")
    return _with_steps(tiers[0], above), roots


def _prove(key_type, root: bytes):
    out = StructType(
        [
            StructField("key", key_type),
            *StructType.fromDDL("leaf string, subroot string, proof string, folded string").fields,
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(out)
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key"))
            for i, row in enumerate(batch.drop_columns(["key"]).to_pylist()):
                inside = Siblings(row["nodes"], row["n"])
                leaves = address(inside.levels + 1, inside.levels, np.arange(row["n"]))
                rest = list(zip(row["places"], row["siblings"], strict=True))
                rest_hex = "".join(others.hex() for _, others in rest)
                made: dict[str, list] = {"leaf": [], "proof": [], "folded": []}
                for number, tampered in enumerate(row["tampered"]):
                    at = int(leaves[number]) * DIGEST
                    leaf = row["nodes"][at : at + DIGEST]
                    steps = inside.of(number)
                    siblings = "".join(others.hex() for _, others in steps) + rest_hex
                    node = leaf if tampered is None else tampered
                    for place, others in steps + rest:
                        cut = place * DIGEST
                        node = _hash([others[:cut], node, others[cut:]])
                    made["leaf"].append(leaf.hex())
                    made["proof"].append(hashlib.sha256(siblings.encode()).hexdigest())
                    made["folded"].append(node.hex())
                yield pa.RecordBatch.from_arrays(
                    [
                        keys[i].values.cast(target.field("key").type),
                        pa.array(made["leaf"], pa.string()),
                        pa.array([row["subroot"].hex()] * row["n"], pa.string()),
                        pa.array(made["proof"], pa.string()),
                        pa.array(made["folded"], pa.string()),
                    ],
                    schema=target,
                )

    return run, out


def manifest(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    group: str = "source",
    columns: tuple[str, ...] = LEAF_COLUMNS,
    text: str = "text",
    tamper_every: int = TAMPER_EVERY,
) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified), a row for each row.

    A leaf hashes ``columns``; other columns, whatever their names, are not part of it. Rows of a
    group stand by key, nulls first; rows that repeat a key stand by their leaves, so the result
    does not depend on their order. Null groups form one group, the first. Where the checksum of
    a key is divisible by ``tamper_every``, the row is folded with its text's A-Z in lower case; a
    null key or text is never tampered with. Texts are hashed whole; an empty table gives no rows.
    """
    values = [F.col(c) for c in columns]
    lower = [F.translate(F.col(c), _UPPER, _UPPER.lower()) if c == text else F.col(c) for c in columns]
    picked = F.crc32(F.col(key).cast("string")) % tamper_every == 0
    leaves = staged(
        documents.select(
            F.col(group).alias("tree"),
            F.col(key).alias("key"),
            leaf_digest(values).alias("leaf"),
            F.when(picked, leaf_digest(lower)).alias("tampered"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "leaves",
    )
    blocks, subroots = grow(_numbered(leaves), ("key", "tampered"))
    # The subroots are the leaves of one more tree.
    groups = staged(
        subroots.select(
            F.lit(0).alias("tree"), F.col("tree").alias("key"), F.col("root").alias("leaf"), F.lit(0).alias("place")
        ),
        "subroots",
    )
    over, top = grow(_numbered(groups), ("key",))
    found = top.first()
    root = bytes(found["root"]) if found else b""
    # Steps of each subroot, beside its group.
    steps = over.mapInArrow(
        _steps_of_leaves, StructType([over.schema["tree"], *StructType.fromDDL("number long").fields, *_STEPS.fields])
    )
    named = over.select("block", F.posexplode("key").alias("slot", "named")).select(
        (F.col("block") * BLOCK_LEAVES + F.col("slot")).alias("number"), "named"
    )
    upper = (
        steps.join(named, "number")
        .select("named", F.col("places").alias("places_"), F.col("siblings").alias("siblings_"))
        .join(subroots.select("tree", F.col("root").alias("subroot")), F.col("named").eqNullSafe(F.col("tree")))
        .drop("tree")
    )
    whole = blocks.join(upper, blocks["tree"].eqNullSafe(upper["named"])).select(
        "n",
        "nodes",
        "key",
        "tampered",
        "subroot",
        F.concat("places", "places_").alias("places"),
        F.concat("siblings", "siblings_").alias("siblings"),
    )
    prove, out = _prove(documents.schema[key].dataType, root)
    return whole.mapInArrow(prove, out).select(
        F.col("key").alias(key),
        "leaf",
        "subroot",
        F.lit(root.hex()).alias("root"),
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.lit(root.hex())).alias("verified"),
    )
