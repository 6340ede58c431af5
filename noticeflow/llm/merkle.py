"""Merkle manifest of a dataset: a root over all rows, and for each row the witness that proves it.

Nodes are appended in order to a stack of open aligned subtrees. A subtree keeps the witnesses of its
leaves; when its sibling completes, both become one and every witness on either side grows by the
root of the other. Blocks of 2 ** LEVELS leaves grow side by side in tasks; their roots are
appended to the tree above in the same way, block by block, until one root is left.
A row's witness is its part within the block and then that of the block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

# Levels of a block: a task holds 2 ** LEVELS leaves at a time.
LEVELS = 10
# A step of a witness: where the sibling stands, then its hash; a node without one is hashed alone.
LEFT, RIGHT, ALONE = b"<", b">", b"-" + bytes(32)
STEP = 33


def node(*children: bytes) -> bytes:
    """The hash of a node: of its children's hashes as lowercase hex text."""
    return sha256("".join(c.hex() for c in children).encode()).digest()


class Open:
    """The open subtrees of a block, tallest first: (height, root, first leaf, end)."""

    def __init__(self):
        self.trees: list[tuple[int, bytes, int, int]] = []
        self.witness: list[bytearray] = []

    def append(self, leaf: bytes) -> None:
        self.trees.append((0, leaf, len(self.witness), len(self.witness) + 1))
        self.witness.append(bytearray())
        self._join()

    def _join(self) -> None:
        while len(self.trees) > 1 and self.trees[-2][0] == self.trees[-1][0]:
            (height, left, first, middle), (_, right, _, end) = self.trees[-2:]
            for w in self.witness[first:middle]:
                w += RIGHT + right
            for w in self.witness[middle:end]:
                w += LEFT + left
            self.trees[-2:] = [(height + 1, node(left, right), first, end)]

    def close(self, height: int) -> bytes:
        """The root at ``height``: the last subtree rises alone until it meets the one before it, and at the end."""
        while len(self.trees) > 1 or self.trees[-1][0] < height:
            low, root, first, end = self.trees[-1]
            for w in self.witness[first:end]:
                w += ALONE
            self.trees[-1] = (low + 1, node(root), first, end)
            self._join()
        return self.trees[0][1]


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf leads to along its witness."""
    for at in range(0, len(witness), STEP):
        side, other = witness[at : at + 1], witness[at + 1 : at + STEP]
        leaf = node(leaf) if side == b"-" else node(other, leaf) if side == LEFT else node(leaf, other)
    return leaf


def proof(witness: bytes) -> bytes:
    """The hash of the siblings from the leaf to the root, as they stand."""
    return sha256("".join(witness[at + 1 : at + STEP].hex() for at in range(0, len(witness), STEP)
                          if witness[at : at + 1] != b"-").encode()).digest()


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields: each ``-`` if NULL, else its UTF-8 bytes' count, ``:`` and its text."""
    shown = []
    for field in fields:
        text = field.cast("string")
        shown.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*shown).cast("binary"), 256)


def positions(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``_pos``, their place from 0 within the group by ``order``, and ``_n``, the group's size.

    Sorted ranges number their rows on their own and are shifted by the sizes of the ranges before. The order
    must have no ties and the rows be stored; the numbered ranges are written to the shared folder, so that a lost
    executor can't move a row. No group meets in a task.
    """
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, place = None, 0, TaskContext.get().partitionId()
        for batch in batches:
            own = []
            for value in batch.column(group).to_pylist():
                held, n = value, (n + 1 if value == held and n else 1)
                own.append(n - 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([place] * batch.num_rows, pa.int32()), pa.array(own, pa.int64())],
                names=[*batch.schema.names, "_range", "_local"])

    schema = rows.withColumns({"_range": F.lit(0), "_local": F.lit(0).cast("bigint")}).schema
    for field in schema:
        field.nullable = True
    numbered = cut(rows.repartitionByRange(count, group, *order).sortWithinPartitions(group, *order).mapInArrow(number, schema))
    # One row per range and group in it.
    sizes = numbered.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_size"))
    all_ranges = W.partitionBy(group)
    before = all_ranges.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(group, "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
                           F.sum("_size").over(all_ranges).alias("_n"))
    return numbered.join(offsets, [group, "_range"]).select(
        *rows.columns, (F.col("_offset") + F.col("_local")).alias("_pos"), "_n")


def grow(rows: DataFrame, levels: int) -> DataFrame:
    """Blocks of the nodes (_part, _pos, _n, _node, ...): adds _block, the ``_witness`` within it, and its root ``_top`` in one row.

    Streams each block in order. A part of one block ends at a single node; blocks of larger parts rise to the
    full height.
    """
    names = [*rows.columns, "_block", "_witness", "_top"]
    schema = rows.withColumns({"_block": F.lit(0).cast("bigint"), "_witness": F.lit(b""), "_top": F.lit(b"")}).schema
    for field in schema:
        field.nullable = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        key, kept, trees = None, [], Open()

        def finished() -> pa.RecordBatch:
            table = pa.Table.from_batches(kept)
            total = table.column("_n")[0].as_py()
            root = trees.close(min(levels, (total - 1).bit_length()))
            n = table.num_rows
            columns = [*table.columns, pa.array([key[1]] * n, pa.int64()),
                       pa.array([bytes(w) for w in trees.witness], pa.binary()), pa.array([root] + [None] * (n - 1), pa.binary())]
            made = pa.Table.from_arrays(columns, names=names).cast(arrow).combine_chunks()
            return made.to_batches()[0]

        for batch in batches:
            keys = list(zip(batch.column("_part").to_pylist(), (p >> levels for p in batch.column("_pos").to_pylist()), strict=True))
            nodes = batch.column("_node").to_pylist()
            start = 0
            for at, own in enumerate(keys):
                if own != key:
                    if at > start:
                        kept.append(batch.slice(start, at - start))
                    if key is not None:
                        yield finished()
                    key, kept, trees, start = own, [], Open(), at
                trees.append(nodes[at])
            kept.append(batch.slice(start))
        if key is not None:
            yield finished()

    block = F.shiftright("_pos", levels)
    placed = (rows.withColumn("_to", block).repartition("_part", "_to").sortWithinPartitions("_part", "_pos").drop("_to"))
    return placed.mapInArrow(run, schema)


def above(low: DataFrame, levels: int) -> DataFrame:
    """(_part, _block, _ext, _root): what extends the witnesses of each block of ``grow``, up to the root of its part."""
    heads = low.where(F.col("_top").isNotNull()).select(
        "_part", F.col("_block").alias("_pos"),
        F.shiftright(F.col("_n") + ((1 << levels) - 1), levels).alias("_n"), F.col("_top").alias("_node"))
    most = heads.agg(F.max("_n")).first()[0]
    if most is None or most == 1:
        return heads.select("_part", F.col("_pos").alias("_block"), F.lit(b"").alias("_ext"), F.col("_node").alias("_root"))
    grown = cut(grow(heads, levels))
    return grown.join(above(grown, levels), ["_part", "_block"]).select(
        "_part", F.col("_pos").alias("_block"), F.concat("_witness", "_ext").alias("_ext"), "_root")


def manifest(docs: DataFrame, fields: Sequence[str], key: str = "doc_id", part: str = "lang",
             carry: Sequence[str] = (), levels: int = LEVELS) -> DataFrame:
    """(key, leaf, subroot, root, witness, carry ...) of every row, hashes as lowercase hex, the witness as bytes for ``fold``.

    Leaves ascend by ``key`` within a part, NULL first; rows of one key by their hash, and equal rows are leaves
    beside each other. A task holds 2 ** ``levels`` leaves at a time, which does not change any hash. Parts ascend by their UTF-8 bytes, the NULL part first. Runs are pairs; the last node of an odd
    level is hashed alone. ``carry`` names narrow columns to take along. Other columns are not read unless they
    are fields; an empty table gives no rows. Long texts are hashed where they are read; only hashes are shuffled.
    """
    # "-" sorts before "=", so the NULL part comes first and the others in order.
    leaf = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(part).cast("string")), F.lit("-")).alias("_part"), F.col(key).alias("_key"),
        F.unhex(leaf_hash([F.col(f) for f in fields])).alias("_node"),
        F.struct(*carry, F.lit(0).alias("_none")).alias("_carry"), F.monotonically_increasing_id().alias("_tie"))
    placed = positions(cut(leaf), "_part", ["_key", "_node", "_tie"]).drop("_tie")
    low = cut(grow(placed, levels))
    blocks = above(low, levels)
    parts = cut(blocks.where("_block = 0").select(
        F.lit("").alias("_part"), F.col("_part").alias("_name"), F.col("_root").alias("_node")))
    tops = cut(grow(positions(parts, "_part", ["_name"]), levels))
    crowns = tops.join(above(tops, levels), ["_part", "_block"]).select(
        F.col("_name").alias("_part"), F.concat("_witness", "_ext").alias("_crown"), F.col("_root").alias("_whole"))
    # One row a block: the end of the witnesses of its leaves.
    ends = blocks.join(crowns, "_part").select("_part", "_block", F.concat("_ext", "_crown").alias("_ext"), "_root", "_whole")
    joined = low.join(ends, ["_part", "_block"])
    return joined.select(
        F.col("_key").alias(key), F.lower(F.hex("_node")).alias("leaf"), F.lower(F.hex("_root")).alias("subroot"),
        F.lower(F.hex("_whole")).alias("root"), F.concat("_witness", "_ext").alias("witness"),
        *[F.col("_carry")[c].alias(c) for c in carry])


def verify(rows: DataFrame, key: str = "doc_id", claimed: str = "leaf") -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of the rows of ``manifest``.

    ``folded_root`` is what the hash in the column ``claimed`` leads to along the row's witness (NULL: its leaf).
    """
    kind = rows.schema[key].dataType.simpleString()
    names = ["_key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            witness = batch.column("witness").to_pylist()
            proofs = [proof(w).hex() for w in witness]
            folded = [fold(bytes.fromhex(c), w).hex() for c, w in zip(batch.column("_claimed").to_pylist(), witness, strict=True)]
            same = [a == b for a, b in zip(folded, batch.column("root").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names[:4]], pa.array(proofs, pa.string()), pa.array(folded, pa.string()),
                 pa.array(same, pa.bool_())], names=names)

    given = rows.select(F.col(key).alias("_key"), "leaf", "subroot", "root", "witness",
                        F.coalesce(F.col(claimed), F.col("leaf")).alias("_claimed"))
    schema = (f"_key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean")
    return given.mapInArrow(run, schema).withColumnRenamed("_key", key)
