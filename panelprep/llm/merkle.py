"""Merkle manifest of a table: one root for all rows, a proof for each, and a version for each changed one.

A row's digest is a leaf.  The leaves of a group (a source), in the order of their
id, are joined three by three until one node remains, and the groups' nodes
likewise, in the order of the groups.  A tree is kept in aligned blocks of 729
neighbouring nodes with all levels above them up to the block's top; the tops are
the nodes of the next tier, so the number of tiers grows with the logarithm of
the rows, and no task ever holds more than a block.

The tree is persistent: nothing in it is overwritten.  A changed leaf gives a new
version of the tree that has nodes of its own only on the way from the leaf to the
root (``version``, one digest a level) and shares all others.  Within a block the
way is copied by the task that has the block; from the block's top on it goes
through the siblings above it, which are found once a block and joined to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelprep.llm.common import stored

ARITY = 3
LEVELS = 6
BLOCK = ARITY**LEVELS  # nodes of a block
HEX = 64

_NODE = "total long, block long, ids array<{id}>, found array<binary>, nodes binary, top binary"
_STEPS = "array<struct<left: binary, right: binary>>"


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def row_digest(columns: list[Column]) -> Column:
    """Lowercase hex sha256 of all values: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    values = [c.cast("string").cast("binary") for c in columns]
    said = [F.when(v.isNull(), F.lit(b"-")).otherwise(F.concat(F.octet_length(v).cast("string").cast("binary"), F.lit(b":"), v)) for v in values]
    return F.sha2(F.concat(*said), 256)


class Tree:
    """A block: nodes as hex text, level over level.  ``whole`` blocks of a larger tree have all levels, others end at one node."""

    def __init__(self, nodes: bytes, count: int, whole: bool, grow: bool = False):
        self.levels = [nodes[: count * HEX]]
        at = count
        while len(self.levels) <= LEVELS and (whole or count > 1):
            count = -(-count // ARITY)
            below = self.levels[-1]
            step = ARITY * HEX
            self.levels.append(b"".join(digest(below[k : k + step]) for k in range(0, len(below), step)) if grow else nodes[at * HEX : (at + count) * HEX])
            at += count

    def siblings(self, leaf: int) -> list[tuple[bytes, bytes]]:
        """For each level up to the top: the run's other nodes, left and right of the one on the way."""
        steps = []
        for level in self.levels[:-1]:
            first = leaf - leaf % ARITY
            steps.append((level[first * HEX : leaf * HEX], level[(leaf + 1) * HEX : (first + ARITY) * HEX]))
            leaf //= ARITY
        return steps


def copied(leaf: bytes, steps: list[tuple[bytes, bytes]]) -> list[bytes]:
    """The nodes that a version with this leaf has of its own, from the leaf to the root."""
    way = [leaf]
    for left, right in steps:
        way.append(digest(left + way[-1] + right))
    return way


def _numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``at``, the place in its group ``grp``, and ``total``, the group's size; ties go in any order, spread over partitions."""
    mixed = nodes.withColumn("tie", F.monotonically_increasing_id())
    dealt = stored(mixed.repartitionByRange("grp", *order, "tie").sortWithinPartitions("grp", *order, "tie").drop("tie")
                   .withColumn("row", F.monotonically_increasing_id()), "numbered")
    dealt = dealt.withColumn("part", F.shiftright("row", 33))
    runs = dealt.groupBy("grp", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))  # one row a partition and group
    group = Window.partitionBy("grp")
    runs = runs.select(F.col("grp").alias("run_grp"), F.col("part").alias("run_part"), "first", F.sum("n").over(group).alias("total"),
                       (F.sum("n").over(group.orderBy("part")) - F.col("n")).alias("before"))
    joined = dealt.join(runs, F.col("grp").eqNullSafe(F.col("run_grp")) & (F.col("part") == F.col("run_part")))
    return joined.withColumn("at", F.col("before") + F.col("row") - F.col("first")).drop("run_grp", "run_part", "part", "row", "first", "before")


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """Blocks of ``nodes`` (``grp, at, total, id, node, found``), written to the shared folder."""
    kind, group = nodes.schema["id"].dataType.simpleString(), nodes.schema["grp"].dataType.simpleString()
    schema = f"grp {group}, " + _NODE.format(id=kind)

    def grow(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        total, block = table.column("total")[0].as_py(), table.column("block")[0].as_py()
        tree = Tree(b"".join(table.column("node").to_pylist()), len(table), total > BLOCK, grow=True)
        return pa.table({
            "grp": table.column("grp").slice(0, 1), "total": [total], "block": [block],
            "ids": pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), table.column("id").combine_chunks()),
            "found": pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), table.column("found").combine_chunks()),
            "nodes": pa.array([b"".join(tree.levels)], pa.binary()), "top": pa.array([tree.levels[-1]], pa.binary())})

    blocks = nodes.withColumn("block", F.floor(F.col("at") / BLOCK))
    return stored(blocks.groupBy("grp", "block").applyInArrow(grow, schema), name)


def _tiers(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Blocks of nodes, blocks of their tops, and so on until each group has one block."""
    tiers = [_blocks(nodes, name)]
    while (tiers[-1].agg(F.max("total")).first()[0] or 0) > BLOCK:
        tops = tiers[-1].where(F.col("total") > BLOCK).select(
            "grp", F.col("block").alias("at"), F.ceil(F.col("total") / BLOCK).alias("total"), F.col("block").alias("id"),
            F.col("top").alias("node"), F.lit(None).cast("binary").alias("found"))
        tiers.append(_blocks(tops, f"{name}-{len(tiers)}"))
    return tiers


class Manifest(NamedTuple):
    """The stored trees: blocks of each group's tree, tier by tier, and of the tree over all groups."""

    groups: list[DataFrame]
    root: list[DataFrame]


def build(docs: DataFrame, columns: list[str], found: dict[str, Column] | None = None, id_col: str = "doc_id", group_col: str = "source") -> Manifest:
    """Trees over all rows of ``docs``.

    A row's leaf is the digest of ``columns``; ``found`` has other expressions for
    some of them, what a second look at the row gives.  Where these give another
    digest, the row is a changed one.  Null is a group of its own, the first; null
    ids come first; rows of one id go by their leaf, and equal rows stay as often
    as they are; other columns are ignored.  An empty table has no tree.
    """
    leaf, now = row_digest([F.col(c) for c in columns]), row_digest([(found or {}).get(c, F.col(c)) for c in columns])
    leaves = docs.select(F.col(group_col).cast("string").alias("grp"), F.col(id_col).alias("id"), leaf.cast("binary").alias("node"),
                         F.nullif(now, leaf).cast("binary").alias("found"))
    groups = _tiers(_numbered(leaves, ["id", "node"]), "leaves")
    tops = None
    for tier in groups:
        ended = tier.where(F.col("total") <= BLOCK).select("grp", "top")
        tops = ended if tops is None else tops.unionByName(ended)
    sources = tops.select(F.lit(0).alias("grp"), F.col("grp").alias("id"), F.col("top").alias("node"), F.lit(None).cast("binary").alias("found"))
    return Manifest(groups, _tiers(_numbered(sources, ["id"]), "groups"))


def _steps_down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """For each node of ``blocks``: its siblings in the block and those above the block's top, which ``above`` has for ``grp`` and ``block``."""
    kind, group = blocks.schema["ids"].dataType.elementType.simpleString(), blocks.schema["grp"].dataType.simpleString()
    more = [f for f in above.columns if f not in ("grp", "block", "steps")]

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = Tree(row["nodes"], len(row["ids"]), row["total"] > BLOCK)
                count = len(row["ids"])
                steps = [[{"left": a, "right": b} for a, b in tree.siblings(k)] + row["steps"] for k in range(count)]
                yield pa.RecordBatch.from_pydict({"grp": [row["grp"]] * count, "id": row["ids"], "node": [tree.levels[0][k * HEX : (k + 1) * HEX] for k in range(count)],
                                                  "steps": steps} | {name: [row[name]] * count for name in more}, schema=arrow)

    schema = f"grp {group}, id {kind}, node binary, steps {_STEPS}" + "".join(f", {name} binary" for name in more)
    arrow = _arrow(blocks, schema)
    return _with_steps(blocks.select("grp", "total", "block", "ids", "nodes"), above).mapInArrow(down, schema)


def _arrow(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _with_steps(blocks: DataFrame, above: DataFrame) -> DataFrame:
    above = above.withColumnsRenamed({"grp": "above_grp", "block": "above_block"})
    joined = blocks.join(above, F.col("grp").eqNullSafe(F.col("above_grp")) & (F.col("block") == F.col("above_block")))
    return joined.drop("above_grp", "above_block")


def _paths(tiers: list[DataFrame], ends: list[DataFrame]) -> DataFrame:
    """Siblings above each block of the first tier; ``ends`` has them for the one block of a group that ends at each tier."""
    above = ends[-1]
    for tier, end in zip(tiers[:0:-1], ends[-2::-1]):
        more = [c for c in above.columns if c not in ("grp", "block", "steps")]
        above = end.unionByName(_steps_down(tier, above).select("grp", F.col("id").alias("block"), "steps", *more))
    return above


def proofs(manifest: Manifest, id_col: str = "doc_id", versions: bool = False) -> DataFrame:
    """A row per row of the table: id, ``leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``proof_sha256`` is the digest of all siblings, from the leaf's to the root's;
    ``folded_root`` the root of the version with the leaf as found, and ``verified``
    whether that's the manifest's.  With ``versions`` also ``version``: the nodes a
    changed row's version has of its own, from the leaf to the root; null for others.
    """
    roots = manifest.root
    top = roots[-1].select("grp", F.lit(0).cast("long").alias("block"), F.array().cast(_STEPS).alias("steps"), F.col("top").alias("root"))
    none = top.limit(0)
    per_group = stored(_steps_down(roots[0], _paths(roots, [none] * (len(roots) - 1) + [top])), "paths")  # one row a group
    per_group = per_group.select(F.col("id").alias("grp"), F.lit(0).cast("long").alias("block"), "steps", "root", F.col("node").alias("subroot"))
    ends = []
    for tier in manifest.groups:
        ended = tier.where(F.col("total") <= BLOCK).select(F.col("grp").alias("end_grp"))
        ends.append(per_group.join(ended, F.col("grp").eqNullSafe(F.col("end_grp")), "left_semi"))
    leaves = manifest.groups[0]
    kind = leaves.schema["ids"].dataType.elementType.simpleString()
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            for k, row in enumerate(batch.drop_columns(["ids"]).to_pylist()):
                count = len(ids[k])
                tree = Tree(row["nodes"], count, row["total"] > BLOCK)
                above = [(s["left"], s["right"]) for s in row["steps"]]
                root = row["root"]
                out = {name: [] for name in names} | {"verified": [], "version": []}
                for leaf, found in enumerate(row["found"]):
                    steps = tree.siblings(leaf) + above
                    own = tree.levels[0][leaf * HEX : (leaf + 1) * HEX]
                    way = copied(own if found is None else found, steps)
                    said = (own, row["subroot"], root, digest(b"".join(a + b for a, b in steps)), way[-1])
                    for name, value in zip(names, said):
                        out[name].append(value.decode())
                    out["verified"].append(way[-1] == root)
                    out["version"].append(None if found is None else [n.decode() for n in way])
                if not versions:
                    del out["version"]
                columns = {"id": ids[k].values} | {n: pa.array(v, pa.list_(pa.string()) if n == "version" else None) for n, v in out.items()}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    schema = f"id {kind}, " + ", ".join(f"{n} string" for n in names) + ", verified boolean" + ", version array<string>" * versions
    return _with_steps(leaves, _paths(manifest.groups, ends)).mapInArrow(verify, schema).withColumnRenamed("id", id_col)
