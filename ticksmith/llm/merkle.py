"""Merkle manifest of a table by cogrouped subtree exchange.

A row's leaf is a digest of its columns.  The leaves of a group (``by``) ascend by id; every two
consecutive nodes have their digest as parent (a last one alone is digested alone) until one node is
left, the group's subroot; the subroots, ordered by group, give the root in the same way.

A group's leaves are numbered without bringing them together: they are sorted by range over many tasks, each
task numbers its own, and what the tasks before it hold is added.  ``block`` consecutive nodes are a
superblock.  Upwards, superblocks are reduced to one node each, their nodes again, and so on, until
each tree is one node.  Downwards, the nodes of a superblock and the outer nodes that its proofs need (the
siblings of the superblock and of all above it) are cogrouped: one function reduces the superblock, joins its
own siblings and the outer ones to whole proofs, and at the leaves folds each proof.  So a task holds one
superblock, whatever the size of a group, and digests alone are shuffled, never texts.

Defined results: nulls in any column have a mark of their own in the leaf; a null id comes before all
others and is never tampered with; rows with equal ids are ordered by leaf; equal rows are leaves of
their own, which are interchangeable; a null group is a group, before all others; a group of one row has its leaf as subroot, and one
group's subroot is the root; texts of any length are digested whole; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticksmith.session import staged

NODE = "tree long, at long, size long, digest string"
OUTER = "tree long, at long, path string, subroot string, root string"


def digest_of(*parts: str) -> str:
    """H: the digest of the inputs one after another, digests as hex text."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` if null, else the value's bytes in UTF-8, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _levels(size: int) -> int:
    return (size - 1).bit_length()


def _reduced(digests: list[str], levels: int) -> Iterator[list[str]]:
    """The nodes of each level, those given first."""
    yield digests
    for _ in range(levels):
        digests = [digest_of(*digests[i:i + 2]) for i in range(0, len(digests), 2)]
        yield digests


def _siblings(rows: list[list[str]], at: int) -> list[str]:
    """The steps from a node up to the top of its superblock."""
    steps = []
    for row in rows[:-1]:
        other = at ^ 1
        steps.append(("L" if other < at else "R") + row[other] if other < len(row) else "-")
        at >>= 1
    return steps


def folded(node: str, path: Sequence[str]) -> str:
    """The root that a node and its siblings give."""
    for step in path:
        side, other = step[0], step[1:]
        node = digest_of(other, node) if side == "L" else digest_of(node, other)
    return node


def numbered(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``at``, the place (from 0) in its group by ``by`` in the given order, and ``size``, that of the group.

    Groups are split over tasks by range.  What is brought together is a row for each task and group in it.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*by, *order]]
    rows = staged(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumns({"__task": F.spark_partition_id(), "__place": F.monotonically_increasing_id()}), "merkle", "sorted")
    within = Window.partitionBy(*by)
    runs = rows.groupBy("__task", *by).agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__n")).select(
        F.col("__task").alias("__task2"), *[F.col(c).alias(f"__by{i}") for i, c in enumerate(by)],
        (F.sum("__n").over(within.orderBy("__task")) - F.col("__n") - F.col("__first")).alias("__shift"),
        F.sum("__n").over(within).alias("size"))
    same = (F.col("__task") == F.col("__task2"))
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__by{i}"))
    return rows.join(runs, same).withColumn("at", F.col("__place") + F.col("__shift")).drop(
        "__task", "__task2", "__place", "__shift", *[f"__by{i}" for i in range(len(by))])


def _up(nodes: DataFrame, bits: int) -> DataFrame:
    """One node for each superblock of ``nodes``."""

    def reduce(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("at")
        size = int(part["size"].iloc[0])
        *_, top = _reduced(part["digest"].tolist(), min(bits, _levels(size)))
        return pd.DataFrame({"tree": part["tree"].iloc[:1], "at": part["at"].iloc[:1] // (1 << bits), "size": -(-size >> bits), "digest": top})

    block = F.shiftright("at", bits).alias("block")
    return staged(nodes.select(*[c.split()[0] for c in NODE.split(", ")]).groupBy("tree", block).applyInPandas(reduce, NODE), "merkle", "nodes")


def _tiers(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """``nodes``, their superblocks, those of these, and so on to one node for each tree."""
    tiers, size = [nodes], nodes.agg(F.max("size")).first()[0]
    while size is not None and size > 1:
        tiers.append(_up(tiers[-1], bits))
        size = -(-size >> bits)
    return tiers


def _down(nodes: DataFrame, outer: DataFrame, bits: int, each, schema: str) -> DataFrame:
    """``each(row, digest, path, outer row)`` of all nodes; ``outer`` has a row for each superblock of theirs."""

    def joined(part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("at")
        size, up = int(part["size"].iloc[0]), above.iloc[0]
        rows = list(_reduced(part["digest"].tolist(), min(bits, _levels(size))))
        beyond = up["path"].split(",") if up["path"] else []
        return each(part, [_siblings(rows, at) + beyond for at in range(len(part))], up)

    blocks = nodes.withColumn("block", F.shiftright("at", bits)).groupBy("tree", "block")
    return blocks.cogroup(outer.withColumnRenamed("at", "block").groupBy("tree", "block")).applyInPandas(joined, schema)


def _outer(part: pd.DataFrame, paths: list[list[str]], up: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({
        "tree": part["tree"], "at": part["at"], "path": [",".join(p) for p in paths], "subroot": up["subroot"], "root": up["root"]})


def _paths(tiers: list[DataFrame], outer: DataFrame, bits: int) -> DataFrame:
    """The outer rows of the first tier's nodes, from those of the last one's."""
    for nodes in reversed(tiers[:-1]):
        outer = staged(_down(nodes, outer, bits, _outer, OUTER), "merkle", "outer")
    return outer


def manifest(
    docs: DataFrame, *, id_col: str = "doc_id", by: str = "lang", columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    tampered: dict[str, Column] | None = None, tamper_where: Column | None = None, block_bits: int = 12,
) -> DataFrame:
    """For each row: its id, ``leaf``, ``subroot``, ``root``, ``proof`` (its siblings, level by level, comma-joined: L or R
    for the side and the digest, or - for a node that stands alone) and ``folded_root``.

    The proof is folded from the leaf as it would be with the columns of ``tampered`` in place of the given ones,
    where ``tamper_where`` holds, else from the leaf itself.
    """
    values = {c: docs[c] for c in columns}
    own, where = leaf(*values.values()), F.coalesce(tamper_where, F.lit(False)) if tamper_where is not None else F.lit(False)
    changed = leaf(*(values | (tampered or {})).values())
    # leaves are written once: texts are read and digested once, and equal rows have an order from then on
    leaves = staged(docs.select(
        docs[id_col].alias("id"), docs[by].alias("lang"), own.alias("digest"), F.when(where, changed).alias("changed"),
        F.monotonically_increasing_id().alias("row")), "merkle", "leaves")
    placed = numbered(leaves, ["lang"], ["id", "digest", "row"]).drop("row")
    groups = numbered(placed.filter("at = 0").select("lang", "size"), [], ["lang"])
    trees = groups.select(F.col("lang").alias("__lang"), F.col("at").alias("tree"))
    id_type = leaves.schema["id"].dataType.simpleString()
    nodes = staged(
        placed.join(trees, placed["lang"].eqNullSafe(F.col("__lang"))).select(
            "tree", "at", "size", "digest", F.col("id").cast("string").alias("id"), "changed"), "merkle", "placed")

    tiers = _tiers(nodes, block_bits)
    # the subroots are the nodes of one more tree
    subroots = tiers[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(groups.count()).cast("long").alias("size"), "digest")
    above = _tiers(subroots, block_bits)
    top = above[-1].select("tree", "at", F.lit("").alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    tops = _paths(above, top, block_bits).join(subroots.select("at", F.col("digest").alias("own")), "at").select(
        F.col("at").alias("tree"), F.lit(0).cast("long").alias("at"), "path", F.col("own").alias("subroot"), "root")

    def finish(part: pd.DataFrame, paths: list[list[str]], up: pd.Series) -> pd.DataFrame:
        start = part["changed"].where(part["changed"].notna(), part["digest"])
        return pd.DataFrame({
            "id": part["id"], "leaf": part["digest"], "subroot": up["subroot"], "root": up["root"], "proof": [",".join(p) for p in paths],
            "folded_root": [folded(node, path) for node, path in zip(start, paths)]})

    outer = _paths(tiers[1:], tops, block_bits) if len(tiers) > 1 else tops
    found = _down(nodes, outer, block_bits, finish, "id string, leaf string, subroot string, root string, proof string, folded_root string")
    return found.select(F.col("id").cast(id_type).alias(id_col), "leaf", "subroot", "root", "proof", "folded_root")


def siblings(proof: Column) -> Column:
    """The digests of a proof, level by level."""
    return F.filter(F.transform(F.split(proof, ","), lambda step: F.substring(step, 2, 64)), lambda d: d != "")
