"""Trie of conversation prefixes, by adaptive radix trees over turn ids.

A turn's id is WIDTH bytes: the length of its text (4 bytes, big-endian) and 16 bytes of a digest of role
and text.  A conversation's key is the ids of its turns, one after another, so keys in byte order
keep conversations with a common beginning together, and every node of the trie is a range of them.

Keys are sorted by range over many tasks (with the conversation's number, so that many equal
conversations spread over tasks too) and cut into blocks.  Each block becomes an adaptive radix tree: nodes grow from 4 to 16,
48 and 256 children as needed, and single paths are compressed.  A walk over it emits a node of the trie
at each depth that is a whole number of ids; other depths of the tree are inner branchings of an id.

A node that lies in one block is finished there.  One that goes on into the next block, or came from the one
before (its key begins both blocks' neighbouring keys), is emitted in parts.  All its numbers are sums
over its blocks, as what is counted once (a child, a leaf, the length of a distinct turn) is counted by one
block alone: the one in which it begins, for a leaf the one in which it ends.  So parts are added up in
one streamed pass, in the order of blocks, which also digests the members that end in the node.

Defined results: turns are ordered by turn (null first; equal ones by id, that is by length and
digest), null roles and texts are empty; repeated rows are turns of their own; rows without a conversation
number belong to none and are left out; texts of any length count whole; an empty table has no
conversation and gives no rows, not even the root; other columns are ignored.  A conversation's ids
(20 bytes a turn) are held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticksmith.session import staged

#: Bytes of a turn id, and those of them that hold the length of the text.
WIDTH, LENGTH = 20, 4


def turn_id(role: Column, text: Column) -> Column:
    """The id of a turn; nulls are empty."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.concat(F.lpad(F.hex(F.octet_length(text)), 2 * LENGTH, "0"), F.substring(digest, 1, 2 * (WIDTH - LENGTH))))


def keys_of(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, key) of each conversation of a table of turns."""
    ids = turns.select(
        turns[id_col].cast("long").alias("conv_id"), turns[turn_col].alias("turn"), turn_id(turns[role_col], turns[text_col]).alias("id"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "id")))
    joined = F.unhex(F.array_join(F.transform(ordered, lambda t: F.hex(t["id"])), ""))
    return ids.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(joined.alias("key"))


def head(key: Column, turns: Column) -> Column:
    return F.substring(key, F.lit(1), (turns * WIDTH).cast("int"))


def rest(key: Column, turns: Column) -> Column:
    return F.substring(key, (turns * WIDTH + 1).cast("int"), F.length(key))


class Node:
    """A node of an adaptive radix tree: a compressed path, the members that end here, and children by their next byte.

    The children lie in one of four layouts: up to 4 or 16 sorted bytes beside as many nodes, a table
    from bytes to 48 places, or 256 places.
    """

    __slots__ = ("path", "members", "room", "bytes", "nodes")

    def __init__(self, path: bytes):
        self.path, self.members, self.room, self.bytes, self.nodes = path, [], 4, bytearray(), []

    def child(self, byte: int) -> "Node | None":
        if self.room <= 16:
            at = self.bytes.find(byte)
            return self.nodes[at] if at >= 0 else None
        if self.room == 48:
            at = self.bytes[byte]
            return self.nodes[at - 1] if at else None
        return self.nodes[byte]

    def put(self, byte: int, node: "Node") -> None:
        """Sets a child; the layout grows where it is full."""
        if self.room <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.nodes[at] = node
                return
            if len(self.nodes) == self.room:
                self._grow()
                self.put(byte, node)
                return
            at = next((i for i, b in enumerate(self.bytes) if b > byte), len(self.bytes))
            self.bytes.insert(at, byte)
            self.nodes.insert(at, node)
        elif self.room == 48:
            if self.bytes[byte]:
                self.nodes[self.bytes[byte] - 1] = node
            elif len(self.nodes) == 48:
                self._grow()
                self.put(byte, node)
            else:
                self.nodes.append(node)
                self.bytes[byte] = len(self.nodes)
        else:
            self.nodes[byte] = node

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            table = bytearray(256)
            for i, b in enumerate(self.bytes):
                table[b] = i + 1
            self.room, self.bytes = 48, table
        else:
            self.room, self.nodes, self.bytes = 256, [self.nodes[i - 1] if i else None for i in self.bytes], bytearray()

    def children(self) -> Iterator[tuple[int, "Node"]]:
        """(byte, child) in the order of bytes."""
        if self.room <= 16:
            yield from zip(self.bytes, self.nodes)
        elif self.room == 48:
            yield from ((b, self.nodes[i - 1]) for b, i in enumerate(self.bytes) if i)
        else:
            yield from ((b, n) for b, n in enumerate(self.nodes) if n is not None)


def _common(a: bytes, b: bytes) -> int:
    """The length of the common beginning."""
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def insert(root: Node | None, key: bytes, member: int) -> Node:
    """Adds a member under a key; gives the root, which may be a new one."""
    if root is None:
        root = Node(key)
        root.members.append(member)
        return root
    above, node, at = None, root, 0
    while True:
        path = node.path
        same = len(path) if key.startswith(path, at) else _common(path, key[at:at + len(path)])
        if same < len(path):
            split = Node(path[:same])
            node.path = path[same + 1:]
            split.put(path[same], node)
            if above is None:
                root = split
            else:
                above.put(key[at - 1], split)
            node = split
        at += same
        if at == len(key):
            node.members.append(member)
            return root
        below = node.child(key[at])
        if below is None:
            below = Node(key[at + 1:])
            below.members.append(member)
            node.put(key[at], below)
            return root
        above, node, at = node, below, at + 1


class _Sums:
    """What a subtree adds to the trie node above it."""

    __slots__ = ("seen", "n", "first", "begun", "any", "leaves", "total", "distinct", "tops")

    def __init__(self, seen: int):
        self.seen = seen  # members of the block that come before
        self.n, self.first, self.begun, self.any, self.leaves, self.total, self.distinct, self.tops = 0, None, 0, False, 0, 0, 0, []


def nodes_of(members: list[int], keys: list[bytes], before: int, after: int) -> list[list]:
    """The trie nodes of a sorted block, a list for each:
    [depth, smallest member, members, children, leaves, saved, place of its first member, whole, members that end here, place of its parent].

    ``before``, ``after``: the turns that the first key has in common with the key before the block, and the
    last one with the key after it; -1 where there is none.  A node on these paths is not whole.
    """
    root = None
    for key, member in zip(keys, members):
        root = insert(root, key, member)
    out: list[list] = []
    size = len(members)

    def enter(node: Node, start: int, seen: int) -> tuple:
        sums = _Sums(seen)
        sums.n, sums.first = len(node.members), min(node.members, default=None)
        return node, start, start + len(node.path), node.children(), sums

    def leave(node: Node, start: int, end: int, sums: _Sums) -> None:
        """Emits the trie nodes on the way to a node of the tree, from the last to the first."""
        key = keys[sums.seen]
        for depth in range(end // WIDTH, (start - 1) // WIDTH, -1):
            came, goes = sums.seen == 0 and depth <= before, sums.seen + sums.n == size and depth <= after
            length = int.from_bytes(key[(depth - 1) * WIDTH:][:LENGTH], "big") if depth else 0
            sums.total += sums.n * length
            sums.distinct += 0 if came else length
            if not sums.any and not goes:
                sums.leaves += 1
            ends = node.members if depth * WIDTH == end else []
            for k in sums.tops:
                out[k][-1] = len(out)
            sums.tops = [len(out)]
            out.append([depth, sums.first, sums.n, sums.begun, sums.leaves, sums.total - sums.distinct, sums.seen, not (came or goes), ends, -1])
            sums.begun, sums.any = 0 if came else 1, True

    if root is None:
        return out
    stack = [enter(root, 0, 0)]
    while True:
        node, start, end, children, sums = stack[-1]
        found = next(children, None)
        if found is not None:
            stack.append(enter(found[1], end + 1, sums.seen + sums.n))
            continue
        stack.pop()
        leave(node, start, end, sums)
        if not stack:
            return out
        up = stack[-1][-1]
        up.n += sums.n
        up.first = sums.first if up.first is None else min(up.first, sums.first)
        up.begun += sums.begun
        up.any = up.any or sums.any
        up.leaves += sums.leaves
        up.total += sums.total
        up.distinct += sums.distinct
        up.tops += sums.tops


BLOCKS = "part int, block int, members array<long>, keys array<binary>, key_before binary, key_after binary"
PARTS = ("node binary, parent binary, part int, block int, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends_sha256 string, ends array<long>")
MERGED = ("node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
          "ends_sha256 string")


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(),
             "array<long>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _batches(rows: Iterator[tuple], ddl: str, weight, limit: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    schema, held, total = _schema(ddl), [], 0
    for row in rows:
        held.append(row)
        total += weight(row)
        if total >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _blocks(keys: DataFrame, block_members: int, block_bytes: int) -> DataFrame:
    """The sorted keys in blocks, each with the key before and the key after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def rows() -> Iterator[tuple]:
            block, members, found, size, before = 0, [], [], 0, None
            for batch in batches:
                for key, member in zip(*(c.to_pylist() for c in batch.columns)):
                    if len(members) >= block_members or size >= block_bytes:
                        yield part, block, members, found, before, key
                        block, before, members, found, size = block + 1, found[-1], [], [], 0
                    members.append(member)
                    found.append(key)
                    size += len(key)
            if members:
                yield part, block, members, found, before, None

        return _batches(rows(), BLOCKS, lambda row: 1, 1)

    blocks = staged(
        keys.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(run, BLOCKS),
        "trie", "blocks")
    # a task's first and last keys meet those of the tasks beside it: one row a task
    edges = blocks.groupBy("part").agg(
        F.min_by(F.col("keys")[0], "block").alias("first"), F.max_by(F.element_at("keys", -1), "block").alias("last"))
    order = Window.orderBy("part")
    edges = edges.select("part", F.lag("last").over(order).alias("lower"), F.lead("first").over(order).alias("upper"))
    return blocks.join(edges, "part").select(
        "part", "block", "members", "keys", F.coalesce("key_before", F.when(F.col("block") == 0, F.col("lower"))).alias("key_before"),
        F.coalesce("key_after", "upper").alias("key_after"))


def _walked(blocks: DataFrame) -> DataFrame:
    """The trie nodes of every block, whole ones finished and others in parts."""

    def digest(text: bytes) -> bytes:
        return hashlib.sha256(text).digest()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, block, members, keys, lower, upper = (c[i].as_py() for c in batch.columns)
                before = _common(lower, keys[0]) // WIDTH if lower is not None else -1
                after = _common(keys[-1], upper) // WIDTH if upper is not None else -1
                found = nodes_of(members, keys, before, after)
                for depth, first, n, children, leaves, saved, at, whole, ends, up in found:
                    over = found[up] if up >= 0 else None
                    parent = digest(keys[at][:(depth - 1) * WIDTH]) if over and not over[7] else None
                    if whole:
                        text = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
                        yield None, parent, part, block, depth, first, None if parent or not over else over[1], n, children, leaves, saved, text, None
                    else:
                        yield digest(keys[at][:depth * WIDTH]), parent, part, block, depth, first, None, n, children, leaves, saved, None, ends

    return staged(blocks.mapInArrow(lambda batches: _batches(rows(batches), PARTS, lambda r: 1 + len(r[-1] or ()), 1 << 14), PARTS), "trie", "parts")


def _merged(parts: DataFrame) -> DataFrame:
    """The sums of each node's parts; its members are digested as they stream by, in the order of blocks."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        node, sums, text = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                name, parent, depth, first, n, children, leaves, saved, ends = (c[i].as_py() for c in batch.columns)
                if name != node:
                    if node is not None:
                        yield *sums, text.hexdigest()
                    node, sums, text, any_end = name, [name, parent, depth, first, 0, 0, 0, 0], hashlib.sha256(), False
                sums[3] = min(sums[3], first)
                for k, v in enumerate((n, children, leaves, saved), 4):
                    sums[k] += v
                if ends:
                    text.update((("," if any_end else "") + ",".join(map(str, ends))).encode())
                    any_end = True
        if node is not None:
            yield *sums, text.hexdigest()

    ordered = parts.filter("node IS NOT NULL").repartition("node").sortWithinPartitions("node", "part", "block")
    columns = ["node", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    return staged(ordered.select(*columns).mapInArrow(lambda batches: _batches(rows(batches), MERGED, lambda r: 1), MERGED), "trie", "merged")


def trie(keys: DataFrame, *, block_members: int = 1 << 14, block_bytes: int = 1 << 22) -> DataFrame:
    """A row for each node of the trie over ``keys`` (conv_id, key: whole ids, one after another).

    ``depth`` in turns; ``conv_id``, the smallest member; ``parent_conv_id``, the parent's; ``n_convs``, its members;
    ``n_children``; ``n_leaves``, the childless nodes in its subtree; ``saved_tokens``, summed over the subtree, the
    members but one times the length of the last text; ``ends_sha256`` of the members that end there.
    """
    parts = _walked(_blocks(keys, block_members, block_bytes))
    merged = _merged(parts)
    columns = ["parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = parts.filter("node IS NULL").select(*columns)
    named = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("named"))
    # the children of the root may be most of the rows: Spark splits them as a skewed key
    open_ = whole.filter("parent IS NOT NULL").unionByName(
        merged.filter("parent IS NOT NULL").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*columns))
    joined = open_.join(named, "parent").withColumn("parent_conv_id", F.col("named"))
    top = merged.filter("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long"))
    result = ["conv_id", "depth", *columns[3:]]
    return whole.filter("parent IS NULL").select(*result).unionByName(joined.select(*result)).unionByName(top.select(*result))
