import hashlib
import random
import zlib

import pytest

from ticksmith.llm import prefixtrie as P
from ticksmith.llm.queries import op13_prefix_trie


def brute(convs):
    """convs: {conv_id: [(role, text), ...]}.  All nodes of the trie, as sorted tuples."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {}
    for node in members:
        if node:
            below.setdefault(node[:-1], []).append(node)
    stats = {}
    for node in sorted(members, key=len, reverse=True):
        kids = below.get(node, [])
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        stats[node] = (sum(stats[k][0] for k in kids) or 1, own + sum(stats[k][1] for k in kids))
    out = []
    for node, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(node))))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(below.get(node, [])), *stats[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def ids(turns):
    return b"".join(
        len(t.encode()).to_bytes(4, "big") + hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).digest()[:16] for r, t in turns)


def some(rng, n, words, longest):
    return {c * 3 - 5: [(rng.choice(["u", "a"]), rng.choice(words)) for _ in range(rng.randint(0, longest))] for c in range(n)}


CASES = [("empty", {}), ("one", {7: [("u", "x")]}), ("turnless", {1: [], 2: []}),
         ("copies", {c: [("u", "hé"), ("a", "")] for c in range(200)}),
         ("chain", {c: [("u", str(k)) for k in range(c)] for c in range(60)}),
         ("wide", {c: [("u", f"word {c}"), ("a", "y" * (c % 3))] for c in range(700)})]


@pytest.mark.parametrize("name,convs", [*CASES, *((f"mixed{k}", some(random.Random(k), 300, ["", "a", "bb", "ccc"], 6)) for k in range(3))])
def test_against_brute_force(spark, name, convs):
    if convs:
        keys = spark.createDataFrame([(c, bytearray(ids(t))) for c, t in convs.items()], "conv_id long, key binary")
    else:
        keys = spark.createDataFrame([], "conv_id long, key binary")
    for size in (7, 1 << 14):
        got = P.trie(keys.repartition(5), block_members=size).collect()
        assert sorted(map(tuple, got), key=repr) == brute(convs), size


def test_layouts_grow_and_keep_the_order():
    rng = random.Random(1)
    for n in (1, 4, 5, 16, 17, 48, 49, 256):
        order = rng.sample(range(256), n)
        node = P.Node(b"")
        for b in order:
            node.put(b, P.Node(bytes([b])))
        assert [b for b, _ in node.children()] == sorted(order)
        assert node.room == next(r for r in (4, 16, 48, 256) if n <= r)
        assert all((node.child(b).path == bytes([b])) if b in order else node.child(b) is None for b in range(256))
        node.put(order[0], P.Node(b"new"))
        assert node.child(order[0]).path == b"new" and len(list(node.children())) == n


def test_any_order_of_insertion_gives_the_same_tree():
    rng = random.Random(2)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(200)]

    def shape(order):
        root = None
        for k in order:
            root = P.insert(root, keys[k], k)

        def of(node):
            return node.path, sorted(node.members), [(b, of(n)) for b, n in node.children()]
        return of(root)

    assert shape(range(200)) == shape(rng.sample(range(200), 200))


def test_keys_order_nulls_ties_and_other_columns(spark):
    rows = [(1, 2, "a", "second", b"x"), (1, None, "u", "first", b"x"), (1, 5, None, None, b"x"), (2, 0, "u", "long" * 50_000, None),
            (None, 0, "u", "of no conversation", None), (3, 1, "u", "tie", b""), (3, 1, "u", "tie", b"")]
    got = {r.conv_id: bytes(r.key) for r in P.keys_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key binary")).collect()}
    assert got == {1: ids([("u", "first"), ("a", "second"), ("", "")]), 2: ids([("u", "long" * 50_000)]), 3: ids([("u", "tie")] * 2)}


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    own = {}
    for r in sorted(spark.read.parquet(f"{sf}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        own.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    assert sorted(map(tuple, op13_prefix_trie(spark, sf).collect()), key=repr) == brute(rebuilt)
