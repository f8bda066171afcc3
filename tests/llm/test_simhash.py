import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ticksmith.llm import simhash
from ticksmith.llm.queries import op2_simhash


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """{position: smallest id reachable} by union-find over all pairs."""
    fps = [fp for _, fp in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                up[root(i)] = root(j)
    out = {}
    for i, (doc, _) in enumerate(rows):
        out.setdefault(root(i), []).append(doc)
    return [min(out[root(i)]) for i in range(len(rows))]


TEXTS = ["", None, " \t\n", "one", "One TWO", "a b c", "É b\x0bc d e f", "\x1cx \x85 y z w", "a b c " * 40000, "same text here now", "same text here now"]


def test_fingerprints(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in docs.select("text", simhash.hex_of(simhash.fingerprint(F.col("text"))).alias("h")).collect():
        assert r.h == f"{brute_fingerprint(r.text):016x}"


def _codes(seed, centres, around):
    rng = random.Random(seed)
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        out.add(c)
        for _ in range(rng.randint(0, around)):
            c ^= 1 << rng.randrange(64)
            c ^= 1 << rng.randrange(64)
            out.add(c)
    return np.array(sorted(out), np.uint64)


def test_every_link_is_found_across_shards():
    codes = _codes(3, 400, 8)
    tree = simhash.Tree.fit(codes[::3], 12)
    assert tree.shards > 4
    dealt = {}
    for shard, at, home in tree.deal(codes, 2):
        dealt.setdefault(shard, {True: [], False: []})[home].append(at)
    assert sorted(c for d in dealt.values() for a in d[True] for c in a.tolist()) == codes.tolist()
    found = set()
    for d in dealt.values():
        m = np.concatenate(d[True]) if d[True] else np.zeros(0, np.uint64)
        q = np.concatenate([m, *d[False]])
        for i, j in simhash.links(m, q, 2, leaf=8):
            found |= {frozenset((int(a), int(b))) for a, b in zip(q[i], m[j]) if a != b}
    want = {frozenset((int(a), int(b))) for a in codes for b in codes[(np.bitwise_count(codes ^ a) <= 2) & (codes != a)]}
    assert found == want and len(want) > 500


def test_components(spark, monkeypatch):
    codes = _codes(4, 60, 12)
    rng = random.Random(6)
    rows = [(i, int(c)) for i, c in enumerate(codes)] + [(1000 + i, int(rng.choice(codes[:5]))) for i in range(40)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, str(c)) for i, c in rows], "doc_id long, text string").withColumn("fp", F.lit("clash"))
    whole = "cast(text as decimal(20,0))"  # unsigned to signed
    signed = f"cast(if({whole} >= 9223372036854775808, {whole} - 18446744073709551616, {whole}) as bigint)"
    monkeypatch.setattr(simhash, "fingerprint", lambda text, n: F.expr(signed))
    got = {r.doc_id: r.simhash.component_id for r in simhash.near_duplicates(docs, shard_size=40).collect()}
    assert got == {i: c for (i, _), c in zip(rows, brute_components(rows))}


def test_nulls_repeats_and_empty(spark):
    rows = [(5, None), (3, ""), (None, "a b c d"), (9, "A b c d"), (9, "A b c d"), (None, "alone in the world")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.simhash.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (None, 9), (9, 9), (9, 9), (None, None)], key=str)
    assert sorted((tuple(r) for r in simhash.keep_one(docs).collect()), key=str) == sorted(
        [(3, ""), (9, "A b c d"), (None, "alone in the world")], key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == simhash.keep_one(docs.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {(i, f"{fp:016x}", c) for (i, fp), c in zip(rows, brute_components(rows))}
    assert {tuple(r) for r in op2_simhash(spark, sf).collect()} == want
