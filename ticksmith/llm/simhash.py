"""SimHash near-duplicates by vantage-point trees.

Fingerprints: texts are folded (A-Z lower-cased), cut into words ``[^\\x20\\x09-\\x0D]+`` and
shingles of ``shingle`` words (repeats included, joined by a space; fewer words: the whole
sequence); a bit is 1 if it is set in over half of the shingles' XXH64 (UTF-8, seed 42).

Links: distinct fingerprints are dealt to shards by a vantage-point tree, whose points are
drawn from a sample of at most ``sample`` fingerprints (a documented bound; it only places the
cuts).  Every node holds a point and a radius; a fingerprint within the radius belongs inside,
any other outside.  By the triangle inequality a pair at most ``max_bits`` apart can lie on
both sides of a cut only if the inner one is less than ``max_bits`` from the boundary, so
such inner ones also visit the outer side as queries.  Each shard builds its own tree in the
same way down to small leaves, compares exactly there, and returns a spanning forest of its
links (a row per fingerprint at most), never the pairs themselves.

Classes: connected components of the forests, by contraction: every node takes the least of
itself and its neighbours, edges are rewritten and made distinct, until none is left; then
the choices are followed back.  Every round is written to the shared folder.

Defined results: a null text, or one without words, has fingerprint zero, linked like any
other; repeated rows and equal texts share a fingerprint; the class is named by its smallest
non-null doc_id (null only if all are null); an empty table gives an empty result; other
columns are kept and cannot clash, the result is one struct column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.common import text_bytes
from ticksmith.session import staged

SEED = 42
_SLICE = 1 << 16
SALTS = 8


def fingerprint_of(text: bytes | None, shingle: int) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, total, _SLICE):
        part = words[at:min(at + _SLICE, total) + shingle - 1]
        if len(part) < shingle:
            joined = [b" ".join(part)]
        else:
            joined = map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        codes = np.array([digest(s, SEED) for s in joined], np.uint64)
        ones += np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The 64 bits as a signed long."""

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array(np.array([fingerprint_of(t, shingle) for t in text_bytes(texts)], np.uint64).view(np.int64))

    run.__annotations__ = {"parts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "long")(text)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _distance(codes: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(codes ^ point)


def _cut(codes: np.ndarray, rng: np.random.Generator, tries: int = 4) -> tuple[np.uint64, int] | None:
    """A point and radius that part the codes near the middle, or None if none of those tried does.

    Of the points tried, the one with the fewest codes just inside its boundary for their even parting.
    """
    best, cut = None, None
    for point in rng.choice(codes, min(tries, len(codes)), replace=False):
        counts = np.cumsum(np.bincount(_distance(codes, point), minlength=65))
        for radius in range(64):
            inner = counts[radius]
            if min(inner, len(codes) - inner) * 8 < len(codes):
                continue
            band = inner - (counts[radius - 2] if radius >= 2 else 0)
            cost = (max(inner, len(codes) - inner) + band) / len(codes)
            if best is None or cost < best:
                best, cut = cost, (point, radius)
    return cut


@dataclass
class Tree:
    """The cuts that deal fingerprints to shards; children are nodes, or shard numbers in leaves."""

    root: object
    shards: int

    @classmethod
    def fit(cls, sample: np.ndarray, shards: int) -> Tree:
        rng, made = np.random.default_rng(0), [0]

        def node(codes: np.ndarray, want: int):
            cut = _cut(codes, rng) if want > 1 and len(codes) > 1 else None
            if cut is None:
                made[0] += 1
                return made[0] - 1
            inside = _distance(codes, cut[0]) <= cut[1]
            share = min(want - 1, max(1, round(want * inside.mean())))
            return (*cut, node(codes[inside], share), node(codes[~inside], want - share))

        return cls(node(sample, shards), made[0])

    def deal(self, codes: np.ndarray, max_bits: int) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(shard, codes, home): every code once at home, and as a visitor wherever a link may cross."""

        def walk(node, at: np.ndarray, home: bool):
            if not len(at):
                return
            if isinstance(node, int):
                yield node, at, home
                return
            point, radius, inner, outer = node
            d = _distance(at, point).astype(np.int64)
            if home:
                yield from walk(inner, at[d <= radius], True)
                yield from walk(outer, at[d > radius], True)
                yield from walk(outer, at[(d <= radius) & (d > radius - max_bits)], False)
            else:
                yield from walk(inner, at[d <= radius + max_bits], False)
                yield from walk(outer, at[d > radius - max_bits], False)

        yield from walk(self.root, codes, True)


def links(members: np.ndarray, queries: np.ndarray, max_bits: int, leaf: int = 192) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (query, member) at most ``max_bits`` apart, as positions, block by block, by one tree over the members."""
    rng = np.random.default_rng(1)
    work = [(np.arange(len(members)), np.arange(len(queries)))]
    while work:
        m, q = work.pop()
        if not len(m) or not len(q):
            continue
        cut = _cut(members[m], rng) if len(m) > leaf else None
        if cut is None:
            for a in range(0, len(m), 2048):
                for b in range(0, len(q), 1024):
                    near = np.bitwise_count(queries[q[b:b + 1024], None] ^ members[None, m[a:a + 2048]]) <= max_bits
                    i, j = np.nonzero(near)
                    yield q[b:b + 1024][i], m[a:a + 2048][j]
            continue
        dm, dq = _distance(members[m], cut[0]).astype(np.int64), _distance(queries[q], cut[0]).astype(np.int64)
        work.append((m[dm <= cut[1]], q[dq <= cut[1] + max_bits]))
        work.append((m[dm > cut[1]], q[dq > cut[1] - max_bits]))


def forest(members: np.ndarray, visitors: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, root) for every code of a shard with a link there; roots stand for local components."""
    codes = np.concatenate([members, visitors])
    parent = np.arange(len(codes))

    def roots(x: np.ndarray) -> np.ndarray:
        while True:
            up = parent[x]
            if (up == x).all():
                return x
            parent[x] = parent[up]
            x = parent[x]

    for i, j in links(members, codes, max_bits):
        while True:
            a, b = roots(i), roots(j)
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
    root = roots(np.arange(len(codes)))
    linked = np.flatnonzero(root != np.arange(len(codes)))
    return codes[linked], codes[root[linked]]


def _edges(distinct: DataFrame, max_bits: int, shard_size: int, sample: int) -> DataFrame:
    """(a, b): a spanning set of the links between distinct fingerprints."""
    spark = distinct.sparkSession
    n = distinct.count()
    share = min(1.0, sample / max(n, 1))
    chosen = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(1 << 40)) < int(share * (1 << 40))) if share < 1 else distinct
    points = np.sort(np.array([r.fp for r in chosen.collect()], np.int64).view(np.uint64))
    held = spark.sparkContext.broadcast(Tree.fit(points, max(1, -(-n // shard_size))))
    shards = held.value.shards

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(0).to_numpy().view(np.uint64)
            for shard, at, home in held.value.deal(codes, max_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), shard, np.int32)), pa.array(np.full(len(at), home)), pa.array(at.view(np.int64))],
                    names=["shard", "home", "fp"])

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        codes, home = rows["fp"].to_numpy(np.int64).view(np.uint64), rows["home"].to_numpy(bool)
        a, b = forest(codes[home], codes[~home], max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "shard int, home boolean, fp long")
    return dealt.repartition(shards, "shard").groupBy("shard").applyInPandas(join, "a long, b long")


def _classes(edges: DataFrame) -> DataFrame:
    """(fp, root) for every node of the edges: one root per connected component."""
    steps = []
    edges = staged(edges.filter("a <> b"), "simhash", "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("up")), "simhash", "least")
        steps.append(least)
        moved = edges.join(least.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a").join(
            least.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b")
        edges = staged(moved.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).filter(
            "a <> b").distinct(), "simhash", "edges")
    if not steps:
        return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))
    found = steps[0].select(F.col("node").alias("fp"), F.col("up").alias("root"))
    for step in steps[1:]:
        found = found.join(step.withColumnRenamed("node", "root"), "root", "left").select(
            "fp", F.coalesce("up", "root").alias("root"))
    return found


def _fingerprinted(docs: DataFrame, id_col: str, text_col: str, carry: list[str], shingle: int) -> DataFrame:
    """(kept, id, row, fp), written: the columns carried, the id, a number of the row's own and the fingerprint."""
    kept = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(carry)], docs[id_col].alias("id"))
    return staged(docs.select(
        kept.alias("kept"), docs[id_col].cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
        fingerprint(docs[text_col], shingle).alias("fp")), "simhash", "rows")


def _rooted(rows: DataFrame, max_bits: int, shard_size: int, sample: int) -> DataFrame:
    """(fp, first, root): every distinct fingerprint, its first row (smallest id, nulls last) and its class."""
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row"))).alias("first")
    distinct = staged(rows.groupBy("fp").agg(first), "simhash", "distinct")
    found = _classes(_edges(distinct, max_bits, shard_size, sample))
    return staged(distinct.join(found, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash", "rooted")


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, shingle: int = 3,
    max_bits: int = 2, shard_size: int = 50_000, sample: int = 65_536, result_col: str = "simhash",
) -> DataFrame:
    """The columns ``carry`` (default: all) with a struct column of fingerprint (long) and component_id.

    Fingerprints are written once to the shared folder, beside the columns carried.
    """
    carry = docs.columns if carry is None else carry
    rows = _fingerprinted(docs, id_col, text_col, carry, shingle)
    rooted = _rooted(rows, max_bits, shard_size, sample)
    named = rooted.groupBy("root").agg(F.min("first.id").alias("component_id"))
    # a fingerprint that a third of all rows share is joined in parts
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    classes = rooted.join(named, "root").select("fp", "component_id", salts.alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.col("row"), F.lit(SALTS)).cast("int"))
    return salted.join(classes, ["fp", "salt"]).select(
        *[F.col("kept")[f"c{i}"].alias(c) for i, c in enumerate(carry)],
        F.struct(F.col("fp").alias("fingerprint"), "component_id").alias(result_col))


def keep_one(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
    shard_size: int = 50_000, sample: int = 65_536,
) -> DataFrame:
    """One row of each class, that with the smallest id (of equal ones the first row; null ids last)."""
    rows = _fingerprinted(docs, id_col, text_col, docs.columns, shingle)
    first = _rooted(rows, max_bits, shard_size, sample).groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(first.select(F.col("first.row").alias("row")), "row", "left_semi").select(
        *[F.col("kept")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)])
