"""Approximate nearest neighbours by multiprobe p-stable hashing.

``tables`` hash tables each cut space by ``projections`` Gaussian projections into cells of
width ``width``; the same for all rows, so every row is indexed.  For Euclidean distance the
projected difference between a query and a neighbour at distance r is normal with deviation r,
which gives every bucket (the query's own and all perturbed ones that hold rows) its chance to
hold that neighbour.  A query visits buckets in falling order of that chance until ``success``
of it is covered, r being the distance of the k-th best row it has found so far: at least that
of its own k-th neighbour, however near or far that is.  r falls as rows are found, so visits go
in rounds, each with the r of then; a query that has not found k rows visits all.  The
candidates of all tables are merged (a pair that was compared is not compared again) and ranked
by exact distance.  There is no cap on candidates.

The projections are at right angles and of one length where the dimension allows, so that no
draw of them is much better or worse than another.  The cells' width is fitted on a sample of
about ``sample`` rows (a documented bound): the distance of the k-th neighbour that nine in ten
rows are within.  It sets how finely rows are bucketed, not which distances are covered.

Queries are taken in blocks of a bounded number of bytes, each sent to all tasks; a task hashes
its rows chunk by chunk and keeps the best k per query, so what is shuffled is k rows per query
and task, whatever group of equal vectors or bucket may hold a third of all rows.

Defined results: vectors that are null, zero or hold null or non-finite components take no
part, nor do rows with a null id; vectors are compared with those of their own length; rows
that share the query's id count as the query's own; a query row that repeats is answered once (one id with
several vectors is one query, near to any of them);
ties go to the smaller id; with fewer rows than k all that were found are returned; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOUND = "query_id long, vec_id long, score double"
_CHUNK, _QUERIES = 32_768, 2_048
_ROUNDS = (0.3, 0.6)  # shares of ``success`` that the rounds before the last one cover


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    """Phi by a rational approximation (error under 1e-7): it orders visits and ends them."""
    t = 1 / (1 + 0.2316419 * np.abs(x))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return np.where(x >= 0, 1 - tail, tail)


@dataclass
class Hashes:
    """The projections of all tables, the same in every task."""

    dim: int
    scale: float
    tables: int = 2
    projections: int = 3
    width: float = 1.0  # in units of the scale
    success: float = 0.7  # of one table: two miss a neighbour at that distance in 0.3 * 0.3 of all cases
    seed: int = 7

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        self.a = rng.normal(size=(self.tables, self.dim, self.projections))
        n = self.tables * self.projections
        if self.dim >= n:
            straight = np.linalg.qr(self.a.transpose(1, 0, 2).reshape(self.dim, n))[0] * math.sqrt(self.dim)
            self.a = np.ascontiguousarray(straight.reshape(self.dim, self.tables, self.projections).transpose(1, 0, 2))
        self.b = rng.uniform(0, self.width * self.scale, (self.tables, self.projections))

    def project(self, table: int, x: np.ndarray) -> np.ndarray:
        return x @ self.a[table] + self.b[table]

    def visits(self, table: int, queries: np.ndarray, cells: np.ndarray, sizes: np.ndarray, reach: np.ndarray,
               success: float, least: int) -> np.ndarray:
        """(queries, buckets) booleans: the buckets to visit, of those that hold rows, for neighbours within ``reach``.

        Where no reach is known (infinite) those nearest by the scale, until they hold ``least`` rows.
        """
        w, y = self.width * self.scale, self.project(table, queries)
        unknown = ~np.isfinite(reach)
        r = np.maximum(np.where(unknown, self.scale, reach), 1e-6 * self.scale)[:, None]
        chance = np.ones((len(queries), len(cells)))
        for i in range(self.projections):
            edges, at = np.unique(cells[:, i], return_inverse=True)
            low = edges[None, :] * w - y[:, i:i + 1]
            chance *= (_normal_cdf((low + w) / r) - _normal_cdf(low / r))[:, at]
        order = np.argsort(-chance, axis=1, kind="stable")
        ranked = np.take_along_axis(chance, order, axis=1)
        go = np.cumsum(ranked, axis=1) - ranked < success
        if unknown.any():
            held = sizes[order[unknown]]
            go[unknown] = np.cumsum(held, axis=1) - held < least
        out = np.zeros(chance.shape, bool)
        np.put_along_axis(out, order, go, axis=1)
        return out


class Best:
    """The k nearest rows of every query so far, by exact distance and then id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.square = (vectors**2).sum(axis=1)
        self.score = np.full((len(ids), k), np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, skip: np.ndarray | None) -> None:
        """Compare queries ``q`` (positions) with rows; ``skip`` marks pairs that were compared before."""
        rough = self.square[q, None] + (rows**2).sum(axis=1) - 2 * (self.vectors[q] @ rows.T)
        rough[self.ids[q, None] == ids] = np.inf
        if skip is not None:
            rough[skip] = np.inf
        slack = 1e-9 * (1 + self.square[q])
        bar = self.score[q, -1] ** 2
        if len(ids) > self.k:
            bar = np.minimum(bar, np.partition(rough, self.k - 1, axis=1)[:, self.k - 1])
        i, j = np.nonzero((rough <= (bar + 2 * slack)[:, None]) & np.isfinite(rough))
        for at in range(0, len(i), 1 << 17):
            self._merge(q[i[at:at + (1 << 17)]], ids[j[at:at + (1 << 17)]], rows[j[at:at + (1 << 17)]])

    def _merge(self, q: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(q):
            return
        score = np.sqrt(((self.vectors[q] - rows) ** 2).sum(axis=1))
        touched = np.unique(q)
        all_q = np.concatenate([q, np.repeat(touched, self.k)])
        all_s = np.concatenate([score, self.score[touched].ravel()])
        all_i = np.concatenate([ids, self.found[touched].ravel()])
        order = np.lexsort((all_i, all_s, all_q))
        all_q, all_s, all_i = all_q[order], all_s[order], all_i[order]
        rank = np.arange(len(all_q)) - np.searchsorted(all_q, touched)[np.searchsorted(touched, all_q)]
        keep = rank < self.k
        self.score[all_q[keep], rank[keep]], self.found[all_q[keep], rank[keep]] = all_s[keep], all_i[keep]


def search_chunk(hashes: Hashes, best: Best, ids: np.ndarray, rows: np.ndarray) -> None:
    """All queries of ``best`` against one chunk of rows: hash it into all tables and visit their buckets."""
    buckets = []
    for t in range(hashes.tables):
        cells = np.floor(hashes.project(t, rows) / (hashes.width * hashes.scale)).astype(np.int64)
        distinct, inverse = np.unique(cells, axis=0, return_inverse=True)
        inverse = inverse.ravel()
        order = np.argsort(inverse, kind="stable")
        buckets.append((distinct, inverse, np.split(order, np.cumsum(np.bincount(inverse))[:-1])))
    widest = max(len(cells) for cells, _, _ in buckets)
    step = max(64, min(_QUERIES, (1 << 22) // widest))  # bounds what a table of chances takes
    for at in range(0, len(best.ids), step):
        some = np.arange(at, min(at + step, len(best.ids)))
        visited = [np.zeros((len(some), len(cells)), bool) for cells, _, _ in buckets]
        for round_, share in enumerate((*_ROUNDS, 1.0)):
            least = len(rows) if round_ else 2 * best.k
            for t, (cells, inverse, members) in enumerate(buckets):
                reach = best.score[some, -1]
                sizes = np.bincount(inverse, minlength=len(cells))
                wanted = hashes.visits(t, best.vectors[some], cells, sizes, reach, share * hashes.success, least) & ~visited[t]
                for bucket in np.flatnonzero(wanted.any(axis=0)):
                    q, m = np.flatnonzero(wanted[:, bucket]), members[bucket]
                    earlier = [visited[u][q][:, buckets[u][1][m]] for u in range(len(buckets)) if u != t]
                    best.add(some[q], ids[m], rows[m], reduce(np.logical_or, earlier) if earlier else None)
                visited[t] |= wanted


def _valid(vec: Column) -> Column:
    d = F.transform(vec, lambda x: x.cast("double"))
    finite = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(d, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _scale(rows: DataFrame, n: int, k: int, sample: int) -> float:
    """The distance of the k-th neighbour that nine in ten rows are within, on a sample of about ``sample`` rows drawn by a hash of the id."""
    share = min(1.0, sample / n)
    chosen = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1 << 40)) < int(share * (1 << 40)))
    x = np.array([r.vec for r in chosen.limit(2 * sample).collect()], np.float64)
    if len(x) < 2:
        return 1.0
    some = x[:256]
    d = np.sqrt(np.maximum((some**2).sum(1)[:, None] + (x**2).sum(1) - 2 * some @ x.T, 0))
    d.sort(axis=1)
    place = min(len(x) - 1, max(1, math.ceil(k * len(x) / n)))
    return float(np.quantile(d[:, place], 0.9)) or 1.0


def search(
    rows: DataFrame, is_query: Column, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
    block_bytes: int = 32 << 20, sample: int = 4096, **hashing,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query row, ``is_query`` being a condition on ``rows``."""
    spark = rows.sparkSession
    vectors = rows.filter(_valid(rows[vec_col]) & rows[id_col].isNotNull()).select(
        rows[id_col].cast("long").alias("vec_id"), rows[vec_col].cast("array<double>").alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("asked"))
    parts = []
    for dim, n, asked in sorted(vectors.groupBy(F.size("vec")).agg(F.count(F.lit(1)), F.sum(F.col("asked").cast("long"))).collect()):
        mine = vectors.filter(F.size("vec") == dim)
        hashes = Hashes(dim, _scale(mine, n, k, sample), **hashing)
        blocks = max(1, -(-asked * dim * 8 // block_bytes))
        for block in range(blocks if asked else 0):
            chosen = mine.filter(F.col("asked") & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block)).select("vec_id", "vec")
            got = chosen.distinct().toArrow()
            if got.num_rows:
                ids = got.column("vec_id").to_numpy()
                held = spark.sparkContext.broadcast((ids, _matrix(got.column("vec").combine_chunks(), dim)))
                parts.append(mine.select("vec_id", "vec").mapInArrow(_task(hashes, held, k, dim), FOUND))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return reduce(DataFrame.unionAll, parts).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _task(hashes: Hashes, held, k: int, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, ids, rows, n = Best(*held.value, k), [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                ids.append(part.column(0).to_numpy())
                rows.append(_matrix(part.column(1), dim))
                n += part.num_rows
                if n >= _CHUNK:
                    search_chunk(hashes, best, np.concatenate(ids), np.concatenate(rows))
                    ids, rows, n = [], [], 0
        if n:
            search_chunk(hashes, best, np.concatenate(ids), np.concatenate(rows))
        q, place = np.nonzero(np.isfinite(best.score))
        for at in range(0, len(q), 1 << 16):
            i, j = q[at:at + (1 << 16)], place[at:at + (1 << 16)]
            yield pa.RecordBatch.from_pandas(pd.DataFrame(
                {"query_id": best.ids[i], "vec_id": best.found[i, j], "score": best.score[i, j]}), preserve_index=False)

    return run
