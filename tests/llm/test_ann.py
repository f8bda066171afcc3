import numpy as np
from pyspark.sql import functions as F

from ticksmith.llm import ann
from ticksmith.llm.queries import op6_nearest

SCHEMA = "vec_id long, embedding array<float>, score double"


def brute(rows, asked, k=10):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in ok:
        if asked(q):
            out[q] = sorted((float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in ok if i != q and len(b) == len(a))[:k]
    return out


def _by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_full_success_is_exact_with_ties_and_bad_rows(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 8)).astype(np.float32)
    rows = [(i, base[i % 60].tolist()) for i in range(200)]  # every vector three times or more
    rows += [(1000, None), (1010, []), (1020, [0.0] * 8), (1030, [float("nan")] + [1.0] * 7), (1040, [None] + [1.0] * 7),
             (1050, [float("inf")] * 8), (None, [1.0] * 8), (1060, [1.0, 2.0]), (1070, [1.0, 2.5]), (1080, [3.0])]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], SCHEMA)
    got = _by_query(ann.search(df, F.col("vec_id") % 10 == 0, success=2.0, block_bytes=300))
    want = {q: v for q, v in brute(rows, lambda i: i % 10 == 0).items() if v}
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-14, atol=0)
    assert ann.search(df.limit(0), F.lit(True)).count() == 0


def test_recall_of_the_query(spark):
    for sf in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
        want, got = brute(rows, lambda i: i % 100 == 0), _by_query(op6_nearest(spark, sf))
        assert got.keys() == want.keys()
        hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
        assert hits / sum(map(len, want.values())) >= 0.9
        vectors = {i: np.array(v, np.float64) for i, v in rows}
        for q, found in got.items():
            assert found == sorted(found)
            for s, i in found:
                assert abs(s - np.linalg.norm(vectors[q] - vectors[i])) < 1e-12


def test_recall_of_every_kind_of_query(spark):
    """Rows in dense groups beside evenly spread ones, and norms that vary: no kind of query loses its neighbours."""
    rng = np.random.default_rng(3)
    n = 20000
    even = rng.normal(size=(n, 64))
    even /= np.linalg.norm(even, axis=1, keepdims=True)
    grouped = rng.random(n) < 0.6
    near = even[rng.integers(0, 300, n)] + 0.03 * rng.normal(size=(n, 64))
    for vectors in (np.where(grouped[:, None], near, even), even * rng.lognormal(0, 0.5, (n, 1))):
        rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
        got = _by_query(ann.search(spark.createDataFrame([(*r, 0.5) for r in rows], "vec_id long, embedding array<double>, score double"),
                                   F.col("vec_id") % 100 == 0))
        asked = np.arange(0, n, 100)
        for kind in (asked[grouped[asked]], asked[~grouped[asked]]):
            hits = 0
            for q in kind:
                away = np.linalg.norm(vectors - vectors[q], axis=1)
                away[q] = np.inf
                hits += len(set(np.argsort(away)[:10]) & {i for _, i in got[q]})
            assert hits / (10 * len(kind)) >= 0.9
