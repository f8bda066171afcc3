import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from ticksmith.operators import exactsum


def nearest(values):
    """The double nearest to the true sum."""
    exact = sum(map(Fraction, values), Fraction(0))
    return exact.numerator / exact.denominator  # Python's division of whole numbers rounds correctly


def summed(df):
    """{g: (sum, count)} of a frame of g and v."""
    cols = [c.alias(n) for n, c in exactsum.parts("v").items()]
    return {r.g: (r.s, r.n) for r in exactsum.with_total(df.groupBy("g").agg(F.count("v").alias("n"), *cols), "s").collect()}


def groups():
    rng = random.Random(4)
    kinds = [
        lambda: rng.uniform(0, 600), lambda: round(rng.uniform(0, 600), 2), lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12),
        lambda: rng.choice([1e16, -1e16, 1.0, 1e-9, 3.0]), lambda: rng.uniform(-1, 1) * 2.0**61, lambda: rng.uniform(0, 1) * 2.0**-40,
        lambda: float(rng.randint(-2**53, 2**53)), lambda: rng.choice([0.0, -0.0, 2.0**21, -2.0**21, 2.0**55 + 8, 0.5, 2.0**-40]),
        lambda: -round(rng.uniform(0, 5e-5), 8)]
    return [[kind() for _ in range(rng.choice([1, 2, 3, 50, 400]))] for kind in kinds for _ in range(12)]


def test_nearest_double_in_any_order_and_split(spark):
    data = groups()
    want = {g: nearest(vs) for g, vs in enumerate(data)}
    rows = [(g, v) for g, vs in enumerate(data) for v in vs]
    for seed, n in ((1, 1), (2, 4), (3, 7)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "g int, v double").repartition(n)
        assert summed(df) == {g: (t, len(data[g])) for g, t in want.items()}


def test_stored_parts_merge_to_the_same_sum(spark):
    data = groups()
    df = spark.createDataFrame([(g, i % 3, v) for g, vs in enumerate(data) for i, v in enumerate(vs)], "g int, k int, v double")
    parts = df.groupBy("g", "k").agg(*[c.alias(n) for n, c in exactsum.parts("v").items()])
    merged = parts.groupBy("g").agg(*[c.alias(n) for n, c in exactsum.merged().items()])
    got = exactsum.with_total(merged, "s").collect()
    assert {r.g: r.s for r in got} == {g: nearest(vs) for g, vs in enumerate(data)}


def test_values_without_digits_and_nulls(spark):
    rows = [(1, float("nan")), (1, 1.0), (2, float("inf")), (2, 5.0), (3, float("inf")), (3, float("-inf")), (4, 2.0**62), (4, 1.5), (5, None),
            (6, None), (6, 2.5), (7, 1e300), (8, 5e-324), (8, 5e-324)]
    got = {g: s if n else None for g, (s, n) in summed(spark.createDataFrame(rows, "g int, v double")).items()}
    assert math.isnan(got[1]) and got[2] == math.inf and math.isnan(got[3]) and got[4] == 2.0**62 + 1.5
    assert got[5] is None and got[6] == 2.5 and got[7] == 1e300 and 0 <= got[8] <= 1e-29


def test_queries_are_equal_bit_for_bit_over_any_files(spark, tmp_dir):
    from ticksmith.plans import registry

    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    names = ["tumbling_hla_5m", "tumbling_hla_1d", "tumbling_avg_1m", "null_time_dropped"]
    first = {}
    for n in (1, 4, 7):
        events.repartition(n, "event_id").write.parquet(f"{tmp_dir}/{n}/events.parquet")
        for name in names:
            rows = sorted(map(tuple, registry.QUERIES[name](spark, f"{tmp_dir}/{n}").collect()))
            assert first.setdefault(name, rows) == rows and rows, (name, n)
