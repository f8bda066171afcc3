import random
import re

from ticksmith.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(text, items, window=10):
    words = WORD.findall(_lower(text))
    hit, found = set(), set()
    for item, it in items:
        w = WORD.findall(_lower(it))
        k = min(window, len(w))
        if not k:
            continue
        wins = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}
        for i in range(len(words) - k + 1):
            if tuple(words[i:i + k]) in wins:
                hit.update(range(i, i + k))
                if item is not None:
                    found.add(item)
    return len(words), len(hit), sorted(found)


def _cases(seed, alphabet):
    rng = random.Random(seed)

    def some(n):
        return rng.choice([" ", "\n", ", ", "-"]).join(rng.choice(alphabet) for _ in range(n))

    items = [(i, some(rng.choice([0, 1, 2, 3, 9, 10, 11, 25]))) for i in range(8)] + [(3, some(12)), (None, some(12)), (9, None)]
    texts = [None, "", "!!! ...", *(some(rng.randint(0, 120)) for _ in range(30))]
    for _ in range(20):
        texts.append(f"{some(5)} {rng.choice(items)[1] or ''} {some(5)} {rng.choice(items)[1] or ''}".upper())
    return texts, items


def test_matcher_equals_brute_force():
    for seed in range(30):
        texts, items = _cases(seed, ["a", "b", "A"] if seed % 2 else ["the", "Öl", "of", "été", "x1", "42", "zu", "und"])
        search = decontam.WordSearch([(i, t.encode() if t is not None else None) for i, t in items], 10, 1 + seed % 3)
        for text in texts:
            n, h, spans, found = search.search(text.encode() if text is not None else None)
            assert (n, h, found) == brute(text, items)
            assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_operator_with_blocks_nulls_repeats_and_other_columns(spark):
    texts, items = _cases(7, ["the", "Öl", "of", "été", "x1"])
    rows = [(i if i % 5 else None, t, "x") for i, t in enumerate(texts)] + [(1, texts[-1], "y")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string").withColumn("item_id", docs_id())
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((r[0] is not None, r[0] or 0, brute(r[1], items)) for r in rows)
    for block_mb in (32, 0.0001):
        found = decontam.search_benchmark(docs, bench, result_col="res", block_mb=block_mb)
        got = sorted((r.doc_id is not None, r.doc_id or 0, (r.res.n_words, r.res.n_hit, r.res["items"])) for r in found.collect())
        assert got == want
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(brute(r[1], items)[1] == 0 for r in rows)


def docs_id():
    from pyspark.sql import functions as F

    return F.lit(5)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.search_benchmark(docs, none).first().hits.n_hit == 0
    assert decontam.search_benchmark(docs.limit(0), none).count() == 0
