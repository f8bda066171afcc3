import math
from collections import defaultdict

import numpy as np
import pytest

from ticksmith.llm import langid
from ticksmith.llm.queries import op5_language_id

ROWS = [
    (1, "The quick brown fox is not in the house, and the dog is.", "en"),
    (2, "Der Hund ist nicht im Haus und der Fuchs ist braun.", "de"),
    (3, "El perro no está en la casa, y el zorro es marrón.", "es"),
    (4, "the the the and of", "en"),
    (5, None, "en"),
    (6, "ohne Sprache", None),
    (7, "", "de"),
]


def brute_lengths(rows, text):
    """Code lengths from plain dictionaries of context counts."""
    out = {}
    for lang in sorted({r[2] for r in rows if r[1] is not None and r[2]}):
        seen = defaultdict(lambda: defaultdict(int))
        for _, t, lang_of in rows:
            if lang_of == lang and t is not None:
                data = b"\n\n\n" + t.lower().encode()
                for i in range(3, len(data)):
                    for j in range(4):
                        seen[data[i - j:i]][data[i]] += 1
        bits = 0.0
        data = b"\n\n\n" + text.lower().encode()
        for i in range(3, len(data)):
            for j in (3, 2, 1, 0):
                ctx = seen.get(data[i - j:i])
                if not ctx:
                    continue
                n, q = sum(ctx.values()), len(ctx)
                if data[i] in ctx:
                    bits -= math.log2(ctx[data[i]] / (n + q))
                    break
                bits -= math.log2(q / (n + q))
            else:
                bits += 8
        out[lang] = bits
    return out


def test_code_lengths_equal_plain_dictionaries(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    texts = ["the fox", "Der Fuchs", "zorro ñandú 中文 99", "x", "a" * 50, "El perro es\n\n\nde la casa"]
    want = [brute_lengths(ROWS, t) for t in texts]
    assert model.langs == sorted(want[0])
    datas = [b"\n\n\n" + langid.folded(t) for t in texts]
    for got, w in zip(model._lengths_of_all(datas), want):
        assert got == pytest.approx([w[x] for x in model.langs], rel=1e-5)
    for d, w in zip(datas, want):
        assert model.lengths(d, chunk=5) == pytest.approx([w[x] for x in model.langs], rel=1e-5)


def test_results_of_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    odd = [None, "", "123 --- !!!", "the dog and the house", "der Hund und", "der Hund und", "the " * 400_000, "ñ"]
    rows = spark.createDataFrame([(i, t, "q") for i, t in enumerate(odd)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.language for r in langid.predict(rows, model).collect()}
    assert [got[i].lang for i in range(3)] == ["und"] * 3 and got[0].score == 0.0
    assert got[3].lang == "en" and got[4].lang == got[5].lang == "de" and got[6].lang == "en" and got[7].lang == "es"
    assert all(0 <= g.score <= 1 for g in got.values())


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    model = langid.fit(docs.limit(0))
    assert model.predict(["the", None]) == [("und", 0.0)] * 2
    assert langid.predict(docs.limit(0), langid.fit(docs)).count() == 0


def test_pruned_contexts_still_give_a_code(spark):
    counts = langid.gram_counts(spark.createDataFrame(ROWS, "doc_id long, text string, lang string"), "text", "lang").toPandas()
    model = langid.build(counts, max_contexts=5)
    assert np.isfinite(model.bits).all()
    assert model.predict(["the quick fox"])[0][0] == "en"


def test_sample_is_bounded_and_whole_where_small(spark):
    from pyspark.sql import functions as F

    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 50, "xx").otherwise("yy").alias("lang"))
    n = {r.lang: r["count"] for r in langid.sample(docs, "doc_id", "lang", 200).groupBy("lang").count().collect()}
    assert n["xx"] == 50 and 140 < n["yy"] < 270


def test_held_out_accuracy(spark):
    got = op5_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.filter("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_texts_that_fit_no_language(spark):
    """Garble and scripts without labels fit no language; the labelled texts, short ones and those with a key do."""
    import random

    rnd = random.Random(4)
    words = {"en": "the quick brown fox is not in house and dog of to a".split(), "de": "der hund ist nicht im haus und die katze auch".split()}
    rows = [(i, " ".join(rnd.choices(words[lang], k=60)), lang) for i in range(200) for lang in words]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = langid.fit_halves(docs)
    assert [sorted(m.limits) for m in models] == [["de", "en"]] * 2
    good = [t for _, t, _ in rows] + ["the", "x", "haus", "the dog is 0123456789 in the house", "the%%% dog$$$ is!!! in### the&&& house " * 30]
    key = "".join(rnd.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=400))
    bad = [None, "", "12 --", key, "今天天气很好我们一起去公园散步吧" * 5, "Сегодня хорошая погода, мы идём гулять в парк " * 3]
    odd = spark.createDataFrame([(i, t, None) for i, t in enumerate([*good, *bad])], docs.schema)
    fits = {r.doc_id: r.language.fits for r in langid.judge(odd, models).collect()}
    assert [fits[i] for i in range(len(good) + len(bad))] == [True] * len(good) + [False] * len(bad)
    # garble with a label teaches only the model of the other half
    taught = docs.unionByName(spark.createDataFrame([(-1, key, "en")], docs.schema))
    fits = {r.doc_id: r.language.fits for r in langid.judge(taught, langid.fit_halves(taught)).collect()}
    assert not fits.pop(-1) and all(fits.values())
    few = langid.fit_halves(docs.limit(4))
    assert few[0].limits == few[1].limits == {} and few[0].judge([key])[0][3]
    for m in langid.fit_halves(docs.limit(0)):
        assert m.judge(bad) == [("und", 0.0, None, True)] * len(bad)


def test_every_labelled_row_teaches_the_halves(spark):
    """Models and limits are those of all rows of a half, also where a language has thousands of them."""
    import random

    rnd = random.Random(6)
    words = {"en": "the quick brown fox is not in house and dog of to a".split(), "de": "der hund ist nicht im haus und die katze auch".split()}
    rows = [(2 * i + k, " ".join(rnd.choices(words[lang], k=8)) + f" {lang}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", lang)
            for i in range(5000) for k, lang in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    halves = docs.select("text", "lang", langid._half("doc_id").alias("half")).collect()
    for max_contexts in (12000, 40):
        models = langid.fit_halves(docs, max_contexts=max_contexts)
        for h, model in enumerate(models):
            taught = spark.createDataFrame([(r.text, r.lang) for r in halves if r.half != h], "text string, lang string")
            want = langid.build(langid.gram_counts(taught, "text", "lang").toPandas(), max_contexts)
            assert model.langs == want.langs and (model.classes == want.classes).all() and (model.contexts == want.contexts).all()
            assert (model.bits == want.bits).all()
            judged = [(lang, bits) for lang, _, bits, _ in want.judge([r.text for r in halves if r.half == h])]
            for lang in words:
                bits = sorted(b for of, b in judged if of == lang)
                half, quarter = (bits[math.ceil(len(bits) * q) - 1] for q in (0.5, 0.75))
                assert model.limits[lang] == pytest.approx(max(2.5 * half, quarter + 8 * (quarter - half)), abs=1e-3)


def test_number_signs_are_no_letters(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 30)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(0, "½"), (1, "² 12"), (2, "Ⅷ"), (3, "½ the")], "doc_id long, text string")
    got = {r.doc_id: (r.language.lang, r.language.score) for r in langid.predict(asked, model).collect()}
    assert [got[k] for k in range(3)] == [("und", 0.0)] * 3 and got[3][0] == "en"
