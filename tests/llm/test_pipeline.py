import corpus_pipeline
from pyspark.sql import functions as F

from test_decontam import brute as windows
from test_packing import _ids
from test_secrets import brute as base_spans
from test_simhash import brute_components, brute_fingerprint

from ticksmith.llm import langid

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id: r for r in docs.collect() if r.text and langid._LETTER.search(r.text)}
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out[name] = docs.collect()
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    assert {r.doc_id: r for r in out["language_id"]} == kept
    fps = [(i, brute_fingerprint(r.text)) for i, r in kept.items()]
    kept = {i: kept[i] for i in set(brute_components(fps))}
    assert {r.doc_id: r for r in out["near_duplicates"]} == kept
    kept = {i: r for i, r in kept.items() if not windows(r.text, items)[1]}
    assert {r.doc_id: r for r in out["benchmark_decontamination"]} == kept
    after = {r.doc_id: r for r in out["secret_scan"]}
    assert after.keys() == kept.keys()
    for i, r in after.items():
        assert not base_spans(r.text) and (r == kept[i] or r.n_chars == len(r.text))
    ids = dict(zip(after, _ids([r.text for r in after.values()])))
    for i, want in ids.items():
        pieces = sorted((p for p in out["packing"] if p.doc_id == i), key=lambda p: p.start)
        assert [t for p in pieces for t in p.ids] == want


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_language_stage_drops_garble_and_keeps_all_without_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    odd = spark.createDataFrame([(-1, "今天天气很好我们一起去公园散步吧" * 9, "en", "s", 144), (-2, "Qx7/zK+9vB" * 20 + "w8Jq" * 50, "en", "s", 400)], docs.schema)
    both = docs.unionByName(odd)
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, both, SF).collect()}
    assert kept == {r.doc_id for r in docs.collect()}
    bare = both.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, bare, SF).count() == both.count()
