from collections import Counter

import corpus_pipeline
from driftsweep.llm import decontaminate, language_id, queries, simhash


def test_stages_take_effect_on_what_their_predecessor_kept(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    more = spark.createDataFrame([(90001, None, "en", "src1"), (90002, "123 ...", "en", "src1")], "doc_id long, text string, lang string, source string")
    docs = docs.unionByName(more, allowMissingColumns=True)
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        kept[name] = Counter(r.doc_id for r in out.select("doc_id").collect())
        if name == "language_id":
            assert set(kept[name]) == {r.doc_id for r in language_id.identify(docs).collect() if not r.rejected}
            assert 90001 not in kept[name] and 90002 not in kept[name]
        elif name == "simhash_near_dedup":
            assert set(kept[name]) == {r.component_id for r in simhash.near_duplicates(docs).collect()}
        elif name == "decontamination":
            bad = {r.doc_id for r in decontaminate.contaminated(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
            assert bad and set(kept[name]) == set(kept["simhash_near_dedup"]) - bad
        elif name == "source_mix":
            assert max(kept[name].values()) <= 2 and set(kept[name]) <= set(kept["decontamination"])
        else:
            assert kept[name] == kept["source_mix"]
            assert {r.law for r in out.collect()} == {"rows"}
        docs = out


def test_empty_documents_pass_all_stages(spark, empty, tmp_path):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.count() == 0


def test_registry_and_run(spark):
    names = list(queries.registry())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    got = queries.registry()["pipeline"](spark, "/root/testdata/sf0.001")
    assert {"doc_id", "shard", "slot"} <= set(got.columns) and got.count() > 100
