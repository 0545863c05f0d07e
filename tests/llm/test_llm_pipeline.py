import hashlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

import odd
from test_llm_dedup import expected_components
from test_llm_rules import failed, labelled, restated


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    docs, labels = labelled(spark, 200)
    extra = spark.createDataFrame([(10_000 + k if r[0] is not None else None, r[1], r[2], r[3], r[4]) for k, r in enumerate(odd.rows())],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    good = [r["text"] for r in docs.where("doc_id % 5 = 3").orderBy("doc_id").limit(4).collect()]
    planted = [(20_000, good[0], "en", "s", 1), (20_001, good[1] + " tail", "en", "s", 1),
               (20_002, good[2] + " write to a.b@c.de please " + good[3], "en", "s", 1)]
    docs = docs.unionByName(extra).union(spark.createDataFrame(planted, docs.schema))
    docs.write.parquet(str(path / "documents.parquet"))
    labels.write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame([(1, good[1][:150])], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = {"": docs.cache()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "token_ids":
            assert docs.columns == steps[""].columns
        steps[name] = docs = docs.cache()
    rows = {k: [tuple(r) for r in d.collect()] for k, d in steps.items()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "benchmark_leaks", "personal_data", "token_ids"]
    kept = rows["quality_rules"]
    assert set(kept) <= set(rows[""]) and not any(failed(restated(r[1])[0], restated(r[1])[4]) for r in kept)
    assert {r[0] for r in kept if r[0] is not None and r[0] < 200} >= {k for k in range(200) if k % 5 >= 2 and k not in ()} - {
        r[0] for r in rows[""] if failed(restated(r[1])[0], restated(r[1])[4])}
    expected, group = expected_components(kept, 2)
    assert sorted((r[0] for r in rows["near_duplicates"]), key=str) == sorted({c for _, _, c in expected}, key=str)
    gone = {r[0] for r in rows["near_duplicates"]} - {r[0] for r in rows["benchmark_leaks"]}
    assert gone and 20_001 not in {r[0] for r in rows["benchmark_leaks"]}
    masked = {r[0]: r[1] for r in rows["personal_data"]}
    assert "[EMAIL]" in masked[20_002] and "@" not in masked[20_002]
    assert len(masked) == len(rows["benchmark_leaks"])
    for doc_id, n, ids_sha, text_sha, ids in rows["token_ids"]:
        assert n == len(ids) and ids_sha == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert text_sha == hashlib.sha256(masked[doc_id].encode()).hexdigest()
    odd.same([tuple(r) for r in corpus_pipeline.run(spark, folder).collect()], rows["token_ids"])
    for d in steps.values():
        d.unpersist()
