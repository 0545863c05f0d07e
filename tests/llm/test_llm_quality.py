import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from jobuse.llm import quality, queries

import odd


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        w = odd.words(rng, rng.randrange(60, 160), 4000)
        kind = k % 8
        if kind == 0:
            w = [x + "***" for x in w]
        elif kind == 1:
            w = [x.upper() for x in w]
        elif kind == 2:
            w = w[:9] * 12
        rows.append((k, " ".join(w)))
    return rows


def test_tells_junk_from_prose(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.fit(docs)
    assert set(model.accuracies) == set(quality.LABELERS)
    held_out = corpus(seed=2)
    scored = quality.score(spark.createDataFrame(held_out, "doc_id long, text string"), model).collect()
    right = sum((r["score"] >= 0.5) == (r["doc_id"] % 8 > 2) for r in scored)
    assert right >= 0.95 * len(scored)


def test_scores_do_not_depend_on_slices(monkeypatch):
    texts = [t or "" for t in odd.texts()]
    weights = np.random.default_rng(1).normal(size=64 + quality.BINS + 1)
    whole = quality._scores(*quality.features(pa.array(texts, pa.large_string()), 64), weights)
    alone = [quality._scores(*quality.features(pa.array([t], pa.large_string()), 64), weights)[0] for t in texts]
    assert np.allclose(whole, alone)


def test_odd_documents_and_query(spark, tmp_path):
    rows = odd.rows()
    spark.createDataFrame(rows, odd.SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op10_weak_quality(spark, str(tmp_path)).collect()
    assert sorted(map(str, (r["doc_id"] for r in found))) == sorted(str(r[0]) for r in rows)
    wordless = {r[0] for r in rows if not (r[1] or "").split() and r[0] is not None}
    assert all(r["score"] == 0 and not r["kept"] for r in found if r["doc_id"] in wordless)
    scored = quality.score(odd.documents(spark), quality.Classifier(np.zeros(64 + quality.BINS + 1), {}), score_col="key")
    assert scored.columns == odd.documents(spark).columns
    model = quality.fit(odd.empty(spark))
    assert not model.weights.any() and quality.score(odd.empty(spark), model).collect() == []


def test_the_training_bound_holds_for_rows_alike(spark):
    """20,000 rows alike in id and text, and others: no more than the bound reach the training task."""
    docs = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("some words alike").alias("text")).unionByName(
        spark.createDataFrame(corpus(200), "doc_id long, text string"))
    n = quality.training_rows(docs, quality.Trainer(max_training=600), 20_200).count()
    assert 500 < n <= 600
    assert quality.training_rows(docs, quality.Trainer(max_training=30_000), 20_200).count() == 20_200
