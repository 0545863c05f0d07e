import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import odd
from jobuse.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text) -> Counter:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return Counter(TERM.findall(low))


def expected(docs: list[tuple], items: list[tuple], k: int = 10) -> list[tuple]:
    counted = [(i, terms(t)) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        wanted = [(t, q, math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))) for t, q in terms(text).items()]
        scored = []
        for i, c in counted:
            m = 25 + (75 * sum(c.values()) * n_docs) // n_terms
            score = sum(q * w * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t, q, w in wanted if c[t])
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def found(spark, docs, items, **how) -> list[tuple]:
    table = spark.createDataFrame([(*r, "x", 1) for r in items], "item_id long, text string, rank string, score int")
    return [tuple(r) for r in search.search(docs, table, **how).select("item_id", "rank", "doc_id", "score").collect()]


ITEMS = [(1, "abc ab a"), (2, None), (3, ""), (4, "?! .,"), (5, "日本語 one TWO two two"), (6, "nowhere-to-be-found"), (7, "a b c d e " * 300),
         (7, "changed"), (7, "changed"), (None, "ÉÉ é x1_x2"), (8, "ab " * 50 + "z" * 200)]


@pytest.mark.parametrize("block_chars", [60, 100_000])
def test_odd_documents(spark, block_chars):
    docs = odd.documents(spark).repartition(5)
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    odd.same(found(spark, docs, ITEMS, block_chars=block_chars), expected(plain, ITEMS))


def test_ties_across_tiles_and_tasks(spark):
    """3,000 documents alike, one better: the smallest ids win; a missing id comes first."""
    docs = spark.range(3_000).select((F.col("id") * 7 % 3_000).alias("doc_id"), F.lit("same words here").alias("text")).unionByName(
        spark.createDataFrame([(None, "same words here"), (9_999, "same same words")], "doc_id long, text string")).repartition(6)
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(1, "same words"), (2, "here")]
    odd.same(found(spark, docs, items, k=5), expected(plain, items, 5))


def test_nothing_to_find(spark):
    assert found(spark, odd.empty(spark), ITEMS) == []
    assert found(spark, odd.documents(spark), []) == []
    assert found(spark, odd.documents(spark), [(1, None), (2, "!")]) == []
    assert found(spark, spark.createDataFrame([(1, None), (2, "-")], "doc_id long, text string"), ITEMS) == []


def test_tiles_keep_sums_exact():
    """Items that repeat a term very often: weights are spread over tiles, and sums stay whole."""
    rng = random.Random(1)
    items = [{t: rng.choice([1, 3, 10 ** 6]) for t in rng.sample(range(50), 20)} for _ in range(300)]
    weights = np.array([rng.randrange(1, 40_000) for _ in range(50)], np.int64)
    tiles = search.item_tiles(items, weights)
    n_docs, postings = 7, [(d, t, rng.randrange(1, 10 ** 6)) for d in range(7) for t in rng.sample(range(50), 30)]
    doc, term, impact = (np.array(x) for x in zip(*postings))
    for t in tiles:
        assert (t.dense().sum(axis=1) * search.MAX_IMPACT < 2 ** 53).all() and len(t.columns) <= search.TILE_TERMS
    total = search.scores(tiles, len(items), n_docs, doc, term, impact)
    want = [[sum(q * int(weights[t]) * i for d, t, i in postings if d == k for q in [item.get(t, 0)]) for k in range(n_docs)] for item in items]
    assert total.tolist() == want


def test_long_texts_are_counted_piece_by_piece(monkeypatch):
    text = "Ab1 é-x " * 5_000 + "q" * 3_000 + " end"
    whole = search.terms_of(text)
    monkeypatch.setattr(search, "PIECE_BYTES", 100)
    assert search.terms_of(text) == whole == Counter({t.encode(): n for t, n in terms(text).items()})


def test_a_text_of_20_mb(spark):
    docs = spark.createDataFrame([(1, "needle in it"), (2, None)], "doc_id long, text string").withColumn(
        "text", F.when(F.col("doc_id") == 2, F.concat(F.repeat(F.lit("hay stack "), 2_000_000), F.lit("needle"))).otherwise(F.col("text")))
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    odd.same(found(spark, docs, [(1, "needle hay")]), expected(plain, [(1, "needle hay")]))
