import collections
import math
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from jobuse.llm import queries, sharding
from jobuse.llm.sharding import Tree

import odd

TREE = Tree.even(regions=5, racks=2, shards=4)


def placed(spark, tree, n=4000):
    return dict(map(tuple, spark.range(n).select("id", sharding.shard_of(F.col("id"), tree)).collect()))


def chained(seed, data):
    return xxhash.xxh64_intdigest(data, seed)


def restated(ident, tree):
    """The descent, number by number."""
    key = 42 if ident is None else chained(42, ident.to_bytes(8, "little", signed=True))

    def weight(node):
        return node[1] if isinstance(node[0], int) else sum(map(weight, node))

    name, node = "root", tree.regions
    while not isinstance(node[0], int):
        draws = []
        for k, child in enumerate(node):
            label = f"{name}/{child[0] if isinstance(child[0], int) else k}"
            unit = ((chained(key, label.encode()) >> 11) + 1) / 2 ** 53
            draws.append((-math.log(unit) / weight(child), label, child))
        _, name, node = min(draws, key=lambda d: d[:2])
    return node[0]


def test_descends_by_weighted_draws(spark):
    for tree in (TREE, TREE.grown(), TREE.reweighted(7, 3.0)):
        found = placed(spark, tree, 300)
        assert found == {k: restated(k, tree) for k in range(300)}


def test_shares_follow_weights(spark):
    count = collections.Counter(placed(spark, TREE.reweighted(0, 5.0), 20_000).values())
    share = 20_000 / 44
    assert sorted(count) == list(range(40)) and abs(count[0] - 5 * share) < 250
    assert all(abs(n - share) < 6 * share ** 0.5 for s, n in count.items() if s)


def test_a_new_shard_takes_rows_only_into_itself(spark):
    tree, before = TREE, placed(spark, TREE)
    for new in (40, 41, 42):
        tree = tree.grown()
        after = placed(spark, tree)
        moved = {k for k in before if before[k] != after[k]}
        assert {after[k] for k in moved} == {new} and 0 < len(moved) < 4000 / 40 * 1.6
        before = after


def test_movement_stays_in_the_subtree_that_changed(spark):
    before, after = placed(spark, TREE), placed(spark, TREE.reweighted(9, 4.0))     # region 1, rack 0: shards 8 to 11
    assert {after[k] for k in before if before[k] != after[k]} <= set(range(8, 16))
    lighter = placed(spark, TREE.reweighted(9, 0.25))
    assert {before[k] for k in before if before[k] != lighter[k]} <= set(range(8, 16))


def test_rows_and_slots(spark, tmp_path):
    rows = odd.rows()
    odd.documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op7_hash_tree(spark, str(tmp_path)).collect()
    def size(text):
        data = (text or "").encode()
        return len(data) + 16, zlib.crc32(data)
    odd.same([(r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in found],
             [(r[0], *size(r[1]), "key", restated(r[0], TREE), restated(r[0], TREE.grown())) for r in rows])
    slots = collections.defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_many_buckets_leave_no_gap(spark, monkeypatch):
    docs = spark.range(3000).select((F.col("id") % 700).alias("doc_id"), F.lit("x").alias("text"))
    for buckets in (1, 7, 1024):
        monkeypatch.setattr(sharding, "SLOT_BUCKETS", buckets)
        found = sharding.place(docs, TREE).groupBy("shard").agg(F.min("slot"), F.max("slot"), F.count_distinct("slot"), F.count("*")).collect()
        assert all(r[1] == 0 and r[2] + 1 == r[3] == r[4] for r in found)


def test_empty(spark):
    assert sharding.place(odd.empty(spark), TREE).collect() == []
    with pytest.raises(ValueError):
        Tree(()).grown()
