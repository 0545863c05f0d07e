import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from jobuse.llm import components, queries, simhash, substring_dedup, words
from jobuse.llm.common import row_key

import odd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected_removal(rows, window):
    split = [(r[0], WORD.findall(r[1] or "")) for r in rows]
    count = collections.Counter(tuple(w[k: k + window]) for _, w in split for k in range(len(w) - window + 1))
    out = []
    for ident, w in split:
        left = [True] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k: k + window])] > 1:
                left[k: k + window] = [False] * window
        out.append((ident, len(w), len(w) - sum(left), " ".join(x for x, y in zip(w, left) if y)))
    return out


@pytest.mark.parametrize("window", [1, 3, 8, 9, 35])
def test_removes_repeated_windows(spark, window):
    rows = odd.rows()
    found = substring_dedup.deduplicate(odd.documents(spark), window).select("doc_id", "n_words", "n_removed", "kept").collect()
    odd.same([tuple(r) for r in found], expected_removal(rows, window))


def test_repeats_on_few_words(spark):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for k in range(60)]
    found = substring_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), 12)
    odd.same([tuple(r)[:4] for r in found.collect()], expected_removal(rows, 12))


def test_many_rows_alike_beside_near_copies(spark):
    """Rows alike in id and text are one key; near copies open all of its segments."""
    rng = random.Random(6)
    text = [f"w{rng.randrange(10 ** 6)}" for _ in range(300)]
    near = [(k, " ".join(w if j != 100 * k else "other" for j, w in enumerate(text))) for k in (1, 2)]
    rows = [(None, " ".join(text))] * 5000 + [(7, " ".join(text))] * 3 + near
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = substring_dedup.deduplicate(docs, 35).select("doc_id", "n_words", "n_removed", "kept")
    odd.same([tuple(r) for r in found.collect()], expected_removal(rows, 35))
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", "text")
    windows = substring_dedup.repeated_windows(keyed, substring_dedup.packed(keyed), 35)
    assert windows.groupBy("key").agg(F.collect_set(F.struct("at", "size", "source")).alias("w")).agg(F.max(F.size("w"))).first()[0] < 300


def test_factors_are_copies_of_their_sources(spark):
    rows = odd.rows()
    found = substring_dedup.deduplicate(odd.documents(spark), 20).select("doc_id", "factors").collect()
    keyed = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    text = {r[0]: WORD.findall(r[1] or "") for r in keyed.select(row_key(F.col("doc_id"), F.col("text")), "text").collect()}
    split = collections.defaultdict(list)
    for r in rows:
        split[r[0]].append(WORD.findall(r[1] or ""))
    n = 0
    for ident, factors in found:
        for f in factors:
            if f["source"] is not None:
                copy = text[f["source"]][f["source_start"]: f["source_start"] + f["end"] - f["start"]]
                assert any(w[f["start"]: f["end"]] == copy for w in split[ident])
                n += 1
    assert n > 5


def test_word_hashes_agree_with_words():
    texts = [t for t in odd.texts() if t is not None] * 2
    array = pa.array(["skipped", *texts], pa.large_string()).slice(1)
    hashes, counts = words.word_hashes(array)
    split = [WORD.findall(t) for t in texts]
    assert counts.tolist() == [len(w) for w in split]
    flat = [w for ws in split for w in ws]
    assert len(set(hashes.tolist())) == len(set(flat)) == len(set(zip(hashes.tolist(), flat)))
    sums = words.Sums(hashes, words.WORD_STEP)
    at = np.arange(len(hashes) - 2)
    runs = sums.runs(at, at + 3).tolist()
    assert len(set(runs)) == len(set(zip(flat, flat[1:], flat[2:])))
    assert words.sliding_min(np.array([5, 3, 4, 1, 2]), 3).tolist() == [3, 1, 1]
    assert words.sliding_min(np.array([5, 3]), 1).tolist() == [5, 3]


def expected_components(rows, bits, shingle=3):
    prints = []
    for r in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        s = [" ".join(w[k: k + shingle]) for k in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        prints.append(sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)))
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= bits:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    first = {g: min((r[0] for r, x in zip(rows, group) if x == g and r[0] is not None), default=None) for g in set(group)}
    return [(r[0], p, first[g]) for r, p, g in zip(rows, prints, group)], group


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_components_of_fingerprints(spark, bits):
    rows = odd.rows()
    base = rows[10][1].split()
    rows += [(5000 + k, " ".join([*base[:k], "other", *base[k + 1:]]), *[None] * 8) for k in range(0, min(len(base), 40), 2)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, odd.SCHEMA), max_bits=bits).collect()
    expected, group = expected_components(rows, bits)
    odd.same([(a, b % (1 << 64), c) for a, b, c in found], expected)
    assert len(set(group)) < len(rows)


def test_links_of_planted_fingerprints(spark):
    rng = random.Random(2)
    values = [rng.getrandbits(64) for _ in range(150)]
    for v in values[:60]:
        a = v ^ 1 << rng.randrange(64)
        values += [a, a ^ 1 << rng.randrange(64), a ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64), v ^ 7]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed * 2], "fingerprint long")
    for bits in (0, 1, 2, 3, 4):
        found = {tuple(r) for r in simhash.close_pairs(prints, bits).collect()}
        assert found == {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) % (1 << 64)).count("1") <= bits}


def test_one_row_of_each_group_stays(spark):
    docs = odd.documents(spark)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    rows = [tuple(r) for r in kept.collect()]
    expected, group = expected_components(odd.rows(), 2)
    assert len(rows) == len(set(group))
    assert sorted((r[0] for r in rows), key=str) == sorted({c for _, _, c in expected}, key=str)
    assert set(rows) <= set(odd.rows())


def test_chains_are_one_component(spark):
    n = 70
    links = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(k + 1, k) for k in range(5)] + [(200, 201)], "a long, b long")
    found = dict(map(tuple, components.components(links).collect()))
    assert found == {**{k: 0 for k in range(n + 1)}, 200: 200, 201: 200}


def test_empty_and_query(spark, tmp_path):
    assert substring_dedup.deduplicate(odd.empty(spark)).collect() == []
    assert simhash.near_duplicates(odd.empty(spark)).collect() == []
    assert simhash.representatives(odd.empty(spark)).collect() == []
    odd.documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op3_substring_dedup(spark, str(tmp_path)).collect()
    odd.same([tuple(r) for r in found], [(a, b, c, hashlib.sha256(d.encode()).hexdigest()) for a, b, c, d in expected_removal(odd.rows(), 35)])
    found = queries.op5_simhash(spark, str(tmp_path)).collect()
    odd.same([tuple(r) for r in found], [(a, f"{b:016x}", c) for a, b, c in expected_components(odd.rows(), 2)[0]])
