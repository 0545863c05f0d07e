import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobuse.llm import decontaminate as d

import odd


def edited(rng, text, edits):
    for _ in range(edits):
        k = rng.randrange(len(text))
        text = rng.choice([text[:k] + text[k + 1:], text[:k] + "q" + text[k + 1:], text[:k] + "q" + text[k:]])
    return text


def sentence(rng, n):
    return " ".join("".join(rng.choice("abdefghiklmnoprstu") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def best_edits(passage, text):
    """Fewest edits between a passage and any part of a text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(passage, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def as_codes(text):
    return d.fold([text])[0][:-1]


def test_banded_alignment_is_the_full_one():
    rng = random.Random(3)
    for case in range(150):
        passage = sentence(rng, 8)[:40]
        text = sentence(rng, rng.randrange(4)) + edited(rng, passage, rng.randrange(7)) + sentence(rng, rng.randrange(4))
        p, t = as_codes(passage), as_codes(text)
        want = best_edits(p.tolist(), t.tolist())
        found = d.distance(p, t, -8, len(t), 6)
        assert (found[0] if found else None) == (want if want <= 6 else None), (passage, text)
        if found:
            edits, start, end = found
            assert best_edits(p.tolist(), t[max(start, 0): end].tolist()) == edits


def test_bound_of_the_lemma():
    f = d.Filter()
    for m in range(f.shortest, 400):
        k = f.edits(m)
        assert 0 <= k <= f.budget * m and f.least_shared(m) == m + 1 - f.q * (k + 1) >= 1


def test_no_passage_within_budget_is_missed(spark):
    rng = random.Random(4)
    f = d.Filter(passage=60, q=6, budget=0.08)
    items = [(k, sentence(rng, rng.randrange(9, 30))) for k in range(12)]
    index = d.Index(items, f)
    texts = [sentence(rng, 30) + " " + edited(rng, items[k % 12][1], k % 9) + " " + sentence(rng, rng.randrange(20)) for k in range(90)]
    found = index.matches(texts)
    hits = 0
    for text, spans in zip(texts, found):
        t = as_codes(text).tolist()
        near = {item for passage, item, k in zip(index.passages, index.items, index.edits) if best_edits(passage.tolist(), t) <= k}
        assert near == {s[0] for s in spans}
        hits += len(near)
    assert 40 < hits


def test_finds_disguised_items_and_their_places(spark):
    rng = random.Random(6)
    items = [(k, sentence(rng, 40)) for k in range(5)] + [(7, "too short"), (8, None), (None, sentence(rng, 40))]
    clean = sentence(rng, 80)
    rows = [(1, f"{clean} {items[0][1]} {clean}"), (2, items[1][1].upper().replace(" ", "!!\n** ")), (3, clean), (4, None), (5, ""),
            (6, f"x {edited(rng, items[2][1], 5)} y"), (7, clean + "too short"), (8, " ".join(items[3][1].split()[20:])), (None, f"{items[7][1]}"),
            (1, f"{clean} {items[0][1]} {clean}")]
    docs = spark.createDataFrame([(*r, "found") for r in rows], "doc_id long, text string, found string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = d.contaminated(docs, benchmark).collect()
    assert sorted({(r["doc_id"] or -1, r["item_id"]) for r in found}, key=str) == sorted({(1, 0), (2, 1), (6, 2), (-1, None)} | {
        (8, 3) for r in found if r["doc_id"] == 8}, key=str)
    one = [r for r in found if r["doc_id"] == 1]
    assert len(one) == 2 and rows[0][1][one[0]["start"]: one[0]["end"]] == items[0][1] and one[0]["edits"] == 0
    kept = d.clean(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({3, 4, 5, 7, 8} - {r["doc_id"] for r in found})


@pytest.mark.parametrize("chars", [300, 10_000])
def test_blocks_of_items_find_the_same(spark, chars):
    rng = random.Random(8)
    items = [(k, sentence(rng, 30)) for k in range(8)]
    rows = [(k, sentence(rng, 20) + " " + items[k][1] + " " + items[7 - k][1]) for k in range(8)]
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = d.contaminated(docs, benchmark, d.Filter(block_chars=chars)).select("doc_id", "item_id").collect()
    assert {tuple(r) for r in found} == {(k, x) for k in range(8) for x in (k, 7 - k)}


def test_odd_documents(spark):
    rows = odd.rows()
    benchmark = spark.createDataFrame([(0, " ".join(odd.texts()[34 + 10].split()))], "item_id long, text string")
    docs = odd.documents(spark)
    assert sorted(d.clean(docs, benchmark).columns) == sorted(docs.columns)
    none = spark.createDataFrame([], "item_id long, text string")
    odd.same([tuple(r) for r in d.clean(docs, none).collect()], rows)
    assert d.contaminated(odd.empty(spark), benchmark).collect() == []
    assert np.array_equal(d.fold(["A  b!", "", "ß\U0001F642"])[2], [0, 4, 5, 8]) or d.fold(["A  b!", "", "ß"])[2][0] == 0


def test_excerpts_and_replaced_words_are_found():
    rng = random.Random(9)
    items = [(k, sentence(rng, n)) for k, n in enumerate([17] * 20 + [40] * 20 + [80] * 20)]
    index = d.Index(items, d.Filter())
    texts, want = [], []
    for item, text in items:
        words, half = text.split(), len(text) // 2
        place = rng.randrange(max(1, len(text) - 150))
        replaced = [sentence(rng, 1) if k % 10 == 4 else w for k, w in enumerate(words)]
        for part in (text[:half], text[half:], text[place: place + 150], text[-40:], " ".join(replaced), " ".join(edited(rng, w, 1) if k % 10 == 7 else w for k, w in enumerate(words))):
            if len(part.strip()) >= 38:
                texts.append(f"{sentence(rng, 30)} {part} {sentence(rng, 30)}")
                want.append(item)
    found = index.matches(texts)
    assert [w for w, spans in zip(want, found) if w not in {s[0] for s in spans}] == []
    assert all({s[0] for s in spans} == {w} for w, spans in zip(want, found))


def test_any_excerpt_of_38_characters_is_found():
    rng = random.Random(10)
    text = sentence(rng, 60)
    index = d.Index([(1, text)], d.Filter())
    excerpts = [text[k: k + 38] for k in range(len(text) - 37)]
    assert all(index.matches([f"{sentence(rng, 5)}{x}{sentence(rng, 5)}" for x in excerpts if x.strip() == x]))


def test_short_items_match_exactly_as_whole_words():
    items = [(1, "Why, six?"), (2, "why six"), (3, "!!"), (4, "日本語"), (5, "a"), (6, "one little item, under 32 chars")]
    index = d.Index(items, d.Filter())
    texts = ["so: WHY SIX", "why sixty", "これは日本語です", "a b", "", "x one  little item under 32 chars y", "one little item under 32 char"]
    assert [sorted({s[0] for s in spans}) for spans in index.matches(texts)] == [[1, 2], [], [4], [5], [], [6], []]
    assert index.matches(["so: WHY -- SIX!"])[0][0] == (1, 4, 14, 0)


def test_short_items_are_reported_but_no_reason_to_drop(spark):
    benchmark = spark.createDataFrame([(1, "the"), (2, "What is the capital of the republic of Chad?"), (3, "a")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "the end"), (2, "a b"), (3, "Q: what is the capital of the Republic of Chad? A: N'Djamena"), (4, None)],
                                 "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.contaminated(docs, benchmark).collect()}
    assert found == {(1, 1), (2, 3), (3, 1), (3, 2), (3, 3)}
    assert {r.doc_id for r in d.clean(docs, benchmark).collect()} == {1, 2, 4}
    assert {r.doc_id for r in d.clean(docs, benchmark, least_chars=1).collect()} == {4}


def test_a_long_benchmark_is_read_in_blocks(spark, monkeypatch):
    """Every item of many blocks is found; a worker's batches are held for a round of blocks."""
    rng = random.Random(4)
    items = [(k, sentence(rng, 60)) for k in range(120)]
    docs = [(k, f"{sentence(rng, 20)} {text} {sentence(rng, 20)}") for k, text in items] + [(1000 + k, sentence(rng, 60)) for k in range(50)]
    f = d.Filter(block_chars=2000)
    monkeypatch.setattr(d, "HELD_BYTES", 5000)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    column = d.leaks(frame, benchmark, f)
    found = frame.select("doc_id", F.transform(column, lambda x: x["item_id"]).alias("items"))
    assert {r.doc_id: r["items"] for r in found.collect()} == {k: [k] if k < 1000 else [] for k, _ in docs}
    for df in (found, d.contaminated(frame, benchmark, f), d.clean(frame, benchmark, f)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_parts_of_a_slice_find_the_same(monkeypatch):
    rng = random.Random(11)
    items = [(k, sentence(rng, 30)) for k in range(6)]
    index = d.Index(items, d.Filter())
    texts = [sentence(rng, 20) + " " + edited(rng, items[k % 6][1], k) + " " + items[5 - k % 6][1] for k in range(30)]
    whole = index.matches(texts)
    monkeypatch.setattr(d, "ENTRIES", 100)
    monkeypatch.setattr(d, "ALIGNED", 3)
    assert index.matches(texts) == whole and all(whole)
