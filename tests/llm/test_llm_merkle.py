import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import odd
from jobuse.llm import merkle
from jobuse.llm.queries import QUERIES

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values) -> str:
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves: list[str]) -> list[list[str]]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k: k + 3]) for k in range(0, len(levels[-1]), 3)])
    return levels


def climb(levels: list[list[str]], at: int, digest: str) -> tuple[str, list[str]]:
    siblings = []
    for nodes in levels[:-1]:
        first = at - at % 3
        left, right = nodes[first:at], nodes[at + 1: first + 3]
        siblings += left + right
        digest, at = H(*left, digest, *right), at // 3
    return digest, siblings


def expected(rows: list[dict], changed) -> list[tuple]:
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r, leaf([r[c] for c in COLUMNS])))
    trees = {}
    for source, entries in groups.items():
        entries.sort(key=lambda e: (e[0]["doc_id"] is not None, e[0]["doc_id"] or 0, e[1]))
        trees[source] = tree([d for _, d in entries])
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for source, entries in groups.items():
        for at, (r, digest) in enumerate(entries):
            other = leaf([{**r, "text": changed(r)}[c] for c in COLUMNS])
            sub, low = climb(trees[source], at, other)
            folded, high = climb(top, order.index(source), sub)
            out.append((r["doc_id"], source, at, digest, trees[source][-1][0], top[-1][0], "".join(low + high), folded))
    return out


def found(df) -> list[tuple]:
    rows = df.select("doc_id", "source", "pos", *[F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "proof", "folded")]).collect()
    return [tuple(r) for r in rows]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_odd_documents_over_many_passes(spark, levels):
    docs = odd.documents(spark).withColumn("source", F.when(F.col("doc_id") % 5 == 0, "b").when(F.col("doc_id") % 5 < 3, "é"))
    changed = F.regexp_replace("text", "e", "")
    rows = [r.asDict() for r in docs.collect()]
    want = expected(rows, lambda r: None if r["text"] is None else r["text"].replace("e", ""))
    odd.same(found(merkle.manifest(docs, COLUMNS, {"text": changed}, levels=levels)), want)
    assert any(a[5] != a[7] for a in want) and any(a[5] == a[7] for a in want)


def test_one_row_many_sources_and_no_rows(spark):
    docs = odd.documents(spark)
    one = docs.limit(1)
    odd.same(found(merkle.manifest(one, COLUMNS)), expected([r.asDict() for r in one.collect()], lambda r: r["text"]))
    each = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), "id").alias("source"), F.lit("x").alias("lang"),
                                  F.lit(1).alias("n_chars"), F.lit("a\nb").alias("text"))
    odd.same(found(merkle.manifest(each, COLUMNS, levels=1)), expected([r.asDict() for r in each.collect()], lambda r: r["text"]))
    assert found(merkle.manifest(odd.empty(spark), COLUMNS)) == []


def test_hot_source_of_rows_alike(spark):
    """5,000 rows alike in all columns, without an id."""
    rows = spark.range(5_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("hot").alias("source"), F.lit(None).cast("string").alias("lang"),
                                     F.lit(3).alias("n_chars"), F.lit("x y").alias("text"))
    got = merkle.manifest(rows, COLUMNS, levels=4)
    odd.same(found(got), expected([r.asDict() for r in rows.collect()], lambda r: r["text"]))


def test_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "s", None, 5, None), (2, "s", "en", None, None)], "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.withColumn("text", F.when(F.col("doc_id") == 1, F.repeat(F.lit("word\n"), 4_000_000)))
    odd.same(found(merkle.manifest(docs, COLUMNS)), expected([r.asDict() for r in docs.collect()], lambda r: r["text"]))


def test_folding_hashes_nothing_to_the_left(monkeypatch):
    """Only the new digest and right siblings are fed to a resumed state."""
    subtree = merkle.Subtree([H(str(k)).encode() for k in range(9)], 2)
    fed = []

    class Kept:
        def __init__(self, state):
            self.state = state

        def copy(self):
            return Kept(self.state.copy())

        def update(self, data):
            fed.append(len(data))
            self.state.update(data)

        def hexdigest(self):
            return self.state.hexdigest()

    subtree.states = [[Kept(s) for s in level] for level in subtree.states]
    digest = subtree.fold(5, H("new").encode(), subtree.siblings(5))
    leaves = [H(str(k)) for k in range(9)]
    leaves[5] = H("new")
    assert digest.decode() == tree(leaves)[-1][0] and fed == [64, 128]


def test_query(spark):
    rows = QUERIES["op11_merkle_midstates"](spark, "/root/testdata/sf0.001").collect()
    assert len({r["root"] for r in rows}) == 1 and len(rows) == len({r["doc_id"] for r in rows})
    assert {r["verified"] for r in rows} == {True, False}
    assert all(r["verified"] == (r["root"] == r["folded_root"]) for r in rows)
