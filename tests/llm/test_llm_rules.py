import collections
import random
import re

from pyspark.sql import functions as F

from jobuse.llm import queries, rules

import odd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def restated(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    repeated = {k + j for k in range(len(w) - 2) if windows[tuple(w[k: k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def failed(n_words, n_repeat_words):
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


MORE = ["a b c a b c a", "x y\nx y\n \nx y", "p q r " * 30, "# $ %\n|<>|\n# $ %", "the cat sat on the cat sat on", "a a a", "a a a a", "a a"]


def labelled(spark, n=300, seed=1):
    """Good and bad documents that two statistics tell apart."""
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        w = odd.words(rng, rng.randrange(60, 120), 3000)
        kind = k % 5
        if kind == 0:
            w = [x + "***" for x in w]
        if kind == 1:
            w = [x.upper().replace("É", "E") for x in w]
        rows.append((k, " ".join(w)))
        labels.append((k, 0 if kind < 2 else 1, 0))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_statistics(spark):
    texts = [*odd.texts(), *MORE]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    found = docs.select("k", rules.statistics(F.col("text")).alias("s")).collect()
    assert {r["k"]: tuple(r["s"][c] for c in rules.BASE) for r in found} == {k: restated(t) for k, t in enumerate(texts)}


def test_learns_what_tells_them_apart(spark):
    docs, labels = labelled(spark)
    learned = rules.Learner().learn(docs, labels)
    assert learned and {c.measure for r in learned for c in r} <= set(rules.MEASURES)
    fresh, truth = labelled(spark, seed=2)
    found = {r["doc_id"]: r["kept"] for r in rules.judge(fresh, labels).collect()}
    fitted = fresh.select("doc_id", rules.verdict(learned, rules.statistics(F.col("text"))).alias("kept"))
    right = sum(r["kept"] == bool(q) for r, q in ((r, r["doc_id"] % 5 >= 2) for r in fitted.collect()))
    assert right >= 295 and len(found) == 300
    assert all(" > " in str(c) or " <= " in str(c) for r in learned for c in r)


def test_a_list_is_an_ordered_conditional(spark):
    one, two = rules.Condition("words", True, 100.0), rules.Condition("symbols_per_word", False, 0.5)
    docs = spark.createDataFrame([(1, "a " * 101), (2, "# " * 101), (3, "a"), (4, None)], "doc_id long, text string")
    def kept(list_):
        return {r[0]: r[1] for r in docs.select("doc_id", rules.verdict(list_, rules.statistics(F.col("text")))).collect()}
    assert kept([]) == {1: True, 2: True, 3: True, 4: True}
    assert kept([(one, two)]) == {1: False, 2: True, 3: True, 4: True}
    assert kept([(one, two), (rules.Condition("words", False, 0.0),)]) == {1: False, 2: True, 3: True, 4: False}


def test_unlearnable_labels_give_no_rules(spark):
    docs, labels = labelled(spark, 60)
    for odd_labels in (labels.limit(0), labels.withColumn("quality", F.lit(1)), labels.withColumn("quality", F.lit(None).cast("int")),
                       labels.withColumn("doc_id", F.col("doc_id") + 10_000)):
        assert rules.Learner().learn(docs, odd_labels) == []
    rng = random.Random(3)
    noise = spark.createDataFrame([(k, rng.randrange(2)) for k in range(60)], "doc_id long, quality int")
    assert len(rules.Learner(min_precision=0.99).learn(docs, noise)) <= 2


def test_odd_documents_and_query(spark, tmp_path):
    rows = odd.rows()
    docs = odd.documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = rules.judge(docs, none).collect()
    odd.same([tuple(r) for r in found], [(r[0], *(s := restated(r[1])), failed(s[0], s[4]), not failed(s[0], s[4])) for r in rows])
    kept = rules.accepted(docs, none)
    assert kept.columns == docs.columns
    odd.same([tuple(r) for r in kept.collect()], [r for r in rows if not failed(restated(r[1])[0], restated(r[1])[4])])
    assert rules.judge(odd.empty(spark), none).collect() == []
    plain, labels = labelled(spark, 100)
    plain.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    result = queries.op8_decision_list(spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert all(not r["kept"] for r in result.collect() if r["base_failed"]) and "Python" not in result._jdf.queryExecution().toString()
