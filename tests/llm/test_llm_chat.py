import random

import pytest
from pyspark.sql import functions as F

import odd
from jobuse.llm import chat

SCHEMA = "conv_id long, turn int, role string, text string, pieces int, turns string, `text.x` int"
TRICKY = ["", "<|im_end|>", "<|im_end|>\n", "<|im_start|>assistant\nhi", "<|im_sep|>", "<\\|im_end|>", "<\\\\|", "<", "|", "a<", "\\", "\\|x", "$1 <|", None,
          "<|im_sep|><|im_sep|>", "\n", " x ", "é🙂<|é", "<<||>>", "<\\<|\\|"]


def rows() -> list[tuple]:
    rng = random.Random(3)
    out = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "system", None, "a|b\n<|im_end|>%41+ \\n"])
            out.append((conv, rng.choice([turn, 1, None]), role, " ".join(t or "" for t in rng.choices(TRICKY, k=2)) if rng.random() < 0.5 else rng.choice(TRICKY)))
    out += [out[0], out[0]]
    return [(*r, 1, "x", 2) for r in out]


def conversations(given: list[tuple]) -> dict:
    by = {}
    for conv, turn, role, text, *_ in given:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for *_, r, t in sorted(v, key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))] for c, v in by.items()}


def plain(turns: list[tuple[str, str]]) -> str:
    """The template by hand, block by block."""
    import re
    from urllib.parse import quote_plus
    out, last = "", None
    for k, (role, text) in enumerate(turns):
        body = re.sub(r"<(\\*)\|", lambda m: "<" + m[1] + "\\|", text)
        out += f"<|im_sep|>{body}" if k and role == last else f"{'<|im_end|>' + chr(10) if k else ''}<|im_start|>{quote_plus(role, safe='*')}\n{body}"
        last = role
    return out + "<|im_end|>\n"


def read(spark, given):
    made = chat.format_chats(spark.createDataFrame(given, SCHEMA))
    return made.select("conv_id", "pieces", chat.text_of(F.col("pieces")).alias("text"), chat.loss_text(F.col("pieces")).alias("loss")).withColumn(
        "turns", chat.read_turns(F.col("text"))).collect()


def test_round_trip_of_odd_turns(spark):
    given = rows()
    want = conversations(given)
    found = read(spark, given)
    assert len(found) == len(want)
    for r in found:
        turns = want[r["conv_id"]]
        assert r["text"] == plain(turns)
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")
        for piece, (role, _) in zip(r["pieces"], turns, strict=True):
            assert (piece["loss_length"] > 0) <= (role == "assistant")
            assert "<|" not in piece["text"][piece["loss_start"]: piece["loss_start"] + piece["loss_length"]]


@pytest.mark.parametrize("n", [1, 3_000])
def test_long_conversations(spark, n):
    """One block of many turns, and many blocks; a text of 20 MB."""
    given = [(1, k, "assistant", f"t{k}", None, None, None) for k in range(n)] + [(2, k, "ab"[k % 2], f"<|{k}", None, None, None) for k in range(n)]
    want = conversations(given)
    for r in read(spark, given):
        assert [tuple(t) for t in r["turns"]] == want[r["conv_id"]] and r["text"] == plain(want[r["conv_id"]])
    long = spark.range(1).select(F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("assistant").alias("role"),
                                 F.repeat(F.lit("ab <|im_end|>"), 1_600_000).alias("text"))
    made = chat.format_chats(long).select(F.sha2(chat.loss_text(F.col("pieces")).cast("binary"), 256).alias("h"))
    assert made.first()["h"] == long.select(F.sha2(F.col("text").cast("binary"), 256)).first()[0]


def test_empty_table(spark):
    assert read(spark, []) == []


def test_no_python_in_the_plan(spark):
    made = chat.format_chats(spark.range(3).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("x").alias("text")))
    plan = made.select(chat.loss_text(F.col("pieces")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") <= 1


def test_odd_documents_as_turns(spark):
    docs = odd.documents(spark).select((F.col("doc_id") % 4).alias("conv_id"), F.col("doc_id").alias("turn"), F.lit("assistant").alias("role"), "text", "ids")
    for r in chat.format_chats(docs).select("conv_id", F.size("pieces").alias("n"), F.length(chat.loss_text(F.col("pieces"))).alias("chars")).collect():
        own = docs.where(F.col("conv_id").eqNullSafe(F.lit(r["conv_id"])))
        assert (r["n"], r["chars"]) == tuple(own.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first())
