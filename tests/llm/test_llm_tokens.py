import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.orc
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

from jobuse.llm import bpe, flat_tokens, orc_tokens, queries
from jobuse.llm.common import scratch
from jobuse.llm.pieces import Known, encode_array, text_slices

import odd


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(queries.RANKS)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={p: k for k, p in enumerate(ranks)}, special_tokens={})


def test_every_piece_is_its_own_id(ranks):
    codec = bpe.Codec(bpe.serialise(ranks), public_tokenizers.PATTERN)
    chars = ["".join(chr(bpe.FIRST_CHAR + b) for b in p) for p in ranks]
    assert codec.processor.encode(chars) == [[k] for k in range(len(ranks))]


def test_serialises_a_small_vocabulary():
    pieces = [b"a", b"b", b"ab", b"abab", b"\x00", b"\xff"]
    codec = bpe.Codec(bpe.serialise(pieces), r"[\s\S]+")
    assert codec.encode_new(["ababab", "ba", "aab"]) == [[3, 2], [1, 0], [0, 2]]


def test_encodes_as_the_rank_file_says(spark, ranks, reference):
    docs = odd.documents(spark)
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    assert encoded.columns == docs.columns              # ids was there, and is replaced
    found = bpe.decode(encoded, ranks).select("doc_id", "ids", "decoded").collect()
    odd.same([(r[0], r[1], bytes(r[2])) for r in found], [(r[0], reference.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in odd.rows()])


def test_query_digests(spark, ranks, reference, tmp_path):
    odd.documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    def digest(text):
        ids = reference.encode_ordinary(text or "")
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()
    found = queries.op2_byte_bpe(spark, str(tmp_path)).collect()
    odd.same([tuple(r) for r in found], [(r[0], *digest(r[1])) for r in odd.rows()])


def test_known_pieces_start_anew_and_slices_are_bounded(ranks, reference, monkeypatch):
    monkeypatch.setattr(Known, "LIMIT", 50)
    codec = bpe.Codec(bpe.serialise(ranks), public_tokenizers.PATTERN)
    texts = [t or "" for t in odd.texts()]
    for _ in range(2):
        for part in text_slices(pa.array(texts), 3_000):
            assert encode_array(part, codec).to_pylist() == [reference.encode_ordinary(t) for t in part.to_pylist()]
    assert sum(len(p) for p in text_slices(pa.array(texts), 3_000)) == len(texts)


def test_orc_files(spark, tmp_path):
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    path = str(tmp_path / "tokens")
    orc_tokens.write(odd.documents(spark), path, queries.TOKENIZER, public_tokenizers.PATTERN, end_id=0, row_stride=1000)
    found = orc_tokens.positions(spark, path).orderBy("start").collect()
    expected = {}
    for r in odd.rows():
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0]
        expected.setdefault(r[0], []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [r["doc_id"] for r in found] == sorted((r[0] for r in odd.rows()), key=lambda x: (x is not None, x))
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    odd.same([(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found], [(d, *x) for d, many in expected.items() for x in many])
    looked_up = orc_tokens.read(spark, path, [4, 10])
    assert sorted(r["doc_id"] for r in looked_up.collect()) == [4, 10]
    assert "PushedFilters: [In(doc_id" in looked_up._jdf.queryExecution().toString()
    files = sorted((tmp_path / "tokens").glob("part-*.orc"))
    assert sum(pyarrow.orc.ORCFile(str(f)).nrows for f in files) == len(odd.rows())
    assert any(b"doc_id" in f.read_bytes() and pyarrow.orc.ORCFile(str(f)).nstripes >= 1 for f in files)


@pytest.mark.parametrize("block", [500, 1 << 20])
def test_flat_files(spark, ranks, reference, block):
    folder = scratch(spark, "flat")
    ledger = flat_tokens.write(odd.documents(spark).repartition(3), folder, ranks, public_tokenizers.PATTERN, queries.END_OF_TEXT)
    counts = flat_tokens.count_tokens(spark, folder, "<u2", queries.END_OF_TEXT, block)
    found = ledger.join(counts, ["file", "ord"], "full").select("doc_id", "n_tokens").collect()
    odd.same([tuple(r) for r in found], [(r[0], len(reference.encode_ordinary(r[1] or "")) + 1) for r in odd.rows()])


@pytest.mark.parametrize("block", [1, 2, 3, 5, 100])
def test_documents_across_blocks(spark, tmp_path, block):
    streams = {"a.bin": [9, 5, 5, 5, 5, 5, 9, 9, 5], "b.bin": [], "c.bin": [5, 5, 5], "d.bin": [9], "e.bin": [5, 9, 5, 5, 9]}
    for name, ids in streams.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u4").tobytes())
    expected = [("a.bin", 0, 1), ("a.bin", 1, 6), ("a.bin", 2, 1), ("a.bin", 3, 1), ("c.bin", 0, 3), ("d.bin", 0, 1), ("e.bin", 0, 2), ("e.bin", 1, 3)]
    found = flat_tokens.count_tokens(spark, f"file://{tmp_path}", "<u4", 9, block).collect()
    assert sorted(map(tuple, found)) == expected


def test_counts_of_the_query(spark, reference, tmp_path):
    odd.documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op6_token_counts(spark, str(tmp_path)).collect()
    odd.same([tuple(r) for r in found], [(r[0], len(reference.encode_ordinary(r[1] or ""))) for r in odd.rows()])


def test_no_window_carries_the_lengths_of_a_file(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(np.array([1, 9] * 50, "<u2").tobytes())
    plan = flat_tokens.count_tokens(spark, f"file://{tmp_path}", "<u2", 9, 10)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window " in line]
    below = [line for line in plan[plan.index(windows[0]):].splitlines() if "Relation" not in line]
    assert windows and not any("lengths" in line for line in below)


def test_files_are_bounded_and_rows_alike_are_split(spark, tmp_path):
    """A third of all rows alike in id and text: files, ranges and parts stay small, and starts are right."""
    docs = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
                                   F.when(F.col("id") % 3 == 0, F.lit("the same text")).otherwise(F.concat(F.lit("text of "), "id")).alias("text"))
    path = str(tmp_path / "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        orc_tokens.write(docs, path, queries.TOKENIZER, public_tokenizers.PATTERN, file_rows=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = orc_tokens.read(spark, path).withColumn("file", F.input_file_name())
    assert max(r["count"] for r in rows.groupBy("file").count().collect()) <= 100
    assert rows.where("doc_id = 7").select(F.shiftright("seq", 33)).distinct().count() > 1
    whole = rows.orderBy("seq").collect()
    assert [r["doc_id"] for r in whole] == sorted(r["doc_id"] for r in whole) and len(whole) == 900
    expected, start = [], 0
    for r in whole:
        expected.append((r["doc_id"], start, r["n_tokens"], zlib.crc32(np.array(r["tokens"], "<u4").tobytes())))
        start += r["n_tokens"]
    for part_rows in (1, 7, 100_000):
        assert sorted(map(tuple, orc_tokens.positions(spark, path, part_rows).collect())) == sorted(expected)


def test_looking_for_documents_pushes_ids_to_the_files(spark, tmp_path):
    docs = spark.range(4_000).select((F.col("id") * 2).alias("doc_id"), F.lit("a b").alias("text"))
    path = str(tmp_path / "tokens")
    orc_tokens.write(docs, path, queries.TOKENIZER, public_tokenizers.PATTERN, row_stride=1_000, file_rows=2_000)
    assert [r["doc_id"] for r in orc_tokens.read(spark, path, [2_000, 2_001, 7_998]).orderBy("doc_id").collect()] == [2_000, 7_998]
    plan = orc_tokens.read(spark, path, [2_000])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,2000)]" in plan


def test_empty_tables(spark, ranks, tmp_path):
    docs = odd.empty(spark)
    assert bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks).collect() == []
    path = str(tmp_path / "tokens")
    orc_tokens.write(docs, path, queries.TOKENIZER, public_tokenizers.PATTERN)
    assert orc_tokens.positions(spark, path).collect() == []
    folder = scratch(spark, "flat")
    ledger = flat_tokens.write(docs, folder, ranks, public_tokenizers.PATTERN, queries.END_OF_TEXT)
    assert ledger.join(flat_tokens.count_tokens(spark, folder, "<u2", queries.END_OF_TEXT), ["file", "ord"], "full").collect() == []


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "word<|endoftext|>word  ", "  <|endoftext|><|endoftext|>\n\n<|endoftext|> x", "<|endoftext", "é <|endoftext|>é",
         "no token", "", None, "<|endoftext|> don't  <|endoftext|>\t"]


def test_added_tokens_are_those_of_the_library(spark, tmp_path):
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    path = str(tmp_path / "tokens")
    docs = spark.createDataFrame([*enumerate(ADDED)], "doc_id long, text string").coalesce(1)
    orc_tokens.write(docs, path, queries.TOKENIZER, public_tokenizers.PATTERN, end_id=0)
    expected = [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in ADDED]
    assert 50256 in expected[0]
    assert [r["tokens"] for r in orc_tokens.read(spark, path).orderBy("doc_id").collect()] == expected
    found = orc_tokens.positions(spark, path).orderBy("doc_id").select("start", "n_tokens", "ids_crc32").collect()
    assert [tuple(r) for r in found] == [(sum(map(len, expected[:k])), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in enumerate(expected)]


@pytest.mark.parametrize("more", [[], ["<|endoftext|>x", "don"], [AddedToken("<mask>", lstrip=True), AddedToken("one", single_word=True)]])
def test_other_added_tokens(more):
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    tokenizer.add_tokens([AddedToken(t, normalized=False) if isinstance(t, str) else t for t in more])
    encoder = orc_tokens.Encoder(tokenizer.to_str(), public_tokenizers.PATTERN)
    texts = [*(t or "" for t in ADDED), "a<|endoftext|>x <mask> one someone  <mask>"]
    ids, ends = encoder.encode_texts(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_round_trip_is_encode_and_decode_with_digests(spark, ranks):
    docs = odd.documents(spark)
    want = bpe.decode(bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN), ranks)
    expected = [(r["doc_id"], r["ids"], hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest(),
                 hashlib.sha256(bytes(r["decoded"])).hexdigest()) for r in want.collect()]
    found = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    assert found.columns == [c for c in docs.columns if c != "ids"] + ["ids", "ids_sha256", "decoded_sha256"]
    odd.same([tuple(r) for r in found.select("doc_id", "ids", "ids_sha256", "decoded_sha256").collect()], expected)
    assert bpe.round_trip(odd.empty(spark), ranks, public_tokenizers.PATTERN).collect() == []


def test_long_texts_are_encoded_in_parts(ranks, monkeypatch):
    codec = bpe.Codec(bpe.serialise(ranks), public_tokenizers.PATTERN)
    texts = pa.array(["It's a  long\n\n text, 123 4５6 🙂 words' " * 300, None, "", "x" * 5_000, " lead and trail ", "a b" * 2_000])
    flat, sizes = bpe._inverse(bpe.serialise(ranks))
    whole = bpe._tripped(texts, codec, flat, sizes)
    codec.slice_bytes = 64
    assert len(bpe._parts(pc.fill_null(texts.cast(pa.large_string()), ""), 64)[0]) > 100
    assert bpe._tripped(texts, codec, flat, sizes).equals(whole)


def test_a_text_of_20_mb(spark, ranks):
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("Some words, 12 of them. "), 833_333).alias("text"))
    r = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).select("decoded_sha256", F.sha2(F.col("text").cast("binary"), 256)).first()
    assert r[0] == r[1]
