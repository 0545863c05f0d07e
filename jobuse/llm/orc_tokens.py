"""Token ids of documents as ORC files, in ascending document order.

Each file holds a range of documents, sorted; Spark's ORC writer cuts it into
stripes with run-length encoded integers, a row index every ``row_stride`` rows
and Bloom filters on document ids. Readers take stripes in parallel, read only
the columns they need, and skip stripes and row groups by the indexes when they
look for documents.

Texts are encoded as the tokenizers library encodes them without special tokens
added: a text that spells an added token has that token's id there.

A file holds a bounded number of rows. Null and empty texts have the end id alone.
Rows are ordered by id (null first),
then by a hash of the text, then as they are read, so a range may end within rows that
are alike, however many; repeated rows each keep a place of their own. Other
columns are not written. An empty table gives files without rows.
"""

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zlib
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from tokenizers import Tokenizer

from jobuse.llm.common import small_batches, worker_state
from jobuse.llm.pieces import Known, encode_array, flat_lists
from jobuse.session import cut

SCHEMA = "seq long, doc_id long, n_tokens int, tokens array<int>"


def byte_alphabet() -> dict[int, int]:
    """Fixed values of byte-level vocabularies: printable bytes stand for themselves, the rest follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: 0x100 + k for k, b in enumerate(b for b in range(256) if b not in printable)}


class Encoder:
    """A loaded tokenizer; lives in a Python worker."""

    def __init__(self, definition: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.find_all = regex.compile(pattern).findall
        self.alphabet = byte_alphabet()
        # This library takes longer for a new piece, so more memory goes into knowing pieces.
        self.known, self.slice_bytes = Known(1_500_000), 4 << 20
        added = {k: t for k, t in self.tokenizer.get_added_tokens_decoder().items() if t.content}
        self.added = {t.content: k for k, t in added.items()}
        self.any_added = "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))     # the longest one counts
        self.split_added = regex.compile(f"({self.any_added})").split
        # Other tokens than these take in white space, or depend on what is around them.
        self.literal = (self.tokenizer.normalizer is None and len({t.normalized for t in added.values()}) < 2
                        and not any(t.single_word or t.lstrip or t.rstrip for t in added.values()))

    def encode_new(self, tokens: list[str]) -> list[list[int]]:
        encode, space = self.tokenizer.model.tokenize, chr(self.alphabet[0x20])
        plain = (t.replace(" ", space) if t.isascii() and t.isprintable() else t.encode().decode("latin-1").translate(self.alphabet)
                 for t in tokens)
        return [[x.id for x in encode(t)] for t in plain]

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin (and the last end). Texts are cut at added tokens."""
        texts = pc.fill_null(texts, "")
        holds = pc.match_substring_regex(texts, self.any_added) if self.added else pa.array([], pa.bool_())
        if not pc.any(holds).as_py():
            lists = encode_array(texts, self)
            return np.asarray(lists.values), np.asarray(lists.offsets)
        parts, after, counts = [], [], []           # parts of ordinary text, and the ids that follow each
        for text, held in zip(texts.to_pylist(), holds.to_pylist()):
            if held and not self.literal:
                cut, ids = [""], [self.tokenizer.encode(text, add_special_tokens=False).ids]
            else:
                cut = self.split_added(text) if held else [text]
                cut, ids = cut[::2], [[self.added[x]] for x in cut[1::2]] + [[]]
            parts += cut
            after += ids
            counts.append(len(cut))
        lists = encode_array(pa.array(parts, pa.large_string()), self)
        ends, more = np.asarray(lists.offsets).astype(np.int64), np.array([len(x) for x in after])
        values = np.insert(np.asarray(lists.values), np.repeat(ends[1:], more), np.array([k for x in after for k in x], np.int32))
        return values, (ends + np.concatenate([[0], np.cumsum(more)]))[np.concatenate([[0], np.cumsum(counts)])]


def _encoder(definition: str, pattern: str) -> Encoder:
    state = worker_state()
    if getattr(state, "orc_key", None) != (definition, pattern):
        state.orc, state.orc_key = Encoder(definition, pattern), (definition, pattern)
    return state.orc


def with_tokens(docs: DataFrame, tokenizer_path: str, pattern: str, end_id: int, text_col: str = "text", ids_col: str = "tokens") -> DataFrame:
    """``docs`` with the ids of each text, ``end_id`` last."""
    small_batches(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())     # as large as the vocabulary

    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(definition.value, pattern)
        for texts in batches:
            values, ends = encoder.encode_texts(texts)
            values = np.insert(values, ends[1:], end_id)
            yield pa.ListArray.from_arrays(pa.array((ends + np.arange(len(ends))).astype(np.int32)), pa.array(values, pa.int32()))

    return docs.withColumn(ids_col, F.arrow_udf(tokens, T.ArrayType(T.IntegerType()))(F.col(f"`{text_col}`")))


def write(docs: DataFrame, path: str, tokenizer_path: str, pattern: str, end_id: int = 0, id_col: str = "doc_id",
          text_col: str = "text", stripe_mb: int = 64, row_stride: int = 10_000, bloom_fpp: float = 0.01, file_rows: int = 1_000_000) -> None:
    """Write the token files, of ``file_rows`` rows at most.

    ``seq`` numbers rows upwards over all files; its upper bits are the number of the range.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.withColumn("read", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("doc_id", "tie", "read").sortWithinPartitions("doc_id", "tie", "read")
    rows = with_tokens(rows, tokenizer_path, pattern, end_id)
    (rows.select(F.monotonically_increasing_id().alias("seq"), "doc_id", F.size("tokens").alias("n_tokens"), "tokens")
     .write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", str(bloom_fpp))
     .option("orc.create.index", "true").option("orc.row.index.stride", str(row_stride))
     .option("orc.stripe.size", str(stripe_mb << 20)).option("compression", "zstd").option("maxRecordsPerFile", file_rows).orc(path))


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The rows of token files; ``doc_ids`` are looked up through the stripe statistics and Bloom filters."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))


@F.arrow_udf(T.LongType())
def ids_crc32(lists: pa.Array) -> pa.Array:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    ids, lengths = flat_lists(lists)
    data, ends = memoryview(ids.astype("<u4").tobytes()), np.concatenate([[0], np.cumsum(lengths)]) * 4
    return pa.array([zlib.crc32(data[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.int64())


def positions(spark: SparkSession, path: str, part_rows: int = 100_000) -> DataFrame:
    """Where each document's ids start in the sequence of all ids, with their number and checksum.

    Sums are taken in three steps: over the rows of a part (``part_rows`` successive rows of a
    range), over the parts of a range, and over the ranges, of which there are as many
    as there were tasks. No step sees more rows than those, however long a range is. Sizes of parts
    come from the two integer columns alone.
    """
    small_batches(spark)
    number = F.shiftright("seq", 33).alias("range")
    part = F.floor(F.col("seq").bitwiseAND(F.lit((1 << 33) - 1)) / part_rows).alias("part")
    earlier = (Window.unboundedPreceding, -1)
    sizes = read(spark, path).groupBy(number, part).agg(F.sum("n_tokens").alias("size"))
    in_range = Window.partitionBy("range").orderBy("part").rowsBetween(*earlier)
    sizes = cut(sizes.withColumn("in_range", F.coalesce(F.sum("size").over(in_range), F.lit(0))))
    ranges = sizes.groupBy("range").agg(F.sum("size").alias("size"))
    before = Window.orderBy("range").rowsBetween(*earlier)
    ranges = ranges.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    offsets = sizes.join(ranges, "range").select("range", "part", (F.col("before") + F.col("in_range")).alias("offset"))
    within = Window.partitionBy("range", "part").orderBy("seq").rowsBetween(*earlier)
    rows = read(spark, path).select(number, part, "seq", "doc_id", "n_tokens", ids_crc32("tokens").alias("ids_crc32"))
    return (rows.join(offsets, ["range", "part"])
            .select("doc_id", (F.col("offset") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("start"),
                    F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32"))
