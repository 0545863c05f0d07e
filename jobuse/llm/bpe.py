"""Byte-level BPE encoding and decoding with a sentencepiece model made from ranks.

The vocabulary (byte strings and their ranks) is written straight into a
sentencepiece BPE model: every byte becomes one character (U+0100 + byte), a
piece's score is its negative rank, and normalisation is the identity. Merging
the best-scored neighbours is then merging by lowest rank, so the ids are those
of the rank file. Pre-tokens are encoded one by one; decoding maps ids back to
pieces and characters back to bytes.

Null and empty texts have no ids; a null list of ids decodes to no bytes. An
empty table gives no rows. ``round_trip`` cuts very long texts into parts where a
single space stands between two other characters, which no piece crosses, so that
a worker holds the parts' arrays, not the text's. Rows are independent, so repeated rows and extra columns need no care; a column that
already has the name of the result is replaced.
"""

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from jobuse.llm.common import small_batches, unused, worker_state
from jobuse.llm.pieces import _SAFE_CUT, SLICE_BYTES, Known, encode_array, encode_slice, flat_lists, gathered, text_slices

FIRST_CHAR = 0x100
UNKNOWN, BPE_MODEL = 2, 2       # enum values of the sentencepiece model format


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    pieces = sorted(ranks, key=ranks.get)
    if [ranks[p] for p in pieces] != list(range(len(pieces))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return pieces


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value) -> bytes:
    """One field of a protocol-buffer message: an int, a float or bytes."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _chars(data: bytes) -> str:
    return "".join(chr(FIRST_CHAR + b) for b in data)


def serialise(pieces: list[bytes]) -> bytes:
    """The sentencepiece BPE model of byte strings given by rank; ids are ranks."""
    parts = [_field(1, _field(1, _chars(p).encode()) + _field(2, -float(rank))) for rank, p in enumerate(pieces)]
    parts.append(_field(1, _field(1, b"<unk>") + _field(3, UNKNOWN)))
    parts.append(_field(2, _field(3, BPE_MODEL) + _field(40, len(pieces))))             # trainer: BPE, id of <unk>
    parts.append(_field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))  # normaliser: none
    return b"".join(parts)


_TO_CHARS = {b: FIRST_CHAR + b for b in range(256)}


class Codec:
    """A loaded model; lives in a Python worker."""

    def __init__(self, model: bytes, pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find_all = regex.compile(pattern).findall
        self.known, self.slice_bytes = Known(), SLICE_BYTES

    def encode_new(self, tokens: list[str]) -> list[list[int]]:
        return self.processor.encode([t.encode().decode("latin-1").translate(_TO_CHARS) for t in tokens], num_threads=1)


def _inverse(model: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all pieces of a model, flat, and the length of each; worked out once by a worker."""
    state, key = worker_state(), hashlib.sha256(model).digest()
    if getattr(state, "inverse_key", None) != key:
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [bytes(ord(c) - FIRST_CHAR for c in processor.id_to_piece(i)) for i in range(processor.get_piece_size() - 1)]
        state.inverse = np.frombuffer(b"".join(pieces), np.uint8), np.array([len(b) for b in pieces], np.int64)
        state.inverse_key = key
    return state.inverse


def _codec(model: bytes, pattern: str) -> Codec:
    """The worker's codec for this model, loaded on first use."""
    state, key = worker_state(), hashlib.sha256(model + pattern.encode()).digest()
    if getattr(state, "bpe_key", None) != key:
        state.bpe, state.bpe_key = Codec(model, pattern), key
    return state.bpe


def encoder(spark: SparkSession, pieces: list[bytes], pattern: str):
    """A function from a column of texts to one of ids (``array<int>``).

    The model (about 1 MB for 50,000 pieces) is broadcast: its size depends on
    the vocabulary alone.
    """
    small_batches(spark)
    model = spark.sparkContext.broadcast(serialise(pieces))

    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(model.value, pattern)
        for texts in batches:
            yield encode_array(texts, codec)

    return F.arrow_udf(ids, T.ArrayType(T.IntegerType()))


def decoder(spark: SparkSession, pieces: list[bytes]):
    """A function from a column of ids to the bytes they stand for."""
    small_batches(spark)
    model = spark.sparkContext.broadcast(serialise(pieces))

    def decoded(lists: pa.Array) -> pa.Array:
        flat, sizes = _inverse(model.value)
        ids, lengths = flat_lists(lists)
        data = gathered(flat, sizes, ids)
        ends = np.concatenate([[0], np.cumsum(sizes[ids])])[np.concatenate([[0], np.cumsum(lengths)])]
        return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])

    return F.arrow_udf(decoded, T.BinaryType())


def _parts(texts: pa.Array, size: int) -> tuple[pa.Array, np.ndarray]:
    """Texts in parts of about ``size`` characters, and the text that each part belongs to."""
    if not len(texts) or pc.max(pc.binary_length(texts)).as_py() <= size:
        return texts, np.arange(len(texts))
    parts, owner = [], []
    for k, text in enumerate(texts.to_pylist()):
        at = 0
        while at == 0 or at < len(text):
            cut = _SAFE_CUT.search(text, at + size) if len(text) - at > size else None
            end = cut.start() if cut else len(text)
            parts.append(text[at:end])
            owner.append(k)
            at = end or 1
    return pa.array(parts, pa.large_string()), np.array(owner)


TRIP = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("ids_sha256", T.StringType()),
                     T.StructField("decoded_sha256", T.StringType())])


def _tripped(texts: pa.Array, codec: Codec, flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Ids of each text, and the digests of the ids and of the bytes that they decode to."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    parts, owner = _parts(texts, codec.slice_bytes)
    id_sums, byte_sums = [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
    found, lengths, done = [], np.zeros(len(texts), np.int64), 0
    for piece in text_slices(parts, codec.slice_bytes):
        ids, counts = encode_slice(piece, codec)
        rows, ends = owner[done: done + len(piece)], np.concatenate([[0], np.cumsum(counts)])
        raw, decoded = memoryview(ids.astype("<u4").tobytes()), memoryview(gathered(flat, sizes, ids).tobytes())
        at = np.concatenate([[0], np.cumsum(sizes[ids])])[ends]
        for k, row in enumerate(rows.tolist()):
            id_sums[row].update(raw[4 * ends[k]: 4 * ends[k + 1]])
            byte_sums[row].update(decoded[at[k]: at[k + 1]])
        np.add.at(lengths, rows, counts)
        found.append(ids.astype(np.int32))
        done += len(piece)
    pa.default_memory_pool().release_unused()
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()),
                                     pa.array(np.concatenate(found or [np.zeros(0, np.int32)])))
    return pa.StructArray.from_arrays([lists, *(pa.array([h.hexdigest() for h in sums], pa.string()) for sums in (id_sums, byte_sums))],
                                      [f.name for f in TRIP])


def round_trip(docs: DataFrame, pieces: list[bytes], pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the ids of each text, and the SHA-256 (hex) of the ids as little-endian unsigned 32-bit
    integers (``ids_sha256``) and of the bytes they decode to (``decoded_sha256``).

    One function does all three, so a task has one Python worker; it drops what other operators left in it.
    """
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(serialise(pieces))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        state = worker_state()
        for name in set(vars(state)) - {"bpe", "bpe_key", "inverse", "inverse_key"}:
            delattr(state, name)
        codec, (flat, sizes) = _codec(model.value, pattern), _inverse(model.value)
        for texts in batches:
            yield _tripped(texts, codec, flat, sizes)

    name = unused(docs, "trip")
    return docs.withColumn(name, F.arrow_udf(run, TRIP)(F.col(f"`{text_col}`"))).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in TRIP.names], f"{name}.*")


def encode(docs: DataFrame, pieces: list[bytes], pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text."""
    return docs.withColumn(ids_col, encoder(docs.sparkSession, pieces, pattern)(F.col(f"`{text_col}`")))


def decode(encoded: DataFrame, pieces: list[bytes], ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that the ids stand for."""
    return encoded.withColumn(bytes_col, decoder(encoded.sparkSession, pieces)(F.col(f"`{ids_col}`")))


def _sha256(lists: pa.Array) -> pa.Array:
    ids, lengths = flat_lists(lists)
    data, ends = memoryview(ids.astype("<u4").tobytes()), np.concatenate([[0], np.cumsum(lengths)]) * 4
    return pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.string())


def ids_sha256(ids_col: str = "ids") -> Column:
    """SHA-256 of the ids as little-endian unsigned 32-bit integers, in hex."""
    return F.arrow_udf(_sha256, T.StringType())(F.col(ids_col))
