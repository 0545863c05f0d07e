"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Each distinct fingerprint emits every variant within half the radius of it. Two
fingerprints within the radius have a variant in common half-way, so a shuffle
on variants brings them together; colliding pairs are compared bit by bit and
made distinct. Documents with one fingerprint are one node throughout, so groups
of copies of any size cost one row, and a variant is shared by no more
fingerprints than lie in its ball (65 for two bits).

Texts are lower-cased in A-Z, cut into words at ASCII white space and hashed by
shingles with XXH64, seed 42. A text of fewer words is one shingle; a text of
none, or a null one, has fingerprint zero and is linked like any other. Repeated
rows and ids are ordinary documents; a component of null ids alone has a null
id. An empty table gives no rows. Extra columns are dropped.
"""

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from jobuse.llm.common import row_key, small_batches, unused
from jobuse.llm.components import components
from jobuse.session import cut

SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """A bit is set if it is in over half of the shingles' hashes, repeats counted."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in runs], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    common = bits.sum(axis=0, dtype=np.int32) * 2 > len(hashes)
    return int(np.packbits(common, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with the 64-bit fingerprint of each text, as a signed long."""
    small_batches(docs.sparkSession)

    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle) for t in texts.to_pylist()], pa.int64())

    return docs.withColumn(out_col, F.arrow_udf(of, T.LongType())(F.col(f"`{text_col}`")))


def ball(radius: int) -> list[int]:
    """Masks (signed) that change at most ``radius`` of 64 bits."""
    masks = (sum(1 << bit for bit in bits) for n in range(radius + 1) for bits in combinations(range(64), n))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def close_pairs(prints: DataFrame, max_bits: int) -> DataFrame:
    """``a, b`` of distinct ``fingerprint`` values that differ in at most ``max_bits`` bits, a < b."""
    masks = F.explode(F.array(*map(F.lit, ball((max_bits + 1) // 2))))
    variants = (prints.select("fingerprint").distinct().select("fingerprint", masks.alias("mask"))
                .select(F.col("fingerprint").bitwiseXOR(F.col("mask")).alias("variant"), "fingerprint"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((2, 0), np.int64)                    # the last variant so far; it may go on
        for batch in chain(batches, [None]):
            if batch is not None:
                kept = np.concatenate([kept, np.stack([np.asarray(batch.column(k)) for k in (0, 1)])], axis=1)
                if not kept.shape[1]:
                    continue
                whole = int(np.searchsorted(kept[0], kept[0, -1], "left"))
            else:
                whole = kept.shape[1]
            (variant, value), kept = kept[:, :whole], kept[:, whole:]
            for step in range(1, whole):
                same = np.flatnonzero(variant[step:] == variant[:-step])
                if not len(same):
                    break
                a, b = value[same], value[same + step]
                close = np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits
                yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b)[close]), "b": pa.array(np.maximum(a, b)[close])})

    met = variants.repartition("variant").sortWithinPartitions("variant", "fingerprint")
    return met.mapInArrow(verify, "a long, b long").distinct()


def _components(prints: DataFrame, max_bits: int) -> DataFrame:
    """``fingerprint, first``: of its component's rows, the least by id (null last), then key."""
    row = F.struct(F.col("doc_id").isNull().alias("without"), F.col("doc_id"), F.col("key"))
    nodes = prints.groupBy("fingerprint").agg(F.min(row).alias("first"))
    linked = components(close_pairs(prints, max_bits)).withColumnRenamed("node", "fingerprint")
    nodes = cut(nodes.join(linked, "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint")))
    firsts = nodes.groupBy("label").agg(F.min("first").alias("first"))
    return nodes.select("fingerprint", "label").join(firsts, "label").select("fingerprint", "first")


def _prints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = docs.select(ident.alias("doc_id"), row_key(ident, text).alias("key"), text.alias("text"))
    return cut(fingerprints(rows, shingle).select("doc_id", "key", "fingerprint"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id``: the smallest id reachable over links of at most ``max_bits`` bits."""
    prints = _prints(docs, shingle, id_col, text_col)
    nodes = _components(prints, max_bits).select("fingerprint", F.col("first.doc_id").alias("component_id"))
    return prints.join(nodes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def representatives(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the one of smallest id.

    Of rows alike in id and text, one stays.
    """
    key = unused(docs, "key")
    kept = _components(_prints(docs, shingle, id_col, text_col), max_bits).select(F.col("first.key").alias(key)).distinct()
    # Rows alike are dropped where they are read, before their texts travel.
    rows = docs.withColumn(key, row_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))).dropDuplicates([key])
    return rows.join(kept, key, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
