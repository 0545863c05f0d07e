"""Repeated passages, by relative Lempel-Ziv parsing against reference blocks.

The whole corpus is the reference. It is indexed in blocks, one for each anchor:
a window's anchor is the least 8-word hash inside it, so equal windows have equal
anchors, and a window can only recur in the block of its own anchor. A document
is cut into segments (successive windows with one anchor) and each segment is
factored against its block:

1. blocks of a single segment cannot repeat anything and are dropped;
2. segments equal as a whole are factors at once. They collapse to a count, on
   the map side first, so groups of copies travel as a few rows;
3. of the other segments, and one of each group of equal ones, every window is
   looked up in its block's index of window hashes.

Windows found are then joined per document into factors: a factor goes on as long
as its source does, and at each factor boundary the parse starts again from the
first window the factor did not hold, so no window that straddles a boundary is
missed. Each factor is a duplicate span with its source; the least occurrence of a
passage is its own source.

Blocks are keys of shuffled aggregates and joins, never groups held by a task, so
an anchor in a third of all documents only makes a skewed join side, which
adaptive execution splits. Equality is that of two 64-bit hashes together.

Null and empty texts have no words; texts shorter than a window keep all words.
Rows that are alike in id and text are occurrences of their own, so both lose
the windows they share; they have one key, whose windows are collected as a set,
on the map side first, and are looked up once for all of them. Ids may be null. Extra columns are dropped.
"""

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from jobuse.llm.common import row_key, small_batches, written
from jobuse.llm.pieces import text_slices
from jobuse.llm.words import SLICE_BYTES, WORD_STEP, Sums, sliding_min, word_hashes

ANCHOR_WORDS = 8
INDEX_BITS = np.uint64((1 << 28) - 1)


class Segments:
    """The windows of a slice of texts, and their segments."""

    def __init__(self, texts: pa.Array, window: int):
        anchor = min(ANCHOR_WORDS, window)
        hashes, counts = word_hashes(texts)
        self.window, self.sums = window, Sums(hashes, WORD_STEP)
        first = np.cumsum(counts) - counts
        n_windows = np.maximum(counts - window + 1, 0)
        total = int(n_windows.sum())
        doc = np.repeat(np.arange(len(counts)), n_windows)
        at = np.arange(total) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)     # within the document
        if not total:
            self.at = self.doc = self.begin = self.start = self.size = np.zeros(0, np.int64)
            self.anchor = self.whole = np.zeros(0, np.uint64)
            return
        start = at + first[doc]
        k = np.arange(len(hashes) - anchor + 1)
        grams = self.sums.runs(k, k + anchor)
        least = sliding_min(grams & ~INDEX_BITS | k.astype(np.uint64), window - anchor + 1)[start] & INDEX_BITS
        new = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(least.astype(np.int64)) != 0)])
        self.begin = np.flatnonzero(new)                                                    # first window of each segment
        self.size = np.diff(np.append(self.begin, total))
        self.doc, self.at, self.start = doc[self.begin], at[self.begin], start[self.begin]
        self.anchor = grams[least[self.begin]]
        self.whole = self.sums.runs(self.start, self.start + self.size + window - 1)

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of some segments, and the index of each window within its segment."""
        size = self.size[chosen]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        start = np.repeat(self.start[chosen], size) + within
        return self.sums.runs(start, start + self.window), within


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def segments(docs: DataFrame, window: int) -> DataFrame:
    """``anchor, whole, key, at, size`` of every segment of ``docs`` (``key``, ``text``)."""
    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, done = np.asarray(batch.column("key")), 0
            for texts in text_slices(batch.column("text"), SLICE_BYTES):
                s = Segments(texts, window)
                yield pa.RecordBatch.from_pydict({
                    "anchor": _signed(s.anchor), "whole": _signed(s.whole), "key": pa.array(keys[done + s.doc]),
                    "at": pa.array(s.at.astype(np.int32)), "size": pa.array(s.size.astype(np.int32))})
                done += len(texts)

    return docs.select("key", "text").mapInArrow(cut_up, "anchor long, whole long, key long, at int, size int")


def packed(docs: DataFrame) -> DataFrame:
    """``key, doc_id, packed``: texts are compressed for the one shuffle that moves them."""
    def of(texts: pa.Array) -> pa.Array:
        press = zstandard.ZstdCompressor(level=3)
        return pa.array([None if t is None else press.compress(t.encode()) for t in texts.to_pylist()], pa.binary())

    return docs.select("key", "doc_id", F.arrow_udf(of, T.BinaryType())("text").alias("packed"))


def unpacked(texts: pa.Array) -> pa.Array:
    press = zstandard.ZstdDecompressor()
    return pa.array([None if t is None else press.decompress(t) for t in texts.to_pylist()], pa.binary()).cast(pa.string())


def window_rows(docs: DataFrame, window: int) -> DataFrame:
    """``anchor, hash, key, at`` of every window of the segments that begin at ``wanted`` in each document."""
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            # Rows alike are neighbours after the join, and one of them stands for all: their segments repeat as a whole.
            keys = np.asarray(batch.column("key"))
            new = np.append(keys[:1] != last, keys[1:] != keys[:-1])
            last, batch = keys[-1] if len(keys) else last, batch.filter(pa.array(new))
            keys, wanted, done = keys[new], batch.column("wanted").to_numpy(zero_copy_only=False), 0
            for texts in text_slices(unpacked(batch.column("packed")), SLICE_BYTES):
                s = Segments(texts, window)
                pairs = np.concatenate([np.stack([np.full(len(w), d), w]) for d, w in enumerate(wanted[done: done + len(texts)])], axis=1)
                chosen = np.flatnonzero(np.isin(s.doc << 32 | s.at, pairs[0].astype(np.int64) << 32 | pairs[1].astype(np.int64)))
                hashes, within = s.windows(chosen)
                of = np.repeat(chosen, s.size[chosen])
                yield pa.RecordBatch.from_pydict({
                    "anchor": _signed(s.anchor[of]), "hash": _signed(hashes), "key": pa.array(keys[done + s.doc[of]]),
                    "at": pa.array((s.at[of] + within).astype(np.int32))})
                done += len(texts)

    return docs.select("key", "doc_id", "packed", "wanted").mapInArrow(look_up, "anchor long, hash long, key long, at int")


def _on_hot(rows: DataFrame, counted: DataFrame, keys: list[str]) -> DataFrame:
    """Join rows with what was counted by the same keys, some of which may be hot.

    Counts lie by their keys already, so a plain join would shuffle the rows
    alone; adaptive execution splits a hot key only between two shuffles. One more
    key, implied by the others, brings the second shuffle (of the counts) about.
    """
    def parity(df: DataFrame) -> DataFrame:
        return df.withColumn("parity", F.col(keys[-1]).bitwiseAND(F.lit(1)))

    return parity(rows).join(parity(counted), [*keys, "parity"]).drop("parity")


def repeated_windows(docs: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``key, at, size, source`` of runs of windows that also start elsewhere.

    ``source`` is the key and place of the least occurrence, null for itself.
    ``texts`` are the packed texts by key.
    """
    place = F.struct("key", "at")
    source = F.when(place != F.col("least"), F.col("least")).alias("source")
    all_segments = segments(docs, window)
    blocks = all_segments.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    shared = written(_on_hot(all_segments, blocks, ["anchor"]), "segments")
    equal = shared.groupBy("anchor", "whole").agg(F.count("*").alias("n"), F.min(place).alias("least"))
    kinds = equal.groupBy("anchor").agg(F.count("*").alias("kinds"))
    known = shared.join(_on_hot(equal, kinds, ["anchor"]), ["anchor", "whole"])
    known = written(known.select("key", "at", "size", source, (F.col("n") > 1).alias("repeated"), (F.col("kinds") > 1).alias("open"),
                                 (place == F.col("least")).alias("first")), "known")
    whole = known.where("repeated").select("key", "at", "size", "source")
    wanted = known.where("open and (first or not repeated)").groupBy("key").agg(F.collect_set("at").alias("wanted"))
    rows = window_rows(texts.join(wanted, "key"), window)
    index = rows.groupBy("anchor", "hash").agg(F.count("*").alias("n"), F.min(place).alias("least")).where("n > 1")
    parts = _on_hot(rows, index, ["anchor", "hash"]).select("key", "at", F.lit(1).alias("size"), source)
    return whole.unionByName(parts)


def _factors(windows: list[dict], window: int) -> list[tuple]:
    """The greedy parse: ``start, end, source key, source start`` of a document's factors, in words."""
    out = []
    for w in sorted(windows, key=lambda w: (w["at"], -w["size"])):
        source = w["source"] or {"key": None, "at": w["at"]}        # the least occurrence is its own source
        at, size, key, begin = w["at"], w["size"], source["key"], source["at"]
        if out:
            start, end, k, b = out[-1]
            if k == key and begin - b == at - start and at + window - 1 <= end:    # the same source goes on
                out[-1] = (start, max(end, at + size + window - 1), k, b)
                continue
            step = end - at                                                     # begin where the last factor ended
            if step >= size + window - 1:
                continue
            if step > 0:
                at, size, begin = at + step, size - step, begin + step
        out.append((at, at + size + window - 1, key, begin))
    return out


def deduplicate(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document without its repeated passages.

    Returns ``doc_id, n_words, n_removed, kept, factors``: ``kept`` are the words
    left, joined by spaces; ``factors`` the spans taken out (word positions) with
    the key and position of a source.
    """
    small_batches(docs.sparkSession)
    ident, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    docs = docs.select(row_key(ident, text).alias("key"), ident.alias("doc_id"), text.alias("text"))
    texts = packed(docs)
    found = (repeated_windows(docs, texts, window).groupBy("key")
             .agg(F.collect_set(F.struct("at", "size", "source")).alias("windows")))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("source", pa.int64()), ("source_start", pa.int32())]))
        for batch in batches:
            n_words, n_removed, kept, spans = [], [], [], []
            for text, windows in zip(unpacked(batch.column("packed")).to_pylist(), batch.column("windows").to_pylist()):
                words = (text or "").encode().split()
                factors = _factors(windows or [], window)
                left = np.ones(len(words), bool)
                for start, end, *_ in factors:
                    left[start:end] = False
                n_words.append(len(words))
                n_removed.append(len(words) - int(left.sum()))
                kept.append(b" ".join(compress(words, left) if factors else words).decode())
                spans.append([dict(zip(("start", "end", "source", "source_start"), f)) for f in factors])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                "kept": pa.array(kept, pa.string()), "factors": pa.array(spans, kind)})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return texts.join(found, "key", "left").select("key", "doc_id", "packed", "windows").mapInArrow(
        parse, f"doc_id {id_type}, n_words long, n_removed long, kept string, "
               "factors array<struct<start:int,end:int,source:long,source_start:int>>")
