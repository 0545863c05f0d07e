"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Benchmark items are cut into passages of at most ``passage`` characters, one
beginning every ``stride`` characters at least, each with a budget of k edits, so
an excerpt of passage + stride - 2 k - 1 characters holds a passage within its
budget wherever it is cut out. By the q-gram lemma an occurrence of a passage of m
characters within k edits shares at least m + 1 - q (k + 1) of its q-grams, all
of them on diagonals (place in the text less place in the passage) at most k
apart. Shared q-grams are counted in overlapping bands of 2 (k + 1) diagonals,
every k + 1 diagonals, so that some band holds all of them; bands that reach the
bound are verified by an alignment held to the band.

Texts and items are compared as lower-case letters and digits; whatever lies
between words counts as one space. Items are the query set: they lie in the shared
folder in blocks of bounded size, and workers read block after block against
documents where these are. Documents are not shuffled. Very long texts are read
whole, and worker memory follows the longest.

Items no longer than a passage are matched whole, those of fewer than ``shortest``
characters exactly and as whole words (in scripts without spaces, anywhere). Null
and empty texts match nothing; nor do items without a letter or digit. Items alike
in text match alike. Repeated rows are matched each for itself. Without items,
nothing matches.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F, types as T

from jobuse.llm.common import scratch, small_batches, unused, worker_state
from jobuse.llm.pieces import text_slices
from jobuse.llm.words import BYTE_STEP, Sums

SLICE_BYTES = 1 << 19
HELD_BYTES = 32 << 20       # texts held for a round of blocks, which takes longer than building the indexes
FILTER_BITS = 20
ENTRIES = 4_000_000         # shared q-grams counted at a time
ALIGNED = 20_000            # bands aligned at a time
OUTSIDE = np.uint32(0xFFFFFFFF)
FOUND = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), *(T.StructField(k, T.IntegerType()) for k in ("start", "end", "edits"))]))


@dataclass(frozen=True)
class Filter:
    """``block_chars`` bounds what is indexed at a time (a longer item is a block)."""

    q: int = 8
    passage: int = 40
    stride: int = 5
    budget: float = 0.08        # edits a character
    shortest: int = 32          # shorter items are matched exactly
    block_chars: int = 500_000

    def edits(self, m: int) -> int:
        """The budget of a passage: as many edits as leave q-grams to count."""
        return min(int(self.budget * m), (m + 1 - self.q // 2) // self.q - 1)

    def least_shared(self, m: int) -> int:
        return max(1, m + 1 - self.q * (self.edits(m) + 1))


def _fold_table() -> np.ndarray:
    """For each character of the basic plane: its lower case, or a space if it is no letter or digit."""
    state = worker_state()
    if not hasattr(state, "fold"):
        table = np.arange(1 << 16, dtype=np.uint32)
        for c in range(1 << 16):
            low = chr(c).lower()
            table[c] = (ord(low) if len(low) == 1 else c) if chr(c).isalnum() else 32
        state.fold = table
    return state.fold


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters of all texts, a zero after each; the place of each in its text; where each text's begin.

    Between words there is one space, and one at most at the ends.
    """
    codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    stop = np.zeros(len(codes), bool)
    stop[np.cumsum([len(t) + 1 for t in texts]) - 1] = True
    codes = np.where(codes < 1 << 16, _fold_table()[codes & 0xFFFF], codes)
    codes[stop] = 0
    space = codes == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    at = np.flatnonzero(keep)
    begin = np.concatenate([[0], np.flatnonzero(stop) + 1])
    codes, stop = codes[at], stop[at]
    ends = np.flatnonzero(stop)
    return codes, at - np.repeat(begin[:-1], np.diff(ends, prepend=-1)), np.concatenate([[0], ends + 1])


def distances(passages: np.ndarray, windows: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The least edits that turn each passage into a part of its window of text, in a band of diagonals.

    The band begins at the window's first character and is as wide as the window
    is longer than the passage, and one more. Returns the rows within ``budget``,
    their edits, and where the part starts and ends in the window. Text beyond its
    ends is ``OUTSIDE``; it equals nothing, so matching it costs what leaving out
    the passage's character costs. Step i holds, for each diagonal, the cost of
    passage[:i] ending at window[i + diagonal].
    """
    m = passages.shape[1]
    width = windows.shape[1] - m + 1
    steps = np.arange(width, dtype=np.int32)
    rows = np.arange(len(passages))
    cost = np.zeros((len(rows), width), np.int32)
    start = np.repeat(steps[None], len(rows), 0)
    drop, after = np.full_like(cost, budget + 1), np.zeros_like(start)
    for i in range(m):
        change = cost + (windows[:, i: i + width] != passages[:, i: i + 1])
        drop[:, :-1], after[:, :-1] = cost[:, 1:] + 1, start[:, 1:]         # a character of the passage is missing from the text
        slope = np.minimum(change, drop) - steps
        reach = np.minimum.accumulate(slope, axis=1)                        # characters of the text that the passage lacks
        source = np.maximum.accumulate(np.where(slope == reach, steps, 0), axis=1)
        cost, start = reach + steps, np.take_along_axis(np.where(change <= drop, start, after), source, 1)
        if i % 8 == 7 or i == m - 1:
            near = cost.min(axis=1) <= budget
            if not near.all():
                rows, passages, windows, cost, start, drop, after = (x[near] for x in (rows, passages, windows, cost, start, drop, after))
    best = cost.argmin(axis=1)[:, None] if len(rows) else np.zeros((0, 1), np.int64)
    return rows, np.take_along_axis(cost, best, 1)[:, 0], np.take_along_axis(start, best, 1)[:, 0], best[:, 0] + m


def _windows(text: np.ndarray, first: np.ndarray, size: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``size`` characters from ``first`` on, as far as they lie in text[begin:end], for each row."""
    at = first[:, None] + np.arange(size)
    inside = (at >= begin[:, None]) & (at < end[:, None])
    return np.where(inside, text[np.where(inside, at, 0)], OUTSIDE) if len(text) else np.full(at.shape, OUTSIDE)


def distance(passage: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """``distances`` of one passage and text on diagonals ``low`` .. ``high``: edits, start and end, or None."""
    window = _windows(text, np.array([low]), len(passage) + high - low, np.array([0]), np.array([len(text)]))
    rows, edits, start, end = distances(passage[None], window, budget)
    return (int(edits[0]), *np.clip([start[0] + low, end[0] + low], 0, len(text)).tolist()) if len(rows) else None


def _edges(codes: np.ndarray) -> np.ndarray:
    """Whether a word may begin or end before each character, and after the last."""
    gap = (codes == 0) | (codes == 32)
    for first, last in ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0xFFFFFFFF)):     # written without spaces
        gap |= (codes >= first) & (codes <= last)
    return np.append(True, gap) | np.append(gap, True)


class Index:
    """The q-grams of a block of passages."""

    def __init__(self, items: list[tuple[int, str]], f: Filter):
        self.f, self.passages, self.items = f, [], []
        short: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item, text in items:
            codes = fold([text or ""])[0][:-1]
            codes = codes[int(len(codes) > 0 and codes[0] == 32): len(codes) - int(len(codes) > 0 and codes[-1] == 32)]
            if len(codes) < f.shortest:
                if len(codes):
                    short.setdefault(len(codes), []).append((item, codes))
                continue
            size = min(len(codes), f.passage)
            for begin in np.linspace(0, len(codes) - size, -(-(len(codes) - size) // f.stride) + 1).round().astype(int):
                self.passages.append(codes[begin: begin + size])
                self.items.append(item)
        self.short = []
        for m, some in short.items():
            hashes = np.concatenate([self.sums(c).runs(np.array([0]), np.array([m])) for _, c in some])
            order = np.argsort(hashes, kind="stable")
            self.short.append((m, hashes[order], [some[k] for k in order]))
        self.lengths = lengths = np.array([len(p) for p in self.passages], np.int64)
        self.flat, self.begin = np.concatenate([*self.passages, np.zeros(0, np.uint32)]), np.cumsum(lengths) - lengths
        self.edits = np.array([f.edits(m) for m in lengths], np.int64)
        self.least = np.array([f.least_shared(m) for m in lengths], np.int64)
        grams = [self.grams(self.sums(p), len(p)) for p in self.passages]
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.gram, first = np.unique(flat[order], return_index=True)
        self.ends = np.append(first, len(flat))
        self.passage = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order]
        self.offset = np.concatenate([np.arange(len(g)) for g in grams])[order] if grams else np.zeros(0, np.int64)
        self.there = np.zeros(1 << FILTER_BITS, bool)
        self.there[self._slot(self.gram)] = True

    @staticmethod
    def _slot(grams: np.ndarray) -> np.ndarray:
        return grams & np.uint64((1 << FILTER_BITS) - 1)

    @staticmethod
    def sums(codes: np.ndarray) -> Sums:
        return Sums(codes.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), BYTE_STEP)

    def grams(self, sums: Sums, n: int) -> np.ndarray:
        at = np.arange(max(0, n - self.f.q + 1))
        return sums.runs(at, at + self.f.q)

    def candidates(self, sums: Sums, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Bands that share enough q-grams: passage, and the band's first diagonal."""
        if not self.passages:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        grams = self.grams(sums, n)
        at = np.flatnonzero(self.there[self._slot(grams)])
        found = np.searchsorted(self.gram, grams[at])
        found[found == len(self.gram)] = 0
        hit = self.gram[found] == grams[at]
        at, found = at[hit], found[hit]
        # The q-grams of an occurrence begin within ``reach`` characters; those too far from others count for nothing.
        reach, least = int((self.lengths + self.edits).max()) - self.f.q + 1, int(self.least.min())
        close = np.flatnonzero(at[least - 1:] - at[:max(0, len(at) - least + 1)] < reach)
        cover = np.zeros(len(at) + 1, np.int64)
        cover[close] += 1
        cover[close + least] -= 1
        dense = np.cumsum(cover[:-1]) > 0
        at, found = at[dense], found[dense]
        total = np.cumsum(self.ends[found + 1] - self.ends[found])
        bands, first = [], 0
        while first < len(at):
            last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + ENTRIES, "right")))
            to = int(np.searchsorted(at, at[last - 1] + reach))             # whatever begins before ``last`` ends before ``to``
            bands.append(self._bands(at[first:to], found[first:to]))
            first = last if to < len(at) else to
        bands = np.unique(np.concatenate(bands, axis=1), axis=1) if len(bands) > 1 else bands[0] if bands else np.zeros((2, 0), np.int64)
        return bands[0], bands[1]

    def _bands(self, at: np.ndarray, found: np.ndarray) -> np.ndarray:
        n = self.ends[found + 1] - self.ends[found]
        entry = np.repeat(self.ends[found] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        passage = self.passage[entry]
        step = self.edits[passage] + 1
        shift = self.f.passage * 2                              # diagonals begin below zero
        half = (np.repeat(at, n) - self.offset[entry] + shift) // step
        keys, counts = np.unique(passage << 40 | half, return_counts=True)
        # A band is a half-band and the next; one may begin in an empty half-band before the first.
        follows = np.append(np.diff(keys) == 1, False)
        both = counts + np.where(follows, np.append(counts[1:], 0), 0)
        passage, half = keys >> 40, keys & (1 << 40) - 1
        enough = both >= self.least[passage]
        return np.stack([passage[enough], half[enough] * (self.edits[passage[enough]] + 1) - shift])

    def _aligned(self, codes: np.ndarray, begins: np.ndarray, passage: np.ndarray, low: np.ndarray):
        """Finds in bands: text, item, start and end in ``codes``, and edits."""
        k, m = self.edits[passage], self.lengths[passage]
        low, width = low - k, 4 * k + 2
        first = np.searchsorted(begins, np.maximum(0, low), "right") - 1
        last = np.searchsorted(begins, np.minimum(len(codes) - 1, low + width + m), "right") - 1
        n = np.maximum(last - first + 1, 0)                                 # a band may lie over several short texts
        of = np.repeat(np.arange(len(n)), n)
        text = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        for size in np.unique(m[of]).tolist():
            same = np.flatnonzero(m[of] == size)
            for part in np.split(same, range(ALIGNED, len(same), ALIGNED)):
                band, d = of[part], text[part]
                p, begin, end = passage[band], begins[d], begins[d + 1] - 1
                windows = _windows(codes, low[band], size + int(width[band[0]]) - 1, begin, end)
                rows, edits, start, stop = distances(self.flat[self.begin[p][:, None] + np.arange(size)], windows, int(k[band[0]]))
                start, stop = (np.clip(x + low[band[rows]], begin[rows], end[rows]) for x in (start, stop))
                yield from zip(d[rows].tolist(), [self.items[x] for x in p[rows].tolist()], start.tolist(), stop.tolist(), edits.tolist())

    def _exact(self, codes: np.ndarray, begins: np.ndarray, sums: Sums):
        """Finds of short items: text, item, start and end in ``codes``, no edits."""
        if not self.short:
            return
        edge = _edges(codes)
        left = np.flatnonzero(edge[:-1])
        for m, hashes, items in self.short:
            at = left[left + m <= len(codes)]
            at = at[edge[at + m]]
            found = sums.runs(at, at + m)
            first, last = np.searchsorted(hashes, found, "left"), np.searchsorted(hashes, found, "right")
            for k in np.flatnonzero(first < last).tolist():
                begin = int(at[k])
                for item, want in items[first[k]: last[k]]:
                    if np.array_equal(codes[begin: begin + m], want):
                        yield int(np.searchsorted(begins, begin, "right")) - 1, item, begin, begin + m, 0

    def matches(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """For each text: item, start, end and edits of the passages in it. Overlapping finds of an item are one."""
        codes, places, begins = fold(texts)
        sums = self.sums(codes)
        found: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        for finds in (self._aligned(codes, begins, *self.candidates(sums, len(codes))), self._exact(codes, begins, sums)):
            for d, item, start, end, edits in finds:
                if end > start:
                    found[d].append((item, int(places[start]), int(places[end - 1]) + 1, edits))
        return [_merged(x) for x in found]


def _merged(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    merged: list[tuple[int, int, int, int]] = []
    for item, start, end, edits in sorted(found, key=lambda x: (x[0] is None, x[0] or 0, *x[1:])):
        if merged and merged[-1][0] == item and start < merged[-1][2]:
            last = merged.pop()
            merged.append((item, last[1], max(end, last[2]), max(edits, last[3])))
        else:
            merged.append((item, start, end, edits))
    return merged


def _index(block: str, f: Filter) -> Index:
    """The worker's index of a block (a folder of items), built from its files; one is kept."""
    state = worker_state()
    if getattr(state, "grams_key", None) != (block, f):
        state.grams = state.grams_key = None
        system, folder = fs.FileSystem.from_uri(block)
        items = pq.read_table(folder, filesystem=system, partitioning=None).select(["item_id", "text"]).to_pylist()
        state.grams = Index(sorted(((x["item_id"], x["text"]) for x in items), key=str), f)
        state.grams_key = (block, f)
    return state.grams


def _found(blocks: list[str], f: Filter):
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))

    def against_all(texts: list[pa.Array]) -> pa.Array:
        out: list[list] = [[] for _ in range(sum(map(len, texts)))]
        for block in blocks:
            index, at = _index(block, f), 0
            for part in (part for some in texts for part in text_slices(some, SLICE_BYTES)):
                for found in index.matches(part.to_pylist()):
                    out[at] += [dict(zip(("item_id", "start", "end", "edits"), x)) for x in found]
                    at += 1
        return pa.array(out, kind)

    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held, size = [], 0
        for texts in batches:
            held.append(texts)
            size += texts.nbytes
            # With a single block its index stays, so nothing is gained by waiting.
            if len(blocks) == 1 or size >= HELD_BYTES:
                yield against_all(held)
                held, size = [], 0
        if held:
            yield against_all(held)

    # Not to be evaluated once more by a filter that Spark derives from it.
    return F.arrow_udf(of, FOUND).asNondeterministic()


def leaks(docs: DataFrame, benchmark: DataFrame, f: Filter = Filter(), text_col: str = "text") -> Column:
    """A column of the benchmark passages in each text: item, place in the text (code points) and edits.

    The benchmark is written in blocks to the shared folder. A worker reads texts
    of some ``HELD_BYTES``, then one block after another, and keeps one index at a
    time; neither the driver nor the plan holds any items.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-chars // f.block_chars))))
    folder = scratch(spark, "benchmark")
    table = items.withColumn("block", part)
    table.repartition("block").write.partitionBy("block").parquet(folder)
    full = [r["block"] for r in table.select("block").distinct().orderBy("block").collect()]
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return _found([f"{uri}/block={b}" for b in full], f)(F.col(f"`{text_col}`"))


def contaminated(docs: DataFrame, benchmark: DataFrame, f: Filter = Filter(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, start, end, edits``: every benchmark passage found in a document."""
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), leaks(docs, benchmark, f, text_col).alias("found"))
    return found.select("doc_id", F.explode("found").alias("x")).select("doc_id", "x.*")


def clean(docs: DataFrame, benchmark: DataFrame, f: Filter = Filter(), text_col: str = "text", least_chars: int = 25) -> DataFrame:
    """The rows of ``docs`` without benchmark passages of ``least_chars`` characters, with all their columns.

    Shorter finds are whole items of a word or a few, which are no sign of a leak:
    ``contaminated`` reports them, but no document goes for them.
    """
    name = unused(docs, "found")
    leaked = F.exists(name, lambda x: x["end"] - x["start"] >= least_chars)
    return docs.withColumn(name, leaks(docs, benchmark, f, text_col)).where(~leaked).drop(name)
