"""Ranked lexical search: a set of items against all documents, by dense blocked multiplication.

A term is a run of ASCII letters and digits and of anything beyond ASCII, with
only A-Z lower-cased. A document's score for an item is the sum, over the item's
terms (repeats included), of weight times impact, both whole numbers:

* weight ``floor(1000 * ln((2N + 2) / (2df + 1)))``, N the documents with a term,
  df those with this term;
* impact ``(10**9 * tf) div (1000 * tf + 8 * m)``, at most ``10**6``, with
  ``m = 25 + (75 * n * N) div L``, n the document's terms and L those of all.

Items are taken in blocks of bounded size. A block's vocabulary is compact: its
own terms, numbered. Documents are read once for a block and become rows of term
numbers and counts (written); document frequencies are summed per task, then
over tasks. Each task then makes dense float64 tiles of impacts (documents by
those terms of a vocabulary tile that occur in them) and multiplies them with the
tiles of item weights. Vocabulary tiles are cut such that no sum of a product can
reach 2**53, so every product is exact; sums over tiles are 64-bit integers. A
term that an item repeats too often for one tile stands in several.

Best documents are taken tile by tile: all above the k-th best score and, of those
equal to it, the first by id. A task keeps k documents an item, so a last window
by item sees k rows a task.

Nulls: a null text, of an item or a document, has no terms; a null document id
comes first among equal scores. Empty texts have no terms. A very long text is
counted piece by piece. Rows alike are documents, and items, of their own: their
ranks are apart. Ids of documents are whole numbers. Other columns are ignored.
Without items, or without a term in any document, there are no rows.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from jobuse.llm.common import row_key, small_batches, written

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")       # of UTF-8 bytes, after lower-casing A-Z
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")

BLOCK_CHARS = 500_000       # item text searched for at a time, about
PIECE_BYTES = 4 << 20       # document text split at a time
MAX_IMPACT = 10 ** 6
EXACT = 2 ** 53             # whole numbers below it add up exactly in float64
TILE_TERMS, TILE_DOCS, TILE_ITEMS = 2048, 256, 256


def terms_of(text: str | None) -> Counter:
    """How often each term (bytes) occurs in a text."""
    data, found, at = (text or "").encode(), Counter(), 0
    while at < len(data):
        end = min(len(data), at + PIECE_BYTES)
        if end < len(data):         # cut where no term goes on
            gap = GAP.search(data, end)
            end = gap.start() if gap else len(data)
        found.update(TERM.findall(data[at:end].lower()))
        at = end
    return found


@dataclass(frozen=True)
class Corpus:
    """Counts over all documents: those with a term, their terms, and those with each term of the vocabulary."""
    docs: int
    terms: int
    with_term: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.docs + 2) / (2 * df + 1))) for df in self.with_term.tolist()], np.int64)


# ---- tiles ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Tile:
    """Weights of some items (a run of places) for some terms (ascending numbers; a heavy one may come twice)."""
    items: slice
    columns: np.ndarray
    row: np.ndarray
    column: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        out = np.zeros((self.items.stop - self.items.start, len(self.columns)))
        out[self.row, self.column] = self.weight
        return out


def item_tiles(items: list[dict[int, int]], weights: np.ndarray, most: int = (EXACT - 1) // MAX_IMPACT) -> list[Tile]:
    """Tiles of the weights of items (each its term numbers, with counts).

    No item's weights in a tile come to more than ``most``, so that with any
    impacts their sum stays below 2**53.
    """
    tiles = []
    for first in range(0, len(items), TILE_ITEMS):
        group = items[first: first + TILE_ITEMS]
        by_term: dict[int, dict[int, int]] = {}
        for k, item in enumerate(group):
            for term, count in item.items():
                by_term.setdefault(term, {})[k] = count * int(weights[term])
        open_columns, load = [], [0] * len(group)

        def close():
            if open_columns:
                entries = [(k, c, w) for c, (_, entry) in enumerate(open_columns) for k, w in entry.items()]
                row, column, weight = (np.array(x) for x in zip(*entries))
                tiles.append(Tile(slice(first, first + len(group)), np.array([t for t, _ in open_columns], np.int64),
                                  row, column, weight.astype(np.float64)))
            open_columns.clear()
            load[:] = [0] * len(group)

        for term in sorted(by_term):
            left = by_term[term]
            while left:
                part = {k: min(w, most) for k, w in left.items()}
                if len(open_columns) == TILE_TERMS or any(load[k] + w > most for k, w in part.items()):
                    close()
                open_columns.append((term, part))
                for k, w in part.items():
                    load[k] += w
                left = {k: w - most for k, w in left.items() if w > most}
        close()
    return tiles


def impacts(count: np.ndarray, n_terms: np.ndarray, corpus: Corpus) -> np.ndarray:
    """Impact of each posting, from its count and its document's terms."""
    m = 25 + (75 * n_terms * corpus.docs) // corpus.terms
    return (10 ** 9 * count) // (1000 * count + 8 * m)


def scores(tiles: list[Tile], n_items: int, n_docs: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> np.ndarray:
    """Scores (items by documents) of one tile of documents, from its postings."""
    total = np.zeros((n_items, n_docs), np.int64)
    order = np.argsort(term, kind="stable")
    doc, term, impact = doc[order], term[order], impact[order]
    for tile in tiles:
        a, b = np.searchsorted(term, [tile.columns[0], tile.columns[-1] + 1])
        if a == b:
            continue
        here, place = np.unique(term[a:b], return_inverse=True)
        dense = np.zeros((len(here), n_docs))
        dense[place, doc[a:b]] = impact[a:b]
        at = np.minimum(np.searchsorted(here, tile.columns), len(here) - 1)
        used = here[at] == tile.columns
        total[tile.items] += (tile.dense()[:, used] @ dense[at[used]]).astype(np.int64)
    return total


class Best:
    """The k best documents of each item so far: by score, then by id (a missing id first)."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.found = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in range(n_items)]

    def add(self, total: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        for item in np.flatnonzero(total.max(axis=1) > 0) if total.size else ():
            row = total[item]
            kept = row > 0
            if kept.sum() > self.k:         # ties with the k-th best stay
                kept &= row >= np.partition(row, len(row) - self.k)[len(row) - self.k]
            best = [np.concatenate(x) for x in zip(self.found[item], (row[kept], known[kept], ids[kept]))]
            order = np.lexsort((best[2], best[1], -best[0]))[:self.k]
            self.found[item] = tuple(x[order] for x in best)


# ---- Spark ------------------------------------------------------------------------------

POSTINGS = "doc_id bigint, n_terms bigint, term array<int>, count array<bigint>"


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(np.asarray(lists.offsets))
    return np.asarray(lists.flatten()).astype(np.int64), sizes


def _postings(vocabulary):
    """Texts to the terms of a vocabulary that occur in them; texts without any term go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: k for k, t in enumerate(vocabulary.value)}
        for batch in batches:
            n_terms, terms, counts = [], [], []
            for text in batch.column("text"):
                found = terms_of(text.as_py())
                n_terms.append(sum(found.values()))
                known = [(number[t], c) for t, c in found.items() if t in number]
                terms.append([t for t, _ in known])
                counts.append([c for _, c in known])
            out = pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_terms": pa.array(n_terms, pa.int64()),
                "term": pa.array(terms, pa.list_(pa.int32())), "count": pa.array(counts, pa.list_(pa.int64()))})
            yield out.filter(pa.array([n > 0 for n in n_terms], pa.bool_()))
    return run


def _counts(size: int):
    """Postings to counts of a task: term -1 has the documents, -2 their terms, others the documents with them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, terms, with_term = 0, 0, np.zeros(size, np.int64)
        for batch in batches:
            docs, terms = docs + len(batch), terms + int(np.asarray(batch.column("n_terms")).sum())
            with_term += np.bincount(_flat(batch.column("term"))[0], minlength=size)
        seen = np.flatnonzero(with_term)
        yield pa.RecordBatch.from_pydict({"term": pa.array(np.concatenate([[-1, -2], seen]).astype(np.int32)),
                                          "n": pa.array(np.concatenate([[docs, terms], with_term[seen]]).astype(np.int64))})
    return run


def _searched(shared, k: int):
    """Postings to the k best documents of a task for each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, corpus = shared.value
        tiles, best = item_tiles(items, corpus.weights()), Best(len(items), k)
        for batch in batches:
            for at in range(0, len(batch), TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                term, sizes = _flat(part.column("term"))
                doc = np.repeat(np.arange(len(part)), sizes)
                n_terms = np.asarray(part.column("n_terms"))
                impact = impacts(_flat(part.column("count"))[0], n_terms[doc], corpus)
                ids = part.column("doc_id")
                best.add(scores(tiles, len(items), len(part), doc, term, impact),
                         np.asarray(ids.fill_null(0)), np.asarray(ids.is_valid()))
        for item, (score, known, ids) in enumerate(best.found):
            yield pa.RecordBatch.from_pydict({"item": pa.array([item] * len(score), pa.int32()),
                                              "doc_id": pa.array(ids, pa.int64(), mask=~known), "score": pa.array(score, pa.int64())})
    return run


def _search_block(docs: DataFrame, items: list[Counter], k: int) -> DataFrame | None:
    """The best documents of a block of items (by place in the block); None where nothing can be found."""
    spark = docs.sparkSession
    vocabulary = sorted(set().union(*items))
    if not vocabulary:
        return None
    postings = written(docs.mapInArrow(_postings(spark.sparkContext.broadcast(vocabulary)), POSTINGS), "postings")
    summed = postings.mapInArrow(_counts(len(vocabulary)), "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r["term"]: r["n"] for r in summed.collect()}      # as many as the block has terms, at most
    if not counts.get(-1):
        return None
    corpus = Corpus(counts[-1], counts[-2], np.array([counts.get(t, 0) for t in range(len(vocabulary))], np.int64))
    number = {t: n for n, t in enumerate(vocabulary)}
    shared = spark.sparkContext.broadcast(([{number[t]: c for t, c in i.items()} for i in items], corpus))
    found = postings.mapInArrow(_searched(shared, k), "item int, doc_id bigint, score bigint")
    ordered = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The ``k`` best documents of each item: item id, ``rank``, document id, ``score`` (above 0)."""
    spark = docs.sparkSession
    small_batches(spark)
    own = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    queries = items.select(F.col(f"`{item_id_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text")).where(F.length("text") > 0)
    chars = queries.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    block = F.pmod(F.xxhash64(row_key(F.col("item_id"), F.col("text")), F.monotonically_increasing_id()), F.lit(blocks))
    queries = written(queries.withColumn("block", block), "items")
    schema = f"item_id {queries.schema['item_id'].dataType.simpleString()}, rank int, doc_id bigint, score bigint"
    out = spark.createDataFrame([], schema)
    for b in range(blocks):
        rows = queries.where(F.col("block") == b).collect()         # about ``block_chars`` of text
        found = _search_block(own, [terms_of(r["text"]) for r in rows], k)
        if found is not None:
            names = spark.createDataFrame([(n, r["item_id"]) for n, r in enumerate(rows)], f"item int, {schema.split(',')[0]}")
            out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out.withColumnRenamed("item_id", item_id_col).withColumnRenamed("doc_id", id_col)
