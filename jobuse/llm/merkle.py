"""A Merkle manifest of a dataset, folded again from hash states kept by its nodes.

Each row is a leaf: the SHA-256 of its columns. Leaves of a group stand in
order of their id; every three nodes in a row become their parent (the hash of
their digests as hex text) until one is left, the group's root. The groups'
roots, in order of the group, become the dataset's root in the same way.

A parent is hashed child by child, and the state before each child is kept as a
copy. A changed leaf is then folded upwards by going on from the copy before its
slot with the new digest and the siblings to the right; what stands to the left
is never hashed again.

At scale: leaves are numbered by a range sort and sums per sorted partition, and
cut into chunks of ``3 ** CHUNK_LEVELS`` neighbours, so a group of any size is
many rows. A task builds the subtree of a chunk; the chunks' digests are the
leaves of the next pass (one pass for each ``CHUNK_LEVELS`` levels, so three for
10**10 rows). On the way down every chunk gets the siblings above it, and all of
its leaves are folded where they are. Hash states live in the task that builds
the chunk: they are made again when a task is repeated, and never travel.

Nulls: a null column is written ``-``; a null id comes first; rows without a group
are a group of their own, the first. Texts, empty or very long, are hashed in
whole by Spark and do not travel. Rows alike in all columns are leaves of their
own, next to each other. Rows alike in id stand in order of their digest. Other
columns are ignored; an empty table has no rows and no root.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobuse.llm.common import small_batches, written
from jobuse.session import cut

ARITY = 3
CHUNK_LEVELS = 7                        # levels that one task builds at a time
ROW_BITS = 33                           # monotonically_increasing_id keeps the row number in the low 33 bits

NODE = "struct<pos:bigint,id:bigint,digest:binary,changed:binary>"
PATH = "array<struct<left:binary,right:binary>>"    # siblings on both sides, from the bottom up


def leaf_of(columns: list[Column]) -> Column:
    """Digest of a row's values: each its length in bytes and the value, or ``-``."""
    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*(framed(c) for c in columns)), 256))


# ---- subtrees, in a task -------------------------------------------------------------

def levels_of(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


class Subtree:
    """The nodes of each level (digests as hex text), and each parent's states before its children."""

    def __init__(self, leaves: list[bytes], levels: int):
        self.nodes, self.states = [leaves], []
        for _ in range(levels):
            below, above, kept = self.nodes[-1], [], []
            for at in range(0, len(below), ARITY):
                state = hashlib.sha256()
                for child in below[at: at + ARITY]:
                    kept.append(state.copy())
                    state.update(child)
                above.append(state.hexdigest().encode())
            self.nodes.append(above)
            self.states.append(kept)

    def siblings(self, at: int) -> list[tuple[bytes, bytes]]:
        """What stands left and right of a leaf's ancestors, level by level."""
        out = []
        for nodes in self.nodes[:-1]:
            first = at - at % ARITY
            out.append((b"".join(nodes[first:at]), b"".join(nodes[at + 1: first + ARITY])))
            at //= ARITY
        return out

    def fold(self, at: int, digest: bytes, siblings: list[tuple[bytes, bytes]]) -> bytes:
        """The digest of the subtree with another leaf."""
        for states, (_, right) in zip(self.states, siblings):
            state = states[at].copy()
            state.update(digest + right)
            digest, at = state.hexdigest().encode(), at // ARITY
        return digest


def _hex(values: pa.Array) -> list[bytes]:
    return [v.hex().encode() for v in values.to_pylist()]


def _chunks(batch: pa.RecordBatch, levels: int) -> Iterator[tuple[dict, pa.StructArray, Subtree]]:
    """Each chunk of a batch: its row, its nodes in order, and its subtree."""
    nodes, size = batch.column("nodes"), batch.column("n").to_pylist()
    for k in range(len(nodes)):
        row = nodes[k].values
        row = row.take(pa.array(np.argsort(np.asarray(row.field("pos")))))
        yield k, row, Subtree(_hex(row.field("digest")), min(levels, levels_of(size[k])))


def _digests(levels: int):
    """Chunks to their digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = [bytes.fromhex(tree.nodes[-1][0].decode()) for _, _, tree in _chunks(batch, levels)]
            yield pa.RecordBatch.from_pydict({"grp": batch.column("grp"), "n": batch.column("n"),
                                              "chunk": batch.column("chunk"), "digest": pa.array(tops, pa.binary())})
    return run


def _paths(levels: int):
    """Chunks with their path to the nodes' paths."""
    kind = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = batch.column("path").to_pylist()
            for k, row, tree in _chunks(batch, levels):
                own = [[{"left": bytes.fromhex(a.decode()), "right": bytes.fromhex(b.decode())} for a, b in tree.siblings(at)]
                       for at in range(len(row))]
                yield pa.RecordBatch.from_pydict({
                    "grp": pa.array([batch.column("grp")[k].as_py()] * len(row), pa.string()), "chunk": row.field("pos"),
                    "path": pa.array([x + above[k] for x in own], kind)})
    return run


def _folds(levels: int):
    """Chunks of leaves with their path to a row for each leaf: its proof, and the root with its changed digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = batch.column("path").to_pylist()
            for k, row, tree in _chunks(batch, levels):
                higher, proof_above = [], b""
                for step in above[k]:       # hashed once for all leaves of the chunk
                    higher.append((hashlib.sha256(step["left"].hex().encode()), step["right"].hex().encode()))
                    proof_above += step["left"] + step["right"]
                proofs, roots = [], []
                for at, digest in enumerate(_hex(row.field("changed"))):
                    siblings = tree.siblings(at)
                    digest = tree.fold(at, digest, siblings)
                    for before, right in higher:
                        state = before.copy()
                        state.update(digest + right)
                        digest = state.hexdigest().encode()
                    roots.append(bytes.fromhex(digest.decode()))
                    proofs.append(bytes.fromhex(b"".join(a + b for a, b in siblings).decode()) + proof_above)
                yield pa.RecordBatch.from_pydict({
                    "grp": pa.array([batch.column("grp")[k].as_py()] * len(row), pa.string()), "id": row.field("id"),
                    "pos": row.field("pos"), "leaf": row.field("digest"), "proof": pa.array(proofs, pa.binary()),
                    "folded": pa.array(roots, pa.binary())})
    return run


# ---- the tree, over tables -------------------------------------------------------------

def _numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with their place (``pos``) in their group (``grp``) and its size ``n``; the largest size.

    Rows are range-sorted and written. Sums are by sorted partition and group, so
    as many as there are partitions and groups.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    placed = written(placed, "merkle").withColumn("_part", F.shiftright("_id", ROW_BITS))
    earlier = Window.partitionBy("grp").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut(placed.groupBy("grp", "_part").agg(F.count("*").alias("_n"), F.min("_id").alias("_first")).select(
        "grp", "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("grp")).alias("n")))
    pos = (F.col("_before") + F.col("_id") - F.col("_first")).alias("pos")
    largest = sums.agg(F.max("n")).first()[0] or 0
    return placed.join(sums, ["grp", "_part"]).select(*rows.columns, pos, "n"), largest


def _chunked(nodes: DataFrame, size: int) -> DataFrame:
    """Nodes (``grp``, ``n``, ``pos``, ``id``, ``digest``, ``changed``) as chunks of ``size`` neighbours at most."""
    entry = F.struct("pos", "id", "digest", "changed").cast(NODE)
    return nodes.groupBy("grp", "n", F.floor(F.col("pos") / size).alias("chunk")).agg(F.collect_list(entry).alias("nodes"))


class Tree:
    """Passes of chunks from the leaves (``grp``, ``pos``, ``n``, ``id``, ``digest``, ``changed``) up to one node a group."""

    def __init__(self, leaves: DataFrame, largest: int, levels: int):
        self.levels, size = levels, ARITY ** levels
        small_batches(leaves.sparkSession)
        self.passes = [written(_chunked(leaves, size), "merkle")]
        while True:
            tops = self.passes[-1].mapInArrow(_digests(levels), "grp string, n bigint, chunk bigint, digest binary")
            if largest <= size:
                break
            largest = -(-largest // size)
            nodes = tops.select("grp", F.ceil(F.col("n") / size).alias("n"), F.col("chunk").alias("pos"), F.lit(None).alias("id"),
                                "digest", F.lit(None).alias("changed"))
            self.passes.append(written(_chunked(nodes, size), "merkle"))
        self.roots = written(tops.select("grp", "digest"), "merkle")

    def _with_paths(self, above: DataFrame) -> DataFrame:
        """The chunks of leaves with the siblings above them; ``above`` has those of each group's root."""
        found = above.select("grp", F.lit(0).cast("bigint").alias("chunk"), "path")
        for chunks in self.passes[:0:-1]:
            found = chunks.join(found, ["grp", "chunk"]).mapInArrow(_paths(self.levels), f"grp string, chunk bigint, path {PATH}")
        return self.passes[0].join(found, ["grp", "chunk"]).select("grp", "n", "nodes", "path")

    def paths(self, above: DataFrame) -> DataFrame:
        """Each leaf's siblings up to the top: (``grp``, place ``chunk``, ``path``)."""
        return self._with_paths(above).mapInArrow(_paths(self.levels), f"grp string, chunk bigint, path {PATH}")

    def folds(self, above: DataFrame) -> DataFrame:
        return self._with_paths(above).mapInArrow(
            _folds(self.levels), "grp string, id bigint, pos bigint, leaf binary, proof binary, folded binary")


def manifest(docs: DataFrame, columns: list[str], changed: dict[str, Column] | None = None, id_col: str = "doc_id",
             group_col: str = "source", levels: int = CHUNK_LEVELS) -> DataFrame:
    """A row for each of ``docs``: id, group, place in the group, ``leaf``, ``subroot``, ``root``, ``proof``, ``folded``.

    ``proof`` holds the digests (32 bytes each) of all siblings from the leaf to
    the root, level by level and left to right. ``folded`` is the root that
    follows from the proof when the leaf is made with ``changed`` columns in
    place of the given ones: it equals ``root`` where nothing has changed. Ids
    are whole numbers.
    """
    def own(name: str) -> Column:
        return F.col(f"`{name}`")

    group = own(group_col).cast("string")
    other = [(changed or {}).get(c, own(c)) for c in columns]
    leaves = written(docs.select(
        F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group)).alias("grp"), own(id_col).cast("bigint").alias("id"),
        leaf_of([own(c) for c in columns]).alias("digest"), leaf_of(other).alias("changed"),
        F.monotonically_increasing_id().alias("row")), "merkle")
    placed, largest = _numbered(leaves, ["grp", "id", "digest", "row"])
    tree = Tree(placed, largest, levels)
    groups = tree.roots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    ordered, count = _numbered(groups, ["grp", "name"])
    ordered = written(ordered, "merkle")
    whole = Tree(ordered.select("grp", "n", "pos", F.lit(None).alias("id"), "digest", F.lit(None).alias("changed")), count, levels)
    root = whole.roots.agg(F.max("digest").alias("root"))           # one row
    top = whole.roots.select("grp", F.array().cast(PATH).alias("path"))
    above = whole.paths(top).select(F.col("chunk").alias("pos"), "path").join(ordered, "pos").select(
        F.col("name").alias("grp"), "path", F.col("digest").alias("subroot"))
    above = written(above, "merkle")
    found = tree.folds(above).join(above.select("grp", "subroot"), "grp")
    return found.withColumn("root", root.scalar()).select(
        F.col("id").alias(id_col), F.when(F.col("grp") != "", F.substr("grp", F.lit(2))).alias(group_col), "pos", "leaf", "subroot",
        "root", "proof", "folded")
