"""Token counts from flat token files, found by a scan for end-of-document ids.

A flat token file is nothing but unsigned 16- or 32-bit ids, documents one after
another, each closed by an end id; no index says where they begin. Files are
read in blocks of equal length, in parallel. Each block's scan is one vectorised
comparison, which gives the lengths between separators; a prefix scan over the
block summaries then stitches documents that cross block boundaries. The scan sees
a few numbers for each block; the lengths stay where they are, and meet what the
scan found by (file, block).

A document may be longer than a block, or than many: its ids are counted block by
block and added up, so no task holds more than one block of ids.

Ids after a file's last separator form a last, unclosed document. Empty files
have no documents. Null and empty texts are written as the end id alone; rows
keep scan order, so repeated rows and null ids each have a place of their own.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from jobuse.llm import bpe
from jobuse.llm.common import small_batches, written
from jobuse.llm.pieces import flat_lists

BLOCK_TOKENS = 4 << 20


def _open_fs(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a Hadoop-style URI."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(uri)


def write(docs: DataFrame, folder: str, pieces: list[bytes], pattern: str, end_id: int,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode documents into flat files, one for each partition, in the order they are read.

    Returns the ledger ``file, ord, doc_id`` (document ids in file order), as
    written below ``folder``. File names are new for every attempt of a task and
    only finished attempts are in the ledger, so a lost executor leaves at most
    an orphan. Ids are 16 bits wide when the vocabulary allows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    width = "<u2" if max(len(pieces), end_id) < 1 << 16 else "<u4"
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    encoded = bpe.encode(rows, pieces, pattern).select("doc_id", "ids")

    def flush(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bin"
        fs, path = _open_fs(folder)
        fs.create_dir(path, recursive=True)
        at = 0
        with fs.open_output_stream(f"{path}/{name}") as out:
            for batch in batches:
                ids, lengths = flat_lists(batch.column("ids"))
                out.write(np.insert(ids, np.cumsum(lengths), end_id).astype(width).tobytes())
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([name] * len(lengths)), "ord": pa.array(np.arange(at, at + len(lengths))),
                    "doc_id": batch.column("doc_id")})
                at += len(lengths)

    encoded.mapInArrow(flush, "file string, ord long, doc_id long").write.parquet(f"{folder}/ledger")
    return spark.read.parquet(f"{folder}/ledger")


def list_files(spark: SparkSession, folder: str, pattern: str = "*.bin") -> DataFrame:
    """``file, bytes`` of the files below a folder; contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))


def _blocks(files: DataFrame, folder: str, width: str, end_id: int, block_tokens: int) -> DataFrame:
    """One summary for each block: ids, separators, ids after the last separator, lengths up to each separator."""
    size = np.dtype(width).itemsize
    step = block_tokens * size
    blocks = files.select("file", "bytes", F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(step))).alias("at"))
    blocks = blocks.repartition("file", "at")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open_fs(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{path}/{row['file']}") as source:
                    ids = np.frombuffer(source.read_at(min(step, row["bytes"] - row["at"]) // size * size, row["at"]), width)
                ends = np.flatnonzero(ids == end_id)
                lengths = np.diff(ends, prepend=-1)
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([row["file"]]), "at": pa.array([row["at"]]), "n_ids": pa.array([len(ids)]),
                    "n_ends": pa.array([len(ends)]), "tail": pa.array([len(ids) - 1 - int(ends[-1]) if len(ends) else len(ids)]),
                    "lengths": pa.array([lengths], pa.list_(pa.int64()))})

    return blocks.mapInArrow(scan, "file string, at long, n_ids long, n_ends long, tail long, lengths array<long>")


def count_tokens(spark: SparkSession, folder: str, width: str, end_id: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``file, ord, n_tokens``: ids of every document, its separator included."""
    def over(*keys: str | Column):
        return Window.partitionBy("file", *keys).orderBy("at")

    files = list_files(spark, folder)
    blocks = written(_blocks(files, folder, width, end_id, block_tokens), "blocks")     # read twice; 8 bytes a document before packing
    before = over().rowsBetween(Window.unboundedPreceding, -1)
    # A block's first document may have begun in earlier blocks: as far back as the last one with a separator.
    stitched = (blocks.select("file", "at", "n_ends", "tail")
                .withColumn("docs_before", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
                .withColumn("tail_before", F.coalesce(F.lag("tail").over(over()), F.lit(0)))
                .withColumn("group", F.coalesce(F.sum(F.signum("n_ends")).over(before), F.lit(0)))
                .withColumn("carried", F.sum("tail_before").over(over("group").rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("last", F.lead("at").over(over()).isNull()))
    # The group's first block brings the tail of the block that closed the group before.
    unclosed = F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.col("carried") + F.col("tail"))
    lengths = F.transform("lengths", lambda n, k: n + F.when(k == 0, F.col("carried")).otherwise(0))
    lengths = F.when(F.col("last") & (unclosed > 0), F.concat(lengths, F.array(unclosed))).otherwise(lengths)
    rows = blocks.select("file", "at", "lengths").join(stitched, ["file", "at"])
    return (rows.select("file", "docs_before", F.posexplode(lengths).alias("k", "n_tokens"))
            .select("file", (F.col("docs_before") + F.col("k")).alias("ord"), "n_tokens"))
