"""Helpers shared by the training-data operators: inputs, staged tables, words and shingles.

Words are maximal runs of bytes other than ASCII white space; only A-Z are
lower-cased. Word sequences become shingles of 64-bit hashes, so a set of
shingles is a sorted array of unsigned integers.
"""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

# Fixed odd multipliers and the finalizer of a public 64-bit integer mix.
MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xFF51AFD7ED558CCD)
MIX_C = np.uint64(0xC4CEB9FE1A85EC53)
SHIFT = np.uint64(33)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STAGED: list[str] = []  # folders that this process has named and not released


def staged_path(spark: SparkSession, name: str) -> str:
    """A new folder on the storage that all executors share."""
    _STAGED.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}")
    return _STAGED[-1]


def release(spark: SparkSession) -> int:
    """Delete the staged folders of this process, once no result that reads them is needed any more;
    returns how many there were."""
    count = 0
    while _STAGED:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        count += folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return count


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to shared storage and read it back: the lineage ends at files
    that survive a lost executor, and later steps do not compute it again."""
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def one_per_id(rows: DataFrame, *columns: str) -> DataFrame:
    """(text, *columns): of the rows of each id the one whose text has the least hash. A
    repeated id is reduced before the shuffle."""
    return (rows.groupBy("id", *columns).agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
            .select("one.text", *columns))


COPIES_TOGETHER = 10_000  # copies of a row that one task numbers


def numbered_copies(rows: DataFrame) -> DataFrame:
    """The rows with `copy`, which numbers equal rows from 1 on.

    Equal rows are counted over all input splits first, so the numbers do not
    depend on how the input is split; the counts of a hot row go to chunks that
    are dealt out, so no task makes all its copies.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    first, last = F.col("chunk") * COPIES_TOGETHER + 1, F.least((F.col("chunk") + 1) * COPIES_TOGETHER, "copies")
    few = counted.filter(F.col("copies") <= COPIES_TOGETHER).withColumn("chunk", F.lit(0).cast("long"))
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES_TOGETHER))
    many = counted.filter(F.col("copies") > COPIES_TOGETHER).withColumn("chunk", F.explode(chunks)) \
        .repartition(*rows.columns, "chunk")
    return few.unionByName(many).withColumn("copy", F.explode(F.sequence(first, last))).select(*rows.columns, "copy")


def is_learning_row(doc_id: Column) -> Column:
    """Rows whose labels may be learned from; the others are held out."""
    return ~is_held_out(doc_id)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class WordHashes(dict):
    """Hash per word, remembered up to a fixed number of words."""

    limit = 1 << 19

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> SHIFT)) * MIX_B
    values = (values ^ (values >> SHIFT)) * MIX_C
    return values ^ (values >> SHIFT)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per window of `size` consecutive words, in text order."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:count].copy()
    for k in range(1, size):
        total = total * MIX_A + hashes[k:k + count]
    return mixed(total)


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles; a shorter sequence is one shingle as a whole, none is empty."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    windows = window_hashes(hashes, min(size, len(hashes)))
    if len(hashes) < size:  # keep short sequences apart from longer windows
        windows = mixed(windows + np.uint64(len(hashes)))
    return np.unique(windows)


def binary_slices(column) -> list[bytes]:
    """The values of a binary Arrow column, null read as empty."""
    return [b"" if x is None else x for x in column.to_pylist()]


def list_array(pa, parts: list[np.ndarray], kind):
    """An Arrow list column from one numpy array per row."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))
