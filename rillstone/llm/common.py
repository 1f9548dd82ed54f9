"""Reading tables, working folders and word helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.session import shared_dir

# Fixed values of the contracts: a word is a run of characters other than these.
SPACE = "[ \\t-\\r]"
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column | str) -> Column:
    """The words of a text as an array; empty for null and blank texts."""
    text = F.col(text) if isinstance(text, str) else text
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def crc32_mod(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


class Workspace:
    """Tables written to the shared folder so that later jobs neither recompute nor hold them.

    They survive the loss of an executor. `drop` removes those that no later read needs.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = shared_dir(spark, purpose)

    def store(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


class WordHashes(dict):
    """64-bit hash of each word seen, looked up at C speed and emptied when it grows too large."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits depend on all bits (a finaliser of two multiplications)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` consecutive values; a shorter sequence is one run."""
    if not len(hashes):
        return hashes
    length = min(length, len(hashes))
    n = len(hashes) - length + 1
    total = np.full(n, length, np.uint64)
    for k in range(length):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return total


def by_key(batches: Iterator, key: str) -> Iterator:
    """Consecutive rows of equal key as one pyarrow table each; the input is sorted by the key.

    Only the rows of the key at hand are held, so a task's memory is that of its largest key.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    held: list = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        ends = np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)) + 1
        edges = [0, *ends.tolist(), batch.num_rows]
        for start, end in zip(edges[:-1], edges[1:]):
            value = keys[start].as_py()
            if held and value != current:
                yield pa.Table.from_batches(held)
                held = []
            current = value
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)
