"""What the operators share: scratch tables, Arrow limits and word hashing."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Rows in an Arrow batch. Texts reach 100 KB and more, so that batches stay at some tens of MB.
BATCH_ROWS = 500


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir. Where it is unset, a temporary folder
    will do if everything runs in one process; a cluster has to name one."""
    sc = spark.sparkContext
    have = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    known = sc._jsc.sc().getCheckpointDir()
    if have is None and known.isDefined():
        have = known.get().rsplit("/", 1)[0]
    if have is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        have = "file://" + tempfile.mkdtemp(prefix="shared-")
    if known.isEmpty():
        sc.setCheckpointDir(have)
    return have


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lowers the session's Arrow batch size to `rows`; a smaller setting is kept."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) <= 0 or int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of any store that Spark knows; what cannot be deleted stays."""
    with contextlib.suppress(Exception):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """The session's setting until the block ends."""
    was = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


class Scratch:
    """Parquet tables in the shared folder that live until the operator returns."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """`df` as a table. What was shuffled for it goes when it is written, not when the driver happens to collect garbage."""
        path = f"{self.root}/{name}"
        with setting(self.spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        remove(self.spark, f"{self.root}/{name}" if name else self.root)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """What is written here is gone when the block ends: let a checkpoint() or a fresh table outlive it."""
    small_batches(spark)
    s = Scratch(spark)
    try:
        yield s
    finally:
        s.drop()


def kept_table(df: DataFrame) -> DataFrame:
    """`df` as a table in the shared folder that a result goes on reading; it goes with the driver's process."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", "zstd").parquet(path)
    atexit.register(remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class HashCache(dict):
    """word (bytes) -> 64-bit hash; emptied when it reaches its bound, so a worker's memory stays bounded."""

    BOUND = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


WORD_HASHES = HashCache()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose bits all depend on all bits (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that start at each place (fewer places than words by n - 1)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = h[:m].copy()
    for i in range(1, n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += h[i : i + m]
    return mixed(out)
