"""Shared helpers of the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyprep.session import shared_dir

#: A word, as the queries of this subpackage count it: a run without ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Intermediate tables in the shared folder (``spark.checkpoint.dir``).

    ``cut`` writes a frame and reads it back: lineage ends there, so a lost
    executor never makes an earlier step run twice, and values that depend on
    the task (partition numbers) are fixed. ``drop`` removes a table that no
    later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, shared_dir(spark, f"llm-{name}")
        # a job's shuffle files go when it ends: what later steps need is in its table
        spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(conf).delete(p, True)


def sized(df: DataFrame, row_bytes: int, limit: int = 32 << 20) -> DataFrame:
    """``df``, a written table, to be broadcast if its counted rows stay under ``limit`` bytes.

    Beyond that the join shuffles both sides, which Spark may split on skew;
    the result is the same.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


# --- vectorised hashing of byte strings (numpy, 64-bit wrap-around) ---

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int = _BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])


POWERS = Powers()

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def prefix_hash(data: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """P with P[j] - P[i] = sum of (byte + 1) * base**position over [i, j)."""
    powers.grow(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[: len(data)], out=out[1:])
    return out


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word (run without ASCII blanks) of a UTF-8 text."""
    if not len(data):
        return np.empty(0, np.uint64)
    solid = np.concatenate([[False], ~_BLANK[data], [False]])
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    start, end = edge[::2], edge[1::2]
    p = prefix_hash(data)
    return mix64((p[end] - p[start]) * POWERS.down[start] + (end - start).astype(np.uint64))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of runs of ``width`` words; a shorter text is one shingle, none without words."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = mix64(out * np.uint64(3) + words[j:j + n])
    return out
