"""Helpers shared by the corpus operators: word splitting, table reading, result columns."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Word bytes after lower-casing A-Z: digits, a-z and everything above ASCII; the rest separates words.
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_WORD_BYTES = frozenset([*range(48, 58), *range(97, 123), *range(128, 256)])
_TO_WORDS = bytes(b if b in _WORD_BYTES else 32 for b in bytes(range(256)).translate(bytes.maketrans(_UPPER, _LOWER)))


def words_of(raw: bytes | None) -> list[bytes]:
    """Lower-cased words of a UTF-8 text; null and empty texts have none."""
    return raw.translate(_TO_WORDS).split() if raw else []


def utf8(name: str) -> Column:
    """A text column as its UTF-8 bytes, so that tasks need not decode it."""
    return F.col(name).cast("binary")


def fresh(label: str) -> str:
    """A column name that no input has."""
    return f"_{label}_{uuid.uuid4().hex[:8]}"


def add_struct(df: DataFrame, value: Column, fields: list[str]) -> DataFrame:
    """Add the fields of one struct column. Input columns of the same name are replaced."""
    held = fresh("held")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in fields]
    return df.withColumn(held, value).select(*kept, *[F.col(f"{held}.{f}").alias(f) for f in fields])


def folded(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Mix two arrays of 64-bit numbers into one."""
    with np.errstate(over="ignore"):
        x = low ^ (high + np.uint64(0x9E3779B97F4A7C15) + (low << np.uint64(6)) + (low >> np.uint64(2)))
    return mixed(x)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (a published finaliser; the constants are its fixed values)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def in_fit_fold(id_col: Column) -> Column:
    """Rows that models may learn from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4, F.lit(2)) != 2


#: Rows of an Arrow batch between the JVM and Python where the session does not say otherwise: rows hold whole texts.
BATCH_ROWS = "2000"
BATCH_CONF, DEFAULT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def table(spark, folder: str, name: str) -> DataFrame:
    """A given table. A session that still has the default size of Arrow batches gets smaller ones, as texts are long."""
    if spark.conf.get(BATCH_CONF, DEFAULT_ROWS) == DEFAULT_ROWS:
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def release() -> None:
    """Give freed memory back to the machine: workers are used again, and share it with the others. Where the C library cannot, nothing happens."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def copied(array: pa.Array) -> pa.Array:
    """The same values in memory of their own: a slice of a batch would hold all columns of the batch."""
    return array.take(pa.array(np.arange(len(array))))


#: Measured rows of a table with one row per key that a join may broadcast; beyond it only keys with many rows are.
BROADCAST_KEYS, HOT_KEY_ROWS = 500_000, 1_000_000


def join_per_key(rows: DataFrame, keyed: DataFrame, left: Column, right: str, weight: str) -> DataFrame:
    """Join a stored table that has one row for each key of ``rows`` (nulls are a key, too), with its number of rows in ``weight``.

    A key may have a third of all rows. A table of few rows, as counted, is broadcast; of a larger one only the keys with more than
    ``HOT_KEY_ROWS`` rows, of which there are at most ``rows / HOT_KEY_ROWS``, and the others are shuffled.
    """
    same = left.eqNullSafe(F.col(right))
    if keyed.count() <= BROADCAST_KEYS:
        return rows.join(F.broadcast(keyed), same)
    hot, other = keyed.filter(F.col(weight) > HOT_KEY_ROWS), keyed.filter(F.col(weight) <= HOT_KEY_ROWS)
    cold = rows.join(F.broadcast(hot.select(right)), same, "left_anti")
    return rows.join(F.broadcast(hot), same).unionByName(cold.join(other, same))
