"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import threading
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import scratch_path, ship_package

#: the bytes [\x20\x09-\x0D]; bytes.split() and bytes.strip() use just these
SPACES = b" \t\n\x0b\x0c\r"


#: rows of texts that go to a Python worker at once, where the session doesn't say otherwise
BATCH_ROWS = 2000


def steady(spark: SparkSession) -> None:
    """Makes a session ready for these operators: their code is shipped, and
    Spark's batches of 10,000 rows, which the executor and its workers would
    hold at once, become smaller (texts are long rows)."""
    ship_package(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    steady(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` as Parquet below the shared checkpoint folder and reads it
    again: cuts the lineage and lets several later stages read the result of
    a costly one. A lost executor costs no recomputation of it.

    Spark deletes the shuffle files of a finished job when the driver's JVM
    collects the objects that stand for them; that is asked for here, so that
    an operator of several steps needs the disk of its largest step only."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


_HELD: dict = {}
_USED = [0.0]
_WATCH: list[threading.Thread] = []
#: seconds after which an idle Python worker gives back what it holds
IDLE = 2.0


def held(key, make):
    """What a Python worker keeps between batches and tasks: one thing at a
    time, so that the models of several stages don't add up in its memory, and
    nothing once it has been idle for `IDLE` seconds."""
    if key not in _HELD:
        if _HELD:
            _HELD.clear()
            give_back()
        _HELD[key] = make()
    used()
    return _HELD[key]


def give_back() -> None:
    """Freed memory goes back to the system: Arrow and glibc keep it else."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def used() -> None:
    """Marks this worker as busy. A thread that ends by itself waits until it
    is idle (the worker then waits for its next task) and empties it."""
    _USED[0] = time.monotonic()
    if not _WATCH or not _WATCH[0].is_alive():
        _WATCH[:] = [threading.Thread(target=_watch, daemon=True)]
        _WATCH[0].start()


def _watch() -> None:
    while time.monotonic() - _USED[0] < IDLE:
        time.sleep(IDLE / 4)
    _HELD.clear()
    give_back()


def others(df: DataFrame, new: list[str]) -> list[str]:
    """The columns of df that new ones of these names don't replace."""
    taken = {c.lower() for c in new}
    return [f"`{c}`" for c in df.columns if c.lower() not in taken]


def blobs(arr: pa.Array, rows: int = 256) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a string array, a few rows at a time (so that a
    batch of long texts is never held twice)."""
    used()
    for i in range(0, len(arr), rows):
        yield from arr.slice(i, rows).cast(pa.binary()).to_pylist()


def slices(arr: pa.Array, limit: int = 1 << 20) -> Iterator[list[bytes]]:
    """Texts in runs of about `limit` bytes; null counts as empty."""
    run, size = [], 0
    for text in blobs(arr):
        run.append(text or b"")
        size += len(run[-1])
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


def lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """A list array from the length of each list and all values in turn."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def remainder_is_one(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text leaves 1 when divided by n (null id: no)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % n == 1, F.lit(False))


class PrefixHash:
    """Polynomial hashes modulo 2**64 of any byte ranges of one buffer, from
    one pass of prefix sums: hash(i, j) = (S[j] - S[i]) * base**-i."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)
    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    #: one fixed pseudo-random 64-bit value for each byte
    VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @classmethod
    def powers(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        size = 1 << max(16, int(n).bit_length())
        if size not in cls._powers:
            both = []
            for base in (cls.BASE, cls.INVERSE):
                step = np.full(size, base, np.uint64)
                step[0] = 1
                both.append(np.multiply.accumulate(step))
            cls._powers.clear()
            cls._powers[size] = (both[0], both[1])
        return cls._powers[size]

    def __init__(self, data: np.ndarray):
        forth, self.back = self.powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.VALUES[data] * forth[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all k-byte strings, by start."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[k:] - self.sums[:n]) * self.back[:n])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (an invertible mixing)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
