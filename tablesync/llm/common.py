"""Text rules and small helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A-Z and a-z, the only letters whose case is changed.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Bytes of text that a Python step works on at once.
SLICE_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by name, whatever characters the names hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    `lower` is the faster way to the same result if all characters are ASCII.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def unit_interval(*parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of the digest of the parts; nulls count as a text of their own."""
    joined = F.concat_ws("\u0001", *(F.coalesce(p.cast("string"), F.lit("\u0000")) for p in parts))
    bits = F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("bigint")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """`mapInArrow` with this package's folder on the workers' import path, and for column names
    of any characters.

    Where executors do not share that folder, the package comes with the job (`--py-files`).
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = df.sparkSession.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    names, module = df.columns, function.__module__

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept_by_others(module)
        try:
            yield from function(batch.rename_columns(names) for batch in batches)
        finally:
            release_memory()

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(renamed, schema)


_KEPT: dict[str, dict] = {}


def kept_between_tasks(module: str) -> dict:
    """A worker's memory of what the tasks of one module need again, until another module's task runs there."""
    return _KEPT.setdefault(module, {})


def drop_kept_by_others(module: str) -> None:
    """Empty what tasks of other modules have left in this worker, which counts against this task's memory."""
    for owner, kept in _KEPT.items():
        if owner != module and kept:
            kept.clear()
            gc.collect()
            release_memory()


def release_memory() -> None:
    """Hand memory that a task no longer uses back to the system: workers stay for further tasks, of
    other operators too, and an idle one should not keep the peak of its last task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def byte_slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with up to `limit` bytes of text; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_TO_LOWER = bytes(b + 32 if ord("A") <= b <= ord("Z") else b for b in range(256))

#: Words from so many bytes on are hashed apart, one by one.
LONG_WORD = 1024
#: Words hashed at once.
WORDS_AT_ONCE = 100_000
#: Masks of the lowest 0 to 8 bytes.
_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of the runs of bytes, eight bytes a step; eight bytes must follow the last run.

    Each step mixes the bytes in and adds them to what comes out, so no bytes can be solved for that
    lead back to a given state, and two words of equal length share no pattern that cancels.
    """
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    value = mix64(size.astype(np.uint64) + np.uint64(_MULTIPLIER))
    left, rows, at = size, np.arange(len(size)), start
    while len(rows):
        bytes_ = eights[at] & _BYTES[np.minimum(left, 8)]
        with np.errstate(over="ignore"):
            state = value[rows]
            value[rows] = mix64(state ^ bytes_) + bytes_ * np.uint64(_MULTIPLIER) + (state >> np.uint64(17))
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    return mix64(value)


#: For each byte whether it parts words: ASCII white space, or all ASCII but letters and digits.
WHITE_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
NOT_ALPHANUMERIC = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


class Words:
    """The words of a run of texts: A-Z lower-cased, cut at the bytes `gaps`.

    `data` holds the bytes of all texts, a space after each; word w is `data[start[w]:end[w]]`
    and belongs to text `owner[w]`. `first[t]:first[t + 1]` are the words of text t.
    """

    def __init__(self, texts: pa.Array, gaps: np.ndarray = WHITE_SPACE):
        listed = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary()).to_pylist()
        self.texts = len(listed)
        lengths = np.array([len(text) for text in listed], np.int64)
        self.data = np.frombuffer((b" ".join(listed) + b" " * bool(listed)).translate(_TO_LOWER), np.uint8)
        self.text_start = np.cumsum(lengths) - lengths + np.arange(self.texts)
        edge = np.flatnonzero(np.diff(np.r_[True, gaps[self.data], True].astype(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.start, np.r_[self.text_start, len(self.data)])
        self.owner = np.repeat(np.arange(self.texts), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same wherever the word stands."""
        out = np.empty(len(self.start), np.uint64)
        size = self.end - self.start
        data = np.concatenate([self.data, np.zeros(8, np.uint8)])
        for at in range(0, len(out), WORDS_AT_ONCE):
            part = slice(at, at + WORDS_AT_ONCE)
            out[part] = _hashes(data, self.start[part], np.where(size[part] < LONG_WORD, size[part], 0))
        for word in np.flatnonzero(size >= LONG_WORD):
            digest = hashlib.blake2b(data[self.start[word] : self.end[word]].tobytes(), digest_size=8).digest()
            out[word] = int.from_bytes(digest, "little")
        return out

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of `size` words, and the text each is from.

        A text with fewer words, but at least one, has its whole sequence as its only shingle.
        """
        words, counts = self.hashes(), np.diff(self.first)
        runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        owner = np.repeat(np.arange(self.texts), runs)
        begin = np.arange(len(owner)) + np.repeat(self.first[:-1] - np.r_[0, np.cumsum(runs)[:-1]], runs)
        value = np.full(len(owner), size, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                inside = k < counts[owner]
                word = words[np.minimum(begin + k, max(len(words) - 1, 0))] if len(words) else words[:0]
                step = mix64(value * np.uint64(_MULTIPLIER) + word)
                value = np.where(inside, step, value)
        return value, owner
