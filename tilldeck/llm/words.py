"""Words of whole texts as numpy arrays: borders, hashes and rolling windows.

Texts arrive as UTF-8 bytes. All functions work on a *chunk*, a few megabytes of
consecutive documents, so a task's memory does not depend on its partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame

CHUNK_BYTES = 4 << 20
BATCH_ROWS = 2000
# A longer word is hashed by the library function instead of eight bytes a step.
LONG_WORD = 4096
_MIX_1, _MIX_2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


# Bytes of words that white space divides, and of words of letters and digits;
# every byte of a character beyond ASCII belongs to a word in both.
NOT_SPACE = ~_byte_class((0x20, 0x20), (0x09, 0x0D))
LETTER_DIGIT = _byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers in which every bit depends on every other."""
    values = (values ^ (values >> np.uint64(30))) * _MIX_1
    values = (values ^ (values >> np.uint64(27))) * _MIX_2
    return values ^ (values >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the window base and of its inverse, grown as needed."""

    up = _powers(_BASE, 1)
    down = _powers(_BASE_INVERSE, 1)

    @classmethod
    def upto(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < count:
            cls.up, cls.down = _powers(_BASE, 2 * count), _powers(_BASE_INVERSE, 2 * count)
        return cls.up[:count], cls.down[:count]


@dataclass
class Words:
    """``first[i]:first[i + 1]`` are the words of document ``i`` of the chunk."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    _hashes: np.ndarray | None = field(default=None, repr=False)

    @classmethod
    def of(cls, texts: list[bytes | None], letters: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
        texts = [text or b"" for text in texts]
        data = b"\n".join(texts) + b"\n"
        if lower:
            data = data.lower()  # A-Z only, as for any bytes
        inside = np.zeros(len(data) + 1, dtype=np.int8)
        inside[1:] = letters[np.frombuffer(data, dtype=np.uint8)]
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        bounds = np.cumsum([0] + [len(text) + 1 for text in texts])
        return cls(data, starts, ends, np.searchsorted(starts, bounds))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, eight bytes a step."""
        if self._hashes is None:
            padded = self.data + bytes(8)
            eight = np.ndarray(shape=(len(self.data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
            length = self.ends - self.starts
            out = mix(length.astype(np.uint64) + _STEP)
            left, at, which = length, self.starts, np.arange(len(length))
            short = left <= LONG_WORD
            left, at, which = left[short], at[short], which[short]
            while len(which):
                kept = np.minimum(left, 8).astype(np.uint64)
                part = eight[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - kept * np.uint64(8)))
                out[which] = mix((out[which] * np.uint64(3)) ^ part)
                more = left > 8
                left, at, which = left[more] - 8, at[more] + 8, which[more]
            for i in np.flatnonzero(~short):
                out[i] = xxhash.xxh64_intdigest(self.data[self.starts[i] : self.ends[i]])
            self._hashes = out
        return self._hashes

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every window of ``size`` words inside one document, and the
        chunk-wide index of its first word."""
        hashes = self.hashes()
        count = len(hashes) - size + 1
        if count <= 0:
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        up, down = _Powers.upto(len(hashes))
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(hashes * up)))
        values = mix((sums[size:] - sums[:-size]) * down[:count] + np.uint64(size))
        # A window may not cross into the next document.
        last = np.repeat(self.first[1:], self.counts)[:count]
        at = np.flatnonzero(np.arange(size, size + count) <= last)
        return values[at], at


def give_back() -> None:
    """Freed memory goes back to the system. Workers live on from stage to stage,
    and the allocators would keep the largest stage's share for each of them."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


# What tasks keep for later tasks of their worker, such as tokenizers.
KEPT: dict[str, object] = {}


def chunks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES, keep: bool = False
) -> Iterator[pa.RecordBatch]:
    """The same rows cut where their text reaches ``limit`` bytes. Without
    ``keep``, what an earlier operator's tasks left in the worker is dropped."""
    if not keep:
        KEPT.clear()
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0), dtype=np.int64)
        slot = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), len(sizes)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if high > low:
                yield batch.slice(low, high - low)
    give_back()


def whole_texts(df: DataFrame) -> DataFrame:
    """``df``, with batches of texts to Python kept to a few megabytes from here
    on; a batch is held several times, by Spark, by Arrow and as objects."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 2 * CHUNK_BYTES)
    return df


def column(batch: pa.RecordBatch | pa.Table, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def packed(batch: pa.RecordBatch | pa.Table, name: str, dtype: type) -> list[np.ndarray]:
    """A binary column as one array per row."""
    return [np.frombuffer(blob or b"", dtype=dtype) for blob in column(batch, name)]


def groups(df: DataFrame) -> int:
    """Buckets of a hash: two for each shuffle partition, whose number follows
    the input, so that a bucket fits into a task at any size."""
    return 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def planes(values: np.ndarray) -> bytes:
    """Small non-negative integers with their low and high bytes apart: the
    shuffle's compression then removes the zeros."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unplaned(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, dtype=np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def packed_ids(values: np.ndarray) -> bytes:
    """Ascending 64-bit ids as the first one and steps, in byte planes."""
    steps = np.diff(values, prepend=np.int64(0)).astype("<i8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked_ids(blob: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(blob, dtype=np.uint8).reshape(8, -1).T).view("<i8")
    return np.cumsum(steps.reshape(-1))


def blobs(table: pa.Table, name: str, dtype: type) -> np.ndarray:
    parts = packed(table, name, dtype)
    return np.concatenate(parts) if parts else np.empty(0, dtype=dtype)


def slices(order_by: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    kind = np.uint16 if buckets < 65_536 else np.uint32
    order = np.argsort(order_by.astype(kind), kind="stable")
    return order, np.searchsorted(order_by[order], np.arange(buckets + 1))


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))]
    arrays = [pa.array(values, type=kind) for values, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def table_of(rows: list[tuple], schema: str) -> pa.Table:
    give_back()
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    if not rows:
        return pa.table({n: pa.array([], type=kinds[k]) for n, k in (f.split() for f in schema.split(", "))})
    return pa.Table.from_batches([batch_of(rows, schema)])
