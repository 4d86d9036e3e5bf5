"""Token sequences of bounded length from documents, with little padding.

Bounded-space online packing: a partition keeps a fixed number of open windows
and places each piece best-fit. When a piece fits nowhere, the fullest window is
emitted. Windows still open at the end are merged across partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilldeck.llm.graph import written
from tilldeck.llm.tokens import TEXT_BYTES, Encoder, tokenizer_path
from tilldeck.llm.words import chunks, column, whole_texts

LENGTH = 2048
OPEN_WINDOWS = 32
# Free space of the fullest window from which on a piece is cut to fill it.
LEAST_CUT = 32
# Windows that one task merges.
MERGED = 20_000
_PIECES = (
    "node long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "open boolean, tokens binary"
)
_MOVES = "sequence_id long, target long, base long"


class _Windows:
    """The open windows of one partition; numbers rise from ``first``."""

    def __init__(self, first: int, length: int, most: int) -> None:
        self.next, self.length, self.most = first, length, most
        self.fill: dict[int, int] = {}
        self.closed: set[int] = set()

    def place(self, size: int, least_cut: int) -> tuple[int, int, int]:
        """Window, offset there and how much of ``size`` goes there."""
        fits = [(self.length - used, number) for number, used in self.fill.items() if self.length - used >= size]
        if fits:
            number = min(fits)[1]
        elif len(self.fill) < self.most:
            number = self.next
            self.next += 1
            self.fill[number] = 0
        else:
            number = max(self.fill, key=lambda n: (self.fill[n], -n))
            free = self.length - self.fill[number]
            if free < least_cut:
                self._emit(number)
                return self.place(size, least_cut)
        offset = self.fill[number]
        taken = min(size, self.length - offset)
        self.fill[number] += taken
        if self.fill[number] == self.length:
            self._emit(number)
        return number, offset, taken

    def _emit(self, number: int) -> None:
        del self.fill[number]
        self.closed.add(number)


def _pack(path: str, end: int, length: int, most: int, least_cut: int, keep: bool):
    tail = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder.of(path)
        windows = _Windows(TaskContext.get().partitionId() << 32, length, most)
        waiting: dict[int, list[tuple]] = {}
        for part in chunks(batches, "text", TEXT_BYTES, keep=True):
            rows = []
            for node, ids in zip(column(part, "node"), encode(column(part, "text")), strict=True):
                ids += tail
                total = len(ids) // 4
                start = 0
                while start < total:
                    # Whole windows first; the rest is placed best-fit.
                    size = min(length, total - start)
                    if size == length:
                        number, offset, taken = windows.next, 0, length
                        windows.next += 1
                        windows.closed.add(number)
                    else:
                        number, offset, taken = windows.place(size, least_cut)
                    piece = ids[4 * start : 4 * (start + taken)]
                    row = (node, start, taken, zlib.crc32(piece), total, number, offset, piece if keep else None)
                    waiting.setdefault(number, []).append(row)
                    start += taken
            for number in windows.closed:
                rows += waiting.pop(number)
            windows.closed.clear()
            if rows:
                yield _rows(rows, False)
        left = [row for group in waiting.values() for row in group]
        if left:
            yield _rows(left, True)

    return run


def _rows(rows: list[tuple], still_open: bool) -> pa.RecordBatch:
    *numbers, tokens = zip(*rows, strict=True)
    names = ["node", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    arrays = [pa.array(values, type=pa.int64()) for values in numbers]
    arrays += [pa.array([still_open] * len(rows)), pa.array(tokens, type=pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=[*names, "open", "tokens"])


def _merge(length: int):
    """Open windows put together, the fullest first, each where it fits best."""

    def run(table: pa.Table) -> pa.Table:
        found = sorted(zip(column(table, "fill"), column(table, "sequence_id"), strict=True), reverse=True)
        by_free: dict[int, list[list[int]]] = {}
        moves = []
        for fill, number in found:
            free = next((f for f in range(fill, length + 1) if by_free.get(f)), None)
            target, used = by_free[free].pop() if free is not None else (number, 0)
            moves.append((number, target, used))
            by_free.setdefault(length - used - fill, []).append([target, used + fill])
        numbers, targets, bases = zip(*moves, strict=True)
        return pa.table({"sequence_id": numbers, "target": targets, "base": bases})

    return run


def pack_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    end: int = 1,
    length: int = LENGTH,
    open_windows: int = OPEN_WINDOWS,
    least_cut: int = LEAST_CUT,
    keep_tokens: bool = False,
) -> DataFrame:
    """One row per piece of a document: id, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id`` and ``offset``, with ``keep_tokens`` also
    ``tokens`` (little-endian unsigned 32-bit ids).

    A document is its ids and ``end``; each id lies in one piece. A sequence holds
    at most ``length`` ids without gaps from offset 0 on. A document longer than
    that fills whole sequences first. Its rest goes to the open window it fills
    best; if it fits in none, it is cut to fill the fullest one, or, where less
    than ``least_cut`` ids are free there, that window is emitted with so much
    padding. Windows left open by all partitions are merged uncut.

    Null and empty texts are the end id alone. A null id is carried as such;
    repeated rows are packed once each. Other columns are not looked at.
    Memory: one chunk of texts and the pieces of the open windows.
    """
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    pieces = written(
        whole_texts(docs).select(F.col(id_column).cast("long").alias("node"), F.col(text_column).cast("string").alias("text"))
        .mapInArrow(_pack(path, end, length, open_windows, least_cut, keep_tokens), _PIECES),
        "pieces",
    )
    still = pieces.where("open").groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    groups = max(1, -(-still.count() // MERGED))
    moves = (
        still.groupBy(F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).alias("part"))
        .applyInArrow(_merge(length), _MOVES)
    )
    merged = (
        pieces.where("open")
        .join(moves, "sequence_id")
        .withColumn("sequence_id", F.col("target"))
        .withColumn("offset", F.col("offset") + F.col("base"))
        .select(*pieces.columns)
    )
    out = pieces.where("not open").union(merged).drop("open").withColumnRenamed("node", id_column)
    return out if keep_tokens else out.drop("tokens")
