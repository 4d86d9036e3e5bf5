"""Compressed token files: documents' ids in ascending document order.

A file is a run of frames, each ended by a line feed: magic, lengths of its
parts, a crc32 over the directory, the directory (document ids and numbers of
tokens) and the coded blocks. Frames and blocks are independent of each other.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilldeck.llm.coder import BLOCK_IDS, LANES, decode_blocks, encode_blocks, split_block
from tilldeck.llm.graph import written
from tilldeck.llm.tokens import TEXT_BYTES, Encoder, tokenizer_path
from tilldeck.llm.words import chunks, column, whole_texts

# Token ids of one frame: as many blocks as are coded side by side.
FRAME_IDS = LANES * BLOCK_IDS
MAGIC = b"TKF1"
_HEADER = "<4sIQIQ"
_DOCUMENTS = "part int, node long, base long, n_tokens long, ids_crc32 long, ids binary"


def _frame(nodes: list[int | None], documents: list[bytes], block_ids: int) -> bytes:
    known = np.array([n is not None for n in nodes])
    numbers = np.array([n or 0 for n in nodes], dtype="<i8")
    sizes = np.array([len(d) // 4 for d in documents], dtype="<u4")
    directory = zlib.compress(known.tobytes() + numbers.tobytes() + sizes.tobytes(), 1)
    flat = np.frombuffer(b"".join(documents), dtype="<u4")
    blocks = b"".join(encode_blocks([flat[i : i + block_ids] for i in range(0, len(flat), block_ids)]))
    head = struct.pack(_HEADER, MAGIC, len(nodes), len(directory), zlib.crc32(directory), len(blocks))
    return head + directory + blocks


def read_frames(data: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Document ids, their numbers of tokens and all their token ids, by frame.
    A wrong mark, checksum or length is an error."""
    at = 0
    while at < len(data):
        magic, count, size, check, coded = struct.unpack_from(_HEADER, data, at)
        at += struct.calcsize(_HEADER)
        directory = data[at : at + size]
        if magic != MAGIC or zlib.crc32(directory) != check:
            raise ValueError("a frame of the token file is damaged")
        plain = zlib.decompress(directory)
        known = np.frombuffer(plain, dtype=bool, count=count)
        nodes = np.frombuffer(plain, dtype="<i8", count=count, offset=count)
        sizes = np.frombuffer(plain, dtype="<u4", count=count, offset=9 * count).astype(np.int64)
        at += size
        end, blocks = at + coded, []
        while at < end:
            block, at = split_block(data, at)
            blocks.append(block)
        ids = np.concatenate(decode_blocks(blocks)) if blocks else np.empty(0, dtype=np.uint32)
        if at != end or len(ids) != sizes.sum() or data[end : end + 1] != b"\n":
            raise ValueError("a frame of the token file has the wrong length")
        at += 1
        yield [int(n) if k else None for n, k in zip(nodes, known, strict=True)], sizes, ids


def _one(frame: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([frame], type=pa.binary())], names=["frame"])


def _encoded(path: str, end: int, block_ids: int):
    tail = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder.of(path)
        nodes: list[int | None] = []
        documents: list[bytes] = []
        held = 0
        for part in chunks(batches, "text", TEXT_BYTES, keep=True):
            found = [ids + tail for ids in encode(column(part, "text"))]
            nodes += column(part, "node")
            documents += found
            held += sum(map(len, found)) // 4
            if held >= FRAME_IDS:
                yield _one(_frame(nodes, documents, block_ids))
                nodes, documents, held = [], [], 0
        if nodes:
            yield _one(_frame(nodes, documents, block_ids))

    return run


def _decoded(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Encoder.release()
        for batch in batches:
            for part, data in zip(column(batch, "part"), column(batch, "content"), strict=True):
                base = 0
                for nodes, sizes, ids in read_frames(data):
                    cuts = np.concatenate(([0], np.cumsum(sizes)))
                    flat = ids.astype("<u4").tobytes()
                    documents = [flat[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part] * len(nodes), type=pa.int32()),
                            pa.array(nodes, type=pa.int64()),
                            pa.array(base + cuts[:-1], type=pa.int64()),
                            pa.array(sizes, type=pa.int64()),
                            pa.array([zlib.crc32(d) for d in documents], type=pa.int64()),
                            pa.array(documents if keep else [None] * len(nodes), type=pa.binary()),
                        ],
                        names=["part", "node", "base", "n_tokens", "ids_crc32", "ids"],
                    )
                    base += int(cuts[-1])

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    end: int = 0,
    block_ids: int = BLOCK_IDS,
) -> None:
    """One file per range of document ids, the ranges in the order of the files'
    part numbers. A document is its ids and ``end``; null and empty texts are
    ``end`` alone. Null document ids come first, repeated ones in the order of
    their texts. Other columns are not looked at.

    Texts are sorted by id through one shuffle. Spark's text writer puts the
    frames' bytes on whatever file system ``path`` names.
    """
    tokenizer = tokenizer or tokenizer_path("byte_bpe_50k.json")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frames = (
        whole_texts(docs).select(F.col(id_column).cast("long").alias("node"), F.col(text_column).cast("string").alias("text"))
        .repartitionByRange(parts, "node")
        .sortWithinPartitions("node", "text")
        .mapInArrow(_encoded(tokenizer, end, block_ids), "frame binary")
    )
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def read_token_files(spark: SparkSession, path: str, id_column: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """One row per document: id, ``start`` (token ids of all documents before it),
    ``n_tokens``, ``ids_crc32``, with ``keep_ids`` also ``ids`` (little-endian
    unsigned 32-bit). Checksums of all blocks are verified.

    A file is one row of Spark's reader and must stay below 2 GB.
    """
    files = (
        spark.read.format("binaryFile").load(path).where("length > 0")
        .select(F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int").alias("part"), "content")
    )
    # Written out: decoding is the costly part and both uses below need it.
    documents = written(files.mapInArrow(_decoded(keep_ids), _DOCUMENTS), "decoded")
    # One row per file; their running total is the only thing in a single task.
    totals = documents.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("offset"))
    out = documents.join(offsets, "part").select(
        F.col("node").alias(id_column), (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
    return out if keep_ids else out.drop("ids")
