"""Token counts of documents from flat token files without an index.

A file is a run of little-endian unsigned 16-bit integers: id + 1, and 0 after
each document. Blocks of a file are searched for the separator on their own;
documents that cross a border are put together by a prefix scan over the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tilldeck.llm.tokens import TEXT_BYTES, Encoder, tokenizer_path
from tilldeck.llm.words import chunks, column, whole_texts

BLOCK_BYTES = 1 << 20
_SEPARATOR = "\0\0"
_ENDS = "part int, block int, tokens long, ends array<long>"


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder.of(path, ordinary=True)
        for part in chunks(batches, "text", TEXT_BYTES, keep=True):
            flat = [
                (np.frombuffer(ids, dtype="<u4") + 1).astype("<u2").tobytes() for ids in encode(column(part, "text"))
            ]
            yield pa.RecordBatch.from_arrays([pa.array(flat, type=pa.binary())], names=["ids"])

    return run


def write_flat_tokens(
    docs: DataFrame, path: str, text_column: str = "text", tokenizer: str | None = None
) -> None:
    """One flat file per task, in the order of the rows. The vocabulary must have
    fewer than 65,535 ids. Null and empty texts are a separator alone.

    Spark's text writer puts its line separator, here the end-of-document number,
    behind the bytes of each row, on whatever file system ``path`` names.
    """
    tokenizer = tokenizer or tokenizer_path("byte_bpe_50k.json")
    ids = whole_texts(docs).select(F.col(text_column).cast("string").alias("text")).mapInArrow(_encoded(tokenizer), "ids binary")
    ids.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", _SEPARATOR).text(path)


def _separators(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    Encoder.release()
    for batch in batches:
        ids = [np.frombuffer(b, dtype="<u2") for b in column(batch, "bytes")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("part")),
                batch.column(batch.schema.get_field_index("block")),
                pa.array([len(i) for i in ids], type=pa.int64()),
                pa.array([np.flatnonzero(i == 0) for i in ids], type=pa.list_(pa.int64())),
            ],
            names=["part", "block", "tokens", "ends"],
        )


def document_token_counts(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document of the flat files in ``path``: ``part`` (number in
    the file's name), ``ordinal`` in the file, ``start`` (numbers before it),
    ``n_tokens`` without the separator, and ``closed``, false for a document that
    its file ends without one. An empty file has no document.

    A file is one row of Spark's reader, so it must stay below 2 GB; what a task
    computes on is a block.
    """
    if block_bytes % 2:
        raise ValueError("a block must hold whole numbers of two bytes")
    size = F.lit(block_bytes)
    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(F.length("content") / size).cast("int") - 1),
        lambda i: F.substring("content", i * size + 1, size),
    )
    files = (
        spark.read.format("binaryFile").load(path).where("length > 0")
        .select(F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int").alias("part"), "content")
    )
    found = files.select("part", F.posexplode(blocks).alias("block", "bytes")).mapInArrow(_separators, _ENDS)
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("part").orderBy(F.desc("block"))
    zero = F.lit(0).cast("long")
    placed = (
        found.withColumn("base", F.coalesce(F.sum("tokens").over(before), zero))
        .withColumn("ordinal", F.coalesce(F.sum(F.size("ends")).over(before), zero))
        .withColumn("ends", F.transform("ends", lambda e: e + F.col("base")))
        .withColumn("start", F.coalesce(F.max(F.array_max("ends") + 1).over(before), zero))
        .withColumn("final", F.row_number().over(ahead) == 1)
    )
    # The piece behind a file's last separator, if any, ends where the file does.
    rest = F.col("base") + F.col("tokens")
    last = F.coalesce(F.array_max("ends") + 1, F.col("start"))
    stops = F.when(F.col("final") & (last < rest), F.concat("ends", F.array(rest))).otherwise(F.col("ends"))
    starts = F.concat(F.array("start"), F.transform("ends", lambda e: e + 1))
    documents = F.transform(
        stops, lambda stop, i: F.struct(i.alias("i"), F.get(starts, i).alias("start"), stop.alias("stop"))
    )
    return placed.select("part", "ordinal", F.size("ends").alias("whole"), F.explode(documents).alias("d")).select(
        "part",
        (F.col("ordinal") + F.col("d.i")).alias("ordinal"),
        "d.start",
        (F.col("d.stop") - F.col("d.start")).alias("n_tokens"),
        (F.col("d.i") < F.col("whole")).alias("closed"),
    )
