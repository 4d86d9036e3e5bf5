"""Corpus pipeline over ``documents``: each stage is one operator of ``tilldeck.llm``.

Every stage but the last returns the columns of ``documents`` and no others. Rows
without an id are never dropped by a stage that names documents by their ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilldeck.llm.decontaminate import benchmark_matches
from tilldeck.llm.graph import written
from tilldeck.llm.ngram_join import near_duplicate_classes
from tilldeck.llm.packing import pack_documents
from tilldeck.llm.queries import held_out
from tilldeck.llm.substring import remove_repeats
from tilldeck.llm.toxicity import THRESHOLD, fit, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Ids that may be sent to every executor: about 16 MB. More are joined by shuffle.
MOST_BROADCAST = 1_000_000


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the ids in ``dropped``; null ids stay."""
    dropped = written(dropped.select("doc_id").where("doc_id is not null").distinct(), "dropped")
    if dropped.count() <= MOST_BROADCAST:
        dropped = F.broadcast(dropped)
    return docs.select(*COLUMNS).join(dropped, "doc_id", "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(docs, labels.where(~held_out()))
    return toxicity(docs, model, carry=COLUMNS).where(F.col("score") < THRESHOLD).select(*COLUMNS)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents."""
    classes = near_duplicate_classes(docs)
    return _without(docs, classes.where("doc_id != component_id"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document holds."""
    out = remove_repeats(docs, carry=("lang", "source"))
    return out.select(
        "doc_id",
        F.col("kept_text").alias("text"),
        "lang",
        "source",
        F.length("kept_text").cast("long").alias("n_chars"),
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    found = benchmark_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.where("n_hit > 0"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram jaccard join", keep_one_of_near_duplicates),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

# Learned scores and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
