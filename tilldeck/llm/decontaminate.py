"""Benchmark passages in training texts, found by a positional inverted index.

The index is distributed by document: each segment, a few megabytes of texts,
keeps for every term the places where it occurs. A phrase is looked up from its
rarest term on: that term's places, moved back by its offset in the phrase, are
intersected with the moved lists of the next rarer terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilldeck.llm.graph import written
from tilldeck.llm.words import LETTER_DIGIT, Words, batch_of, chunks, column, whole_texts

WINDOW = 10
# Texts of one index segment; a segment is one row.
SEGMENT_BYTES = 8 << 20
# Test items searched at once: what a search task holds besides its segment.
ITEMS_PER_BLOCK = 20_000
_SEGMENTS = "segment long, ids binary, first binary, terms binary, lists binary, places binary"
_MATCHES = (
    "segment long, place long, node long, n_words long, spans array<struct<item:string,start:long,stop:long>>"
)


def _words(texts: list[bytes | None]) -> Words:
    return Words.of(texts, letters=LETTER_DIGIT, lower=True)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of all terms: sorted term hashes, where each list begins, and the
    places (word numbers within the segment), ascending in each list."""
    segment = TaskContext.get().partitionId() << 32
    for part in chunks(batches, "text", SEGMENT_BYTES):
        segment += 1
        words = _words(column(part, "text"))
        hashes = words.hashes()
        order = np.argsort(hashes, kind="stable").astype(np.uint32)
        terms, lists = np.unique(hashes[order], return_index=True)
        ids = column(part, "node")
        known = np.array([i is not None for i in ids])
        row = (
            segment,
            np.stack((np.array([i or 0 for i in ids], dtype=np.int64), known), axis=1).astype(np.int64).tobytes(),
            words.first.astype(np.uint32).tobytes(),
            terms.tobytes(),
            np.append(lists, len(order)).astype(np.uint32).tobytes(),
            order.tobytes(),
        )
        yield batch_of([row], _SEGMENTS)


def _phrases(items: list[tuple[str, bytes | None]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct phrases as rows of term hashes, their lengths and the items that
    hold them (pairs of phrase and item number)."""
    words = _words([text for _, text in items])
    found: dict[bytes, int] = {}
    rows, lengths, holders = [], [], []
    for i, count in enumerate(words.counts.tolist()):
        own = words.hashes()[words.first[i] : words.first[i + 1]]
        size = min(count, window)
        for start in range(count - size + 1) if size else ():
            phrase = own[start : start + size]
            place = found.setdefault(phrase.tobytes(), len(rows))
            if place == len(rows):
                rows.append(np.concatenate((phrase, np.zeros(window - size, dtype=np.uint64))))
                lengths.append(size)
            holders.append((place, i))
    if not rows:
        return np.empty((0, window), np.uint64), np.empty(0, np.int64), np.empty((0, 2), np.int64)
    return np.array(rows), np.array(lengths), np.unique(np.array(holders), axis=0)


def _places(
    phrases: np.ndarray, lengths: np.ndarray, terms: np.ndarray, lists: np.ndarray, places: np.ndarray, slack: int
) -> Iterator[tuple[int, np.ndarray]]:
    """Phrase number and its start places, for phrases that occur in the segment.

    ``slack`` lets every term stand up to that many words after its place."""
    if not len(terms):
        return
    at = np.minimum(np.searchsorted(terms, phrases), len(terms) - 1)
    real = np.arange(phrases.shape[1]) < lengths[:, None]
    here = ((terms[at] == phrases) | ~real).all(axis=1)
    sizes = np.where(real, lists[at + 1] - lists[at], np.iinfo(np.int64).max)
    for p in np.flatnonzero(here):
        offsets = np.argsort(sizes[p], kind="stable")[: lengths[p]]
        starts = None
        for offset in offsets.tolist():
            term = at[p, offset]
            own = places[lists[term] : lists[term + 1]].astype(np.int64) - offset
            if starts is None:
                starts = np.unique(own[:, None] - np.arange(slack + 1)) if slack else own
            else:
                gap = own[np.minimum(np.searchsorted(own, starts), len(own) - 1)] - starts
                starts = starts[(gap >= 0) & (gap <= slack)]
            if not len(starts):
                break
        if len(starts) and (starts := starts[starts >= 0]).size:
            yield int(p), starts


def _search(window: int, slack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, tuple] = {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] not in asked:
                    asked.clear()
                    items = [(i["item"], i["text"]) for i in row["items"]]
                    asked[row["block"]] = ([name for name, _ in items], *_phrases(items, window))
                names, phrases, lengths, holders = asked[row["block"]]
                ids = np.frombuffer(row["ids"], dtype=np.int64).reshape(-1, 2)
                first = np.frombuffer(row["first"], dtype=np.uint32).astype(np.int64)
                lists = np.frombuffer(row["lists"], dtype=np.uint32).astype(np.int64)
                terms = np.frombuffer(row["terms"], dtype=np.uint64)
                places = np.frombuffer(row["places"], dtype=np.uint32)
                spans: list[list] = [[] for _ in ids]
                for p, starts in _places(phrases, lengths, terms, lists, places, slack):
                    stops = starts + lengths[p] + slack
                    doc = np.searchsorted(first, starts, side="right") - 1
                    inside = stops - slack <= first[doc + 1]
                    stops = np.minimum(stops, first[doc + 1])
                    own = holders[np.searchsorted(holders[:, 0], p) : np.searchsorted(holders[:, 0], p + 1), 1]
                    for d, a, b in zip(doc[inside], starts[inside], stops[inside], strict=True):
                        for i in own:
                            spans[d].append({"item": names[i], "start": int(a - first[d]), "stop": int(b - first[d])})
                counts = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), row["segment"]), type=pa.int64()),
                        pa.array(np.arange(len(ids)), type=pa.int64()),
                        pa.array([int(i) if known else None for i, known in ids], type=pa.int64()),
                        pa.array(counts, type=pa.int64()),
                        pa.array(
                            spans,
                            type=pa.list_(
                                pa.struct([("item", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])
                            ),
                        ),
                    ],
                    names=["segment", "place", "node", "n_words", "spans"],
                )

    return run


def _covered(spans: str) -> str:
    """SQL for the number of words that lie in any span; overlaps count once."""
    return f"""aggregate(array_sort(transform({spans}, s -> struct(s.start, s.stop))),
        struct(0L AS hit, 0L AS upto),
        (a, s) -> struct(a.hit + greatest(0L, s.stop - greatest(a.upto, s.start)) AS hit,
                         greatest(a.upto, s.stop) AS upto),
        a -> a.hit)"""


def benchmark_matches(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    slack: int = 0,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit``, ``items`` and ``spans``.

    Words are runs of letters, digits and characters beyond ASCII, A-Z
    lower-cased. A phrase is ``window`` consecutive words of an item, or all
    words of a shorter one. ``spans`` (item, start, stop; in words) lists the
    occurrences of phrases, ``n_hit`` counts words inside any, ``items`` holds the
    items with occurrences, as sorted strings. With ``slack`` > 0 each word of a
    phrase may stand up to so many words late, which finds proximity matches.

    Null and empty texts have no words, null items no phrase; items with a null
    id are left out. A null document id is returned as such. Repeated rows give
    repeated results. Other columns are not looked at. Terms are compared by
    64-bit hashes.

    The index is written to the shared scratch folder and never shuffled. Items
    are searched in blocks of bounded size; several blocks meet once per
    document, in a grouping by segment and place.
    """
    segments = written(
        whole_texts(docs).select(
            F.col(id_column).cast("long").alias("node"), F.col(text_column).cast("binary").alias("text")
        ).mapInArrow(_segments, _SEGMENTS),
        "segments",
    )
    asked = items.select(
        F.col(item_column).cast("string").alias("item"), F.col(item_text_column).cast("binary").alias("text")
    ).where("item is not null")
    count = asked.count()
    blocks = max(1, -(-count // ITEMS_PER_BLOCK))
    parts = written(
        asked.groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("item", "text"))).alias("items")
        ),
        "items",
    )
    searched = (
        segments.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .join(parts, "block", "left")
        .withColumn("items", F.coalesce("items", F.array().cast(parts.schema["items"].dataType)))
        .mapInArrow(_search(window, slack), _MATCHES)
    )
    if blocks > 1:
        searched = searched.groupBy("segment", "place", "node", "n_words").agg(
            F.flatten(F.collect_list("spans")).alias("spans")
        )
    return searched.select(
        F.col("node").alias(id_column),
        "n_words",
        F.expr(_covered("spans")).alias("n_hit"),
        F.expr("array_sort(array_distinct(spans.item))").alias("items"),
        "spans",
    )
