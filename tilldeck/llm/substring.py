"""Removal of word passages that occur earlier in the corpus.

Fixed-block anchors: every document is cut into non-overlapping blocks of half a
window. A repeat of a whole window contains an aligned block of its earlier
occurrence, so probing the block index with every rolling window of block length
finds it. Hits are then extended to maximal exact repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilldeck.llm.words import (
    Words,
    batch_of,
    blobs,
    chunks,
    column,
    groups,
    packed_ids,
    planes,
    slices,
    table_of,
    unpacked_ids,
    unplaned,
    whole_texts,
)

WINDOW = 20
_KEY = "__key"
_TEXT = "__text"
_PRINT = "__print"
_ANCHORS = "bucket int, seen binary, twice binary, block binary, id binary, print binary, at binary"
_WINDOWS = "bucket int, hash binary, id binary, print binary, at binary"
_REPEATS = "bucket int, id binary, print binary, at binary"
_SPANS = f"{_KEY} long, {_PRINT} int, at binary"


def _documents(part: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray]:
    words = Words.of(column(part, _TEXT))
    ids = np.array(column(part, _KEY), dtype=np.int64)
    prints = np.array(column(part, _PRINT), dtype=np.int32)
    return words, ids, prints


def _places(ids: np.ndarray, prints: np.ndarray, at: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Packed places; ``ids`` must ascend."""
    return packed_ids(ids), prints.tobytes(), planes(at)


def _placed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, at = column(table, "id"), column(table, "at")
    return (
        np.concatenate([unpacked_ids(b) for b in ids]),
        blobs(table, "print", np.int32),
        np.concatenate([unplaned(b) for b in at]).astype(np.int64),
    )


def _anchors(block: int, buckets: int):
    """Per chunk and bucket: keys of all rolling windows of block length (each
    once, those seen twice again), and the aligned blocks with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, _TEXT):
            words, ids, prints = _documents(part)
            hashes, at = words.windows(block)
            doc = np.repeat(np.arange(len(ids)), words.counts)[at]
            place = at - words.first[doc]
            bucket = (hashes & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)
            keys = (hashes >> np.uint64(32)).astype(np.uint32)
            order, cuts = slices(bucket, buckets)
            keys, doc, place = keys[order], doc[order], place[order]
            aligned = place % block == 0
            rows = []
            for b in range(buckets):
                cut = slice(cuts[b], cuts[b + 1])
                if cuts[b] == cuts[b + 1]:
                    continue
                seen, times = np.unique(keys[cut], return_counts=True)
                on = np.flatnonzero(aligned[cut]) + cuts[b]
                on = on[np.argsort(ids[doc[on]], kind="stable")]
                rows.append(
                    (
                        b,
                        seen.tobytes(),
                        seen[times > 1].tobytes(),
                        keys[on].tobytes(),
                        *_places(ids[doc[on]], prints[doc[on]], place[on] // block),
                    )
                )
            if rows:
                yield batch_of(rows, _ANCHORS)

    return run


def _hit_blocks(table: pa.Table) -> pa.Table:
    """Blocks whose words occur at another place too. Keys are 32 bits within a
    bucket: a chance hit costs a look at exact windows later, never a word."""
    seen = np.sort(blobs(table, "seen", np.uint32))
    again = np.union1d(seen[1:][seen[1:] == seen[:-1]], blobs(table, "twice", np.uint32))
    hit = np.isin(blobs(table, "block", np.uint32), again)
    ids, prints, at = _placed(table)
    return pa.table({_KEY: ids[hit], _PRINT: prints[hit], "block": at[hit].astype(np.int32)})


def _candidates(window: int, block: int, buckets: int):
    """Windows around hit blocks. Of equal windows a chunk sends its first one;
    the others are known repeats and pass by, so a passage that half of all
    documents hold reaches the next step once per chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, _TEXT):
            blocks = part.column(part.schema.get_field_index("blocks"))
            part = part.filter(blocks.is_valid())
            if not part.num_rows:
                continue
            words, ids, prints = _documents(part)
            hashes, at = words.windows(window)
            doc = np.repeat(np.arange(len(ids)), words.counts)[at]
            place = at - words.first[doc]
            # The one aligned block that a window holds from its first half on.
            per_doc = words.counts // block + 2
            base = np.concatenate(([0], np.cumsum(per_doc)))
            hit = np.zeros(base[-1], dtype=bool)
            for i, found in enumerate(column(part, "blocks")):
                hit[base[i] + np.asarray(found, dtype=np.int64)] = True
            keep = hit[base[doc] + (place + block - 1) // block]
            hashes, doc, place = hashes[keep], doc[keep], place[keep]
            if not len(hashes):
                continue
            order = np.lexsort((place, ids[doc], hashes))
            hashes, doc, place = hashes[order], doc[order], place[order]
            head = np.concatenate(([True], hashes[1:] != hashes[:-1]))
            lead = np.flatnonzero(head)[np.cumsum(head) - 1]
            # Rows that repeat an id and a place are not earlier than each other.
            tied = (ids[doc] == ids[doc[lead]]) & (place == place[lead])
            rows = []
            late = ~tied
            if late.any():
                own = np.flatnonzero(late)
                own = own[np.argsort(ids[doc[own]], kind="stable")]
                key = buckets + int(ids[0]) % buckets
                rows.append((key, b"", *_places(ids[doc[own]], prints[doc[own]], place[own])))
            hashes, doc, place = hashes[tied], doc[tied], place[tied]
            order = np.lexsort((place, ids[doc]))
            hashes, doc, place = hashes[order], doc[order], place[order]
            order, cuts = slices(hashes % np.uint64(buckets), buckets)
            for b in range(buckets):
                cut = order[cuts[b] : cuts[b + 1]]
                if len(cut):
                    rows.append((b, hashes[cut].tobytes(), *_places(ids[doc[cut]], prints[doc[cut]], place[cut])))
            yield batch_of(rows, _WINDOWS)

    return run


def _later_windows(shares: int):
    """Windows that are not the first of their words, dealt out by document."""

    def run(table: pa.Table) -> pa.Table:
        ids, prints, places = _placed(table)
        hashes = blobs(table, "hash", np.uint64)
        if len(hashes):
            order = np.lexsort((places, ids, hashes))
            head = np.concatenate(([True], hashes[order][1:] != hashes[order][:-1]))
            lead = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
            late = order[(ids[order] != ids[lead]) | (places[order] != places[lead])]
            ids, prints, places = ids[late], prints[late], places[late]
        order, cuts = slices(ids.view(np.uint64) % np.uint64(shares), shares)
        rows = []
        for b in range(shares):
            cut = order[cuts[b] : cuts[b + 1]]
            if len(cut):
                cut = cut[np.lexsort((places[cut], ids[cut]))]
                rows.append((b, *_places(ids[cut], prints[cut], places[cut])))
        return table_of(rows, _REPEATS)

    return run


def _spans(window: int):
    """Maximal repeats of each document as pairs of first and last-plus-one word."""

    def run(table: pa.Table) -> pa.Table:
        ids, prints, places = _placed(table)
        order = np.lexsort((places, prints, ids))
        ids, prints, places = ids[order], prints[order], places[order]
        if not len(ids):
            return table_of([], _SPANS)
        other = np.concatenate(([True], (ids[1:] != ids[:-1]) | (prints[1:] != prints[:-1])))
        gap = other | np.concatenate(([True], places[1:] > places[:-1] + window))
        first = np.flatnonzero(gap)
        last = np.concatenate((first[1:], [len(ids)])) - 1
        pairs = np.stack((places[first], places[last] + window), axis=1).astype(np.uint32)
        document = np.flatnonzero(other[first])
        ends = np.concatenate((document[1:], [len(first)]))
        rows = [
            (int(ids[first[i]]), int(prints[first[i]]), pairs[i:j].tobytes())
            for i, j in zip(document, ends, strict=True)
        ]
        return table_of(rows, _SPANS)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in chunks(batches, _TEXT):
        counts, removed, kept, spans = [], [], [], []
        for text, blob in zip(column(part, _TEXT), column(part, "at"), strict=True):
            words = (text or b"").split()
            pairs = np.frombuffer(blob or b"", dtype=np.uint32).reshape(-1, 2)
            counts.append(len(words))
            spans.append([{"start": int(a), "stop": int(b)} for a, b in pairs])
            removed.append(int((pairs[:, 1] - pairs[:, 0]).sum()) if len(pairs) else 0)
            for a, b in pairs[::-1]:
                del words[a:b]
            kept.append(b" ".join(words).decode())
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        carried = part.column(part.schema.get_field_index("carried"))
        yield pa.RecordBatch.from_arrays(
            [
                carried,
                pa.array(counts, type=pa.int64()),
                pa.array(removed, type=pa.int64()),
                pa.array(spans, type=span),
                pa.array(kept, type=pa.string()),
            ],
            names=["carried", "n_words", "n_removed", "spans", "kept_text"],
        )


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Documents without the words of windows that start earlier too.

    A window is ``window`` consecutive words (runs of anything but ASCII white
    space) of one document. Earlier means a smaller id, or the same document and
    an earlier start. Windows are judged on the input. Returns one row per input
    row: the id, the ``carry`` columns, ``n_words``, ``n_removed``, ``spans``
    (maximal repeats, in words) and ``kept_text`` (kept words, one space apart).

    Null and empty texts have no words. A row with a null id keeps its words and
    makes no other row lose any. Rows that repeat an id and its text are judged
    alike; at equal places they do not count as earlier than each other. No other
    column of ``docs`` is looked at. Windows are compared by 64-bit hashes.

    Texts are scanned once for anchors and shuffled once by document; both later
    uses read that shuffle. Anchors and windows travel as packed arrays.
    """
    block = window // 2
    buckets = groups(docs)
    carried = [c for c in dict.fromkeys((id_column, *carry))]
    keyed = whole_texts(docs).select(
        F.col(id_column).cast("long").alias(_KEY),
        F.col(text_column).cast("binary").alias(_TEXT),
        # Tells rows apart that repeat an id with another text.
        F.hash(text_column).alias(_PRINT),
        F.struct(*carried).alias("carried"),
    )
    slim = keyed.select(_KEY, _TEXT, _PRINT).where(F.col(_KEY).isNotNull())
    hits = (
        slim.mapInArrow(_anchors(block, buckets), _ANCHORS)
        .groupBy("bucket")
        .applyInArrow(_hit_blocks, f"{_KEY} long, {_PRINT} int, block int")
        .groupBy(_KEY, _PRINT)
        .agg(F.collect_set("block").alias("blocks"))
    )
    spans = (
        keyed.join(hits, [_KEY, _PRINT], "left")
        # The same columns as below, so that both joins share one shuffle of the texts.
        .select("carried", _KEY, _TEXT, _PRINT, "blocks")
        .mapInArrow(_candidates(window, block, buckets), _WINDOWS)
        .groupBy("bucket")
        .applyInArrow(_later_windows(buckets // 2), _REPEATS)
        .groupBy("bucket")
        .applyInArrow(_spans(window), _SPANS)
    )
    whole = keyed.join(spans, [_KEY, _PRINT], "left").select("carried", _TEXT, "at")
    kinds = whole.schema["carried"].dataType.simpleString()
    out = whole.mapInArrow(
        _cut,
        f"carried {kinds}, n_words long, n_removed long, spans array<struct<start:long,stop:long>>, kept_text string",
    )
    return out.select("carried.*", "n_words", "n_removed", "spans", "kept_text")
