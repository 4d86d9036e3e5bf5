"""Runs of repeated words: stretches with a short period, and texts without them.

Seed and extend on diagonals. Words ``q`` apart are compared along the diagonal of
lag ``q``; a run of period ``q`` is a stretch of such matches, so every run of a class
of lags holds a k-gram of matches of the class's least guaranteed length. The k-grams
of a document are indexed, pairs of occurrences give seeds, seeds are extended to
maximal stretches, and a table of the furthest place covered on each lag lets no
stretch be extended twice.

Only neighbouring occurrences of a k-gram are paired. That loses nothing: if a k-gram
inside a run of smallest period ``q`` came again after ``d < q`` words, it would have
the periods ``d`` and ``q``. With ``k >= 2q - 2`` it would have their greatest common
divisor as period too, and so would the whole run. So lags are dealt into classes
whose largest lag is at most ``k / 2 + 1``: about one class for each half more of lag,
and each is linear in the words but for its sort. The same argument makes the lag
of every stretch found that is long enough its smallest period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilldeck.llm.words import Words, chunks, column, whole_texts

LEAST_WORDS = 6
EXPONENT = 4
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_text string"


def _matches(lag: np.ndarray | int, least: int, exponent: int) -> np.ndarray | int:
    """Matches on the diagonal of ``lag`` that a run of that period has at least."""
    return np.maximum(least - lag, (exponent - 1) * lag)


def lag_classes(longest: int, least: int = LEAST_WORDS, exponent: int = EXPONENT) -> Iterator[tuple[int, int, int]]:
    """``(first lag, last lag, k)`` up to the lag ``longest``."""
    first = 1
    while first <= longest:
        last, k = first, _matches(first, least, exponent)
        while True:
            wider = min(k, _matches(last + 1, least, exponent))
            if 2 * last > wider:  # 2 * (last + 1) - 2
                break
            last, k = last + 1, wider
        yield first, last, int(k)
        first = last + 1


def _seeds(words: Words, lags: tuple[int, int], k: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Lag and first place of the neighbouring occurrences of equal k-grams."""
    values, at = words.windows(k)
    # Documents too short for a run of the class have no say.
    room = np.repeat(words.counts, words.counts)[at] >= exponent * lags[0]
    values, at = values[room], at[room]
    order = np.argsort(values, kind="stable")
    values, at = values[order], at[order]
    lag = np.diff(at)
    found = (values[1:] == values[:-1]) & (lag >= lags[0]) & (lag <= lags[1])
    found = np.flatnonzero(found)
    lag, at = lag[found], at[found]
    order = np.lexsort((at, lag))
    return lag[order], at[order]


def _runs(words: Words, least: int, exponent: int) -> tuple[np.ndarray, ...]:
    """Document, start inside it, length and period of every run of the chunk, in the
    order of start and period."""
    hashes, counts = words.hashes(), words.counts
    document = np.repeat(np.arange(len(counts)), counts)
    out: list[tuple[int, int, int, int]] = []
    for first, last, k in lag_classes(int(counts.max(initial=0)) // exponent, least, exponent):
        lag, at = _seeds(words, (first, last), k, exponent)
        if not len(lag):
            continue
        # Seeds one place after another lie on one stretch; shorter ones cannot be runs.
        heads = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(lag) != 0))))
        seen = np.diff(np.append(heads, len(lag))) + k - 1
        heads = heads[seen >= _matches(lag[heads], least, exponent)]
        covered: dict[int, int] = {}
        for q, p in zip(lag[heads].tolist(), at[heads].tolist(), strict=True):
            if p < covered.get(q, -1):
                continue
            low, high = int(words.first[document[p]]), int(words.first[document[p] + 1])
            stop = p + q + k
            while p > low and hashes[p - 1] == hashes[p - 1 + q]:
                p -= 1
            stop = _extended(hashes, stop, high, q)
            covered[q] = stop - q
            if stop - p >= max(least, exponent * q):
                out.append((int(document[p]), p - low, stop - p, q))
    found = np.array(sorted((d, s, q, n) for d, s, n, q in out), dtype=np.int64).reshape(-1, 4)
    return found[:, 0], found[:, 1], found[:, 3], found[:, 2]


def _extended(hashes: np.ndarray, stop: int, high: int, lag: int, step: int = 64) -> int:
    """The end of the stretch of words that equal those ``lag`` before them."""
    while stop < high:
        to = min(stop + step, high)
        differ = np.flatnonzero(hashes[stop:to] != hashes[stop - lag : to - lag])
        if len(differ):
            return stop + int(differ[0])
        stop, step = to, step * 2
    return stop


def _joined(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one space, as they lie in the chunk:
    every word has a byte after it, which becomes the space."""
    plain = np.frombuffer(words.data, dtype=np.uint8).copy()
    plain[words.ends] = 32
    starts, ends = words.starts[kept], words.ends[kept] + 1
    number = np.concatenate(([0], np.cumsum(kept)))[words.first]
    last = number[1:][np.diff(number) > 0] - 1
    ends[last] -= 1  # no space after a document's last word
    marks = np.zeros(len(plain) + 1, dtype=np.int8)
    marks[starts] = 1
    # A word may begin where the space of the one before ends.
    np.add.at(marks, ends, -1)
    text = plain[np.cumsum(marks[:-1], dtype=np.int8).astype(bool)]
    sizes = np.concatenate(([0], np.cumsum(ends - starts)))
    offsets = sizes[number].astype(np.int64)
    array = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(text))
    return array.cast(pa.string())


def _found(least: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(_with_text(batches), "text"):
            words = Words.of(column(part, "text"))
            document, start, length, period = _runs(words, least, exponent)
            base = words.first[document]
            # What a run holds after its first period is dropped.
            marks = np.zeros(len(words.starts) + 1, dtype=np.int64)
            np.add.at(marks, base + start + period, 1)
            np.add.at(marks, base + start + length, -1)
            kept = np.cumsum(marks)[:-1] == 0
            offsets = np.searchsorted(document, np.arange(len(words.counts) + 1)).astype(np.int32)
            runs = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in (start, length, period)], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(words.counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), runs),
                    _joined(words, kept),
                ],
                names=["carried", "n_words", "runs", "collapsed_text"],
            )

    return run


def _with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.binary())], names=["carried", "text"])


def periodic_runs(
    docs: DataFrame,
    text_column: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    least: int = LEAST_WORDS,
    exponent: int = EXPONENT,
) -> DataFrame:
    """One row per document: the ``carry`` columns, ``n_words``, ``runs`` (structs of
    ``start``, ``length`` and ``period`` in words, by start, then period) and
    ``collapsed_text``, the text without what runs repeat, its words joined by one space.

    A run is a longest possible stretch of words in which those ``period`` apart are
    equal, for the smallest such period, with at least ``least`` words and ``exponent``
    periods. A word is dropped where any run holds it after the run's first period.
    ``exponent`` must be 3 or more, for the classes of lags rest on that.

    Null, empty and blank texts have no word, no run and an empty text. Runs never
    cross rows, repeated rows are judged alike, and other columns, ids too, are not
    looked at; a carried column may not have the name of one that is added. Texts are
    taken whole, however long: a task holds one chunk of them or the longest one.
    Words count as equal by 64-bit hashes.
    """
    if exponent < 3 or least < 1:
        raise ValueError("exponent must be 3 or more, least positive")
    added = [field.split()[0] for field in RUNS.split(", ")]
    if clash := sorted(set(carry) & set(added)):
        raise ValueError(f"carried columns are named like results: {clash}")
    df = whole_texts(docs).select(
        F.struct(*(F.col(c) for c in carry)).alias("carried"), F.col(text_column).cast("string").alias("text")
    )
    kinds = df.schema["carried"].dataType.simpleString()
    return df.mapInArrow(_found(least, exponent), f"carried {kinds}, {RUNS}").select("carried.*", *added)
