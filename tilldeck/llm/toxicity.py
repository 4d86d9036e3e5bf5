"""Toxicity by compression distance.

Two zstandard dictionaries hold stretches of real toxic and of real ordinary text:
byte sequences that tell one label from the other, as they stand in a bounded
sample, so other forms of a word share bytes with them. Windows of several words
of the whole text are compressed with either; what a difference in length says is
weighed on labelled rows that chose no dictionary.

A block's headers would hide a short match, and none is looked for near its end, so
every window ends with the same bytes, which both dictionaries hold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilldeck.llm.words import LETTER_DIGIT, chunks, column, mix, whole_texts

# Labelled rows that calibrate at most, of each label, on average.
FIT_ROWS = 30_000
# Labelled rows that choose the dictionaries at most, and characters of each.
TOXIC_ROWS, ORDINARY_ROWS = 1_000, 4_000
STRETCH = 8_000
# Bytes of a sequence that is counted.
SEQUENCE = 6
# A telling sequence follows this many different words at least, so copies of one
# text do not make its rare words suspicious.
LEAST_CONTEXTS = 5
# Chance that a sequence without meaning follows that many in one label only.
CHANCE = 1e-4
# Its share in the other label's text, against its own.
MOST_OTHER = 0.05
DICTIONARY_BYTES = 64_000
WINDOW_WORDS = 4
# Bytes saved from which on a window counts as a hit, and with more are alike.
MARGIN, MOST_SAVED = 3, 8
# Evidence from which on the next share of toxic documents holds.
STEPS = (0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0, 7.0, 10.0, 15.0)
THRESHOLD = 0.7
_PARAMETERS = {
    "window_log": 18,
    "hash_log": 15,
    "chain_log": 15,
    "search_log": 4,
    "min_match": SEQUENCE,
    "target_length": 64,
    "strategy": zstandard.STRATEGY_GREEDY,
    "write_content_size": False,
    "write_checksum": False,
    "write_dict_id": False,
}
_TRAILER = bytes(range(1, 32))
_GAP = bytes(8)
# What the driver counts at once: texts of a part (a megabyte at ``STRETCH`` bytes
# each), counters of sequences, and places whose contexts are told apart.
_PART_TEXTS, _COUNTERS, _MOST_PLACES = 125, 1 << 22, 1 << 20
_PLAIN = bytes(b if LETTER_DIGIT[b] else 32 for b in bytes(range(256)).lower())
_FOUND = "hits long, windows long, evidence double"


def _words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_PLAIN).split()


def _windows(text: bytes | None) -> list[bytes]:
    words = _words(text)
    return [
        b" %b %b" % (b" ".join(words[i : i + WINDOW_WORDS]), _TRAILER) for i in range(0, len(words), WINDOW_WORDS)
    ]


def _sequences(texts: list[bytes]) -> tuple[bytes, np.ndarray]:
    """The texts' words and the byte sequence at each place; 0 where a sequence would
    leave its text."""
    data = b"".join(b"%b %b " % (_GAP, b" ".join(_words(text))) for text in texts) + _GAP
    count = len(data) - len(_GAP)
    eight = np.ndarray((count,), dtype="<u8", buffer=data, strides=(1,))
    found = eight & np.uint64((1 << 8 * SEQUENCE) - 1)
    gaps = np.concatenate(([0], np.cumsum(np.frombuffer(data, dtype=np.uint8) == 0, dtype=np.int32)))
    found[gaps[SEQUENCE : SEQUENCE + count] != gaps[:count]] = 0
    return data, found


def _pairs(data: bytes, found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each sequence at the places ``at`` with the end of the word before."""
    count = len(found)
    eight = np.ndarray((count,), dtype="<u8", buffer=data, strides=(1,))
    places = np.where(np.frombuffer(data, dtype=np.uint8, count=count) == 32, np.arange(count, dtype=np.int32), 0)
    space = np.maximum.accumulate(places)[at]
    return mix(found[at] ^ mix(eight[np.maximum(space - 8, 0)]))


def _parts(texts: list[bytes]) -> Iterator[list[bytes]]:
    """A megabyte of text at a time, which bounds the memory of what is counted."""
    for i in range(0, len(texts), _PART_TEXTS):
        yield texts[i : i + _PART_TEXTS]


def _contexts(found: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences and after how many different words each stands."""
    _, first = np.unique(pairs, return_index=True)
    return np.unique(found[first], return_counts=True)


def _frequent(texts: list[bytes], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Sequences that may stand at ``least`` places, and at how many at most: some
    share a counter with others."""
    counters = np.zeros(_COUNTERS, dtype=np.int64)
    mask = np.uint64(_COUNTERS - 1)
    for part in _parts(texts):
        found = _sequences(part)[1]
        counters += np.bincount((mix(found[found != 0]) & mask).view(np.int64), minlength=_COUNTERS)
    values = np.empty(0, dtype=np.uint64)
    for part in _parts(texts):
        found = np.unique(_sequences(part)[1])
        found = found[found != 0]
        values = np.union1d(values, found[counters[(mix(found) & mask).view(np.int64)] >= least])
    return values, counters[(mix(values) & mask).view(np.int64)]


def _places(texts: list[bytes], values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where the sorted ``values`` stand, with the words before them, part by part."""
    for part in _parts(texts):
        data, found = _sequences(part)
        at = np.flatnonzero(np.isin(found, values))
        yield found[at], _pairs(data, found, at)


def _context_counts(texts: list[bytes], values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """After how many different words each value stands in all texts together. Values
    of about ``_MOST_PLACES`` places are counted in one go."""
    times = np.zeros(len(values), dtype=np.int64)
    go = np.cumsum(places) // _MOST_PLACES
    for low, high in zip(*(np.searchsorted(go, np.unique(go), side=side) for side in ("left", "right")), strict=True):
        known, standing = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint64)
        for found, pairs in _places(texts, values[low:high]):
            known, first = np.unique(np.concatenate((known, pairs)), return_index=True)
            standing = np.concatenate((standing, found))[first]
        which, n = np.unique(standing, return_counts=True)
        times[low + np.searchsorted(values[low:high], which)] = n
    return times


def _telling(own: list[bytes], other: list[bytes]) -> bytes:
    """Stretches of ``own`` texts whose sequences ``other`` texts hardly hold, the
    most frequent ones last, where they are cheapest to refer to.

    No array spans all texts: rare sequences and those that ``other`` texts hold leave
    before contexts are counted, so memory follows the part, not the sample."""
    total, rest = sum(map(len, own)), sum(map(len, other))
    if not total or not rest:
        return b""
    least = max(LEAST_CONTEXTS, np.log(CHANCE) / np.log(total / (total + rest)))
    values, places = _frequent(own, least)
    against = np.zeros(len(values))
    # Parts are counted one by one, so a context may count in each.
    for found, pairs in _places(other, values):
        which, n = _contexts(found, pairs)
        against[np.searchsorted(values, which)] += n
    # A sequence stands after no more words than it has places.
    may = against * total <= MOST_OTHER * places * rest
    values, places, against = values[may], places[may], against[may]
    times = _context_counts(own, values, places)
    values = values[(times >= least) & (against * total <= MOST_OTHER * times * rest)]
    counted: Counter[bytes] = Counter()
    for part in _parts(own):
        data, found = _sequences(part)
        marks = np.diff(np.concatenate(([0], np.isin(found, values).astype(np.int8), [0])))
        runs = zip(np.flatnonzero(marks == 1), np.flatnonzero(marks == -1) + SEQUENCE - 1, strict=True)
        counted.update(data[low:high] for low, high in runs)
    kept, room = [], DICTIONARY_BYTES
    for run in sorted(counted, key=lambda r: (-counted[r], r)):
        if len(run) < room:
            kept.append(run)
            room -= len(run) + 1
    return b"\n".join(kept[::-1])


@dataclass(frozen=True)
class Model:
    """Both dictionaries, the share of toxic documents by step of evidence, and what
    a window says by bytes saved."""

    toxic: bytes
    ordinary: bytes
    shares: tuple[float, ...] = ()
    weights: tuple[float, ...] = (0.0,) * (MOST_SAVED + 1)


class _Distance:
    def __init__(self, model: Model) -> None:
        self.toxic, self.ordinary = (self._compressor(d) for d in (model.toxic, model.ordinary))

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        parameters = zstandard.ZstdCompressionParameters(**_PARAMETERS)
        whole = zstandard.ZstdCompressionDict(
            content + b"\n" + _TRAILER, dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        whole.precompute_compress(compression_params=parameters)
        return zstandard.ZstdCompressor(dict_data=whole, compression_params=parameters)

    def saved(self, text: bytes | None) -> np.ndarray:
        """Bytes that the toxic dictionary saves over the ordinary one, by window."""
        toxic, ordinary = self.toxic.compress, self.ordinary.compress
        return np.array([len(ordinary(w)) - len(toxic(w)) for w in _windows(text)], dtype=np.int64)


def evidence(saved: np.ndarray, weights: np.ndarray) -> float:
    """How much more likely the windows are in a toxic document than in an ordinary
    one, as a logarithm: for the whole text, or for its best stretch of windows less
    the number of stretches to choose from. So hits count against the length."""
    if not len(saved):
        return 0.0
    sums = np.concatenate(([0.0], np.cumsum(weights[np.clip(saved, 0, MOST_SAVED)])))
    best = (sums - np.minimum.accumulate(sums)).max()
    return float(max(sums[-1], best - 2 * np.log(len(saved))))


def _judged(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance, weights = _Distance(model), np.array(model.weights)
        for part in chunks(_with_text(batches), "text"):
            hits, windows, values = [], [], []
            for text in column(part, "text"):
                saved = distance.saved(text)
                hits.append(int((saved >= MARGIN).sum()))
                windows.append(len(saved))
                values.append(evidence(saved, weights))
            carried = part.column(part.schema.get_field_index("carried"))
            yield pa.RecordBatch.from_arrays(
                [carried, pa.array(hits, pa.int64()), pa.array(windows, pa.int64()), pa.array(values, pa.float64())],
                names=["carried", "hits", "windows", "evidence"],
            )

    return run


def _tallied(model: Model):
    """Windows of each label by bytes saved, one row a chunk and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = _Distance(model)
        for part in chunks(batches, "text"):
            tally = np.zeros((2, MOST_SAVED + 1), dtype=np.int64)
            for label, text in zip(column(part, "toxic"), column(part, "text"), strict=True):
                tally[label] += np.bincount(np.clip(distance.saved(text), 0, MOST_SAVED), minlength=MOST_SAVED + 1)
            label, saved = np.nonzero(tally)
            yield pa.RecordBatch.from_arrays(
                [pa.array(label, pa.int32()), pa.array(saved, pa.int32()), pa.array(tally[label, saved], pa.int64())],
                names=["toxic", "saved", "n"],
            )

    return run


def _with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Carried columns and the text, which the last of them is."""
    for batch in batches:
        carried = batch.column(0)
        text = carried.field(carried.type.num_fields - 1).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([carried, text], names=["carried", "text"])


def _scanned(docs: DataFrame, text_column: str, carried: list[str | Column], model: Model) -> DataFrame:
    carried = [*(c for c in carried if c != text_column), F.col(text_column).cast("string").alias(text_column)]
    df = whole_texts(docs).select(F.struct(*carried).alias("carried"))
    kinds = df.schema["carried"].dataType.simpleString()
    return df.mapInArrow(_judged(model), f"carried {kinds}, {_FOUND}").select(
        "carried.*", "hits", "windows", "evidence"
    )


def _step(value: Column) -> Column:
    """Number of the last step of evidence reached."""
    reached = F.lit(0)
    for step in STEPS:
        reached = reached + (value >= step).cast("int")
    return reached


def _rising(tally: np.ndarray) -> np.ndarray:
    """Share of the second column by row, neighbours pooled until it never falls."""
    blocks: list[list] = []
    for row in tally:
        blocks.append([row.copy(), 1])
        while len(blocks) > 1 and _share(blocks[-2][0]) >= _share(blocks[-1][0]):
            last, n = blocks.pop()
            blocks[-1][0] += last
            blocks[-1][1] += n
    return np.concatenate([np.full(n, _share(row)) for row, n in blocks])


def _share(row: np.ndarray) -> float:
    return float((row[1] + 0.5) / (row.sum() + 1))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> Model:
    """Dictionaries from up to two thirds of the labelled rows, about ``TOXIC_ROWS``
    and ``ORDINARY_ROWS`` at most, a stretch of each; calibration from the other
    third, about ``fit_rows`` of each label at most. A hash of the id decides.

    What comes to the driver is bounded by the dictionary's rows times ``STRETCH``: of a
    longer text a stretch at a place set by its id may choose sequences for the
    dictionaries; calibration and scoring always take whole texts. Dictionaries hold raw
    stretches of text, picked by what they tell, not by zstandard's own trainer.
    Without toxic rows no window counts.

    Labels other than 0 and 1 and rows with a null id are left out; an id labelled both
    ways counts as toxic. Rows of ``docs`` that share an id are all taken, those with a
    null text have no window. Other columns, whatever their names, are not looked at.
    """
    known = labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("labelled")).agg(F.max(label_column).cast("int").alias("toxic"))
    known = known.withColumn("choosing", F.pmod(F.xxhash64("labelled", F.lit("part")), F.lit(3)) < 2)
    counts = {(row["toxic"], row["choosing"]): row["n"] for row in known.groupBy("toxic", "choosing").agg(F.count("*").alias("n")).collect()}
    chance = F.pmod(F.xxhash64("labelled"), F.lit(1_000_000)) / 1_000_000

    def sampled(choosing: bool, most: tuple[int, int]) -> tuple[DataFrame, list[float]]:
        share = [min(1.0, most[label] / counts.get((label, choosing), 1)) for label in (0, 1)]
        part = known.where(F.col("choosing") == choosing).where(
            chance < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])
        )
        # Proven small: ids and labels of the rows above.
        # Other columns of the documents may be named like these.
        texts = whole_texts(docs).select(F.col(id_column).alias("labelled"), F.col(text_column).cast("string").alias("text"))
        return texts.join(F.broadcast(part), "labelled").select("labelled", "toxic", "text"), share

    rows, _ = sampled(True, (ORDINARY_ROWS, TOXIC_ROWS))
    start = F.pmod(F.xxhash64("labelled", F.lit("start")), F.greatest(F.length("text") - STRETCH, F.lit(1))) + 1
    stretch = F.substring("text", start.cast("int"), F.lit(STRETCH)).cast("binary")
    # Copies of one stretch count once, as the order of rows must not matter.
    found = rows.where("text is not null").select("toxic", stretch.alias("text")).distinct().collect()
    texts = [sorted(bytes(row["text"]) for row in found if row["toxic"] == label) for label in (0, 1)]
    model = Model(_telling(texts[1], texts[0]), _telling(texts[0], texts[1]) if texts[1] else b"")
    rows, share = sampled(False, (fit_rows, fit_rows))
    sent = rows.select("toxic", F.col("text").cast("binary").alias("text"))
    windows = np.zeros((MOST_SAVED + 1, 2))
    for row in (
        sent.mapInArrow(_tallied(model), "toxic int, saved int, n long")
        .groupBy("saved", "toxic")
        .agg(F.sum("n").alias("n"))
        .collect()
    ):
        windows[row["saved"], row["toxic"]] = row["n"]
    if windows.sum(axis=0).all() and model.toxic:
        # Odds of the pooled shares, against those of all windows.
        rate = _rising(windows)
        total = windows.sum(axis=0)
        weights = tuple((np.log(rate / (1 - rate)) - np.log(total[1] / total[0])).tolist())
    else:
        weights = (0.0,) * (MOST_SAVED + 1)
    model = Model(model.toxic, model.ordinary, (), weights)
    steps = _scanned(rows, "text", ["toxic"], model).groupBy(_step(F.col("evidence")).alias("step"), "toxic")
    tally = np.zeros((len(STEPS) + 1, 2))
    for row in steps.agg(F.count("*").alias("n")).collect():
        # Back to the labels' own proportions where the sample thinned them out.
        tally[row["step"], row["toxic"]] += row["n"] / share[row["toxic"]]
    return Model(model.toxic, model.ordinary, tuple(_rising(tally).tolist()), weights)


def toxicity(
    docs: DataFrame, model: Model, text_column: str = "text", carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """One row per document: the ``carry`` columns, ``hits`` (windows of
    ``WINDOW_WORDS`` words that the toxic dictionary saves ``MARGIN`` bytes of),
    and ``score`` from 0 to 1, by ``evidence``.

    Every window of the whole text counts. Null and empty texts have none and
    get the score of no evidence. Repeated rows are scored alike; ids and any other
    columns are not looked at.
    """
    out = _scanned(docs, text_column, list(carry), model)
    shares = F.array(*(F.lit(s) for s in model.shares))
    return out.select(*carry, "hits", F.get(shares, _step(F.col("evidence"))).alias("score"))
