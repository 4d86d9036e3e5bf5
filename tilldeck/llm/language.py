"""Language of texts and of their words by a linear-chain conditional random field.

Each word of a text is a position of the chain, its language the label. Features of a
word are its prefixes and suffixes, the n-grams of its letters and the lexicons it is
found in; weights of features and of transitions between languages are learned
together, and forward-backward gives each word's probabilities with its context. So
text that switches languages is labelled word by word, and a document's language is
the one with most probability over all its words.

Both passes run over a whole chunk of documents at once: its words are cut into equal
blocks, the products of the blocks' step matrices are combined in order, and all blocks
are walked side by side. A document's first step forgets what came before, so the
result is that of each document alone, of any length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilldeck.llm.words import chunks, column, mix, whole_texts

# Stretches of text that are learned from, per language and on average, and their
# characters. Stretches lie anywhere in a text, so long texts give more of them.
STRETCHES = 500
STRETCH = 300
# Hashed features; n-grams and affixes by bytes.
BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
AFFIXES = (1, 2, 3, 4, 5)
# A lexicon holds words seen so often, nearly always in its language.
LEXICON_WORDS, LEAST_SEEN, LEAST_SHARE = 2_000, 3, 0.9
# Words of a learned chain and, on average, between two switches of language in it.
CHAIN, SEGMENT = 48, 12
ROUNDS, RATE, DECAY = 40, 0.5, 1e-6
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_BLOCK = 256
_CHUNK_BYTES = 2 << 20
FOUND = "lang_pred string, score double, n_words long, spans array<struct<start:long,stop:long,lang:string>>"


def words_of(text: str | None) -> list[str]:
    """Runs of letters of any script, in lower case."""
    return _LETTERS.findall((text or "").lower())


def _hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word and bucket of every n-gram and affix, in the order of words. Both ends of a
    word are marked, so an n-gram at an end differs from one inside."""
    data = b"".join(b"\x02%b\x03" % word.encode() for word in words)
    sizes = np.array([len(word.encode()) + 2 for word in words], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    eight = np.ndarray((len(data),), dtype="<u8", buffer=data + bytes(8), strides=(1,))
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(data))
    which, bucket = [], []

    def add(kind: int, size: int, at: np.ndarray, word: np.ndarray) -> None:
        value = eight[at] & np.uint64((1 << 8 * size) - 1)
        which.append(word)
        bucket.append((mix(value + np.uint64(kind << 48)) % np.uint64(BUCKETS)).astype(np.int32))

    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        add(n, n, at, owner[at])
    numbers = np.arange(len(words), dtype=np.int32)
    for n in AFFIXES:
        long = sizes - 2 >= n
        add(16 + n, n, starts[long] + 1, numbers[long])
        add(32 + n, n, (starts + sizes)[long] - 1 - n, numbers[long])
    which, bucket = np.concatenate(which), np.concatenate(bucket)
    order = np.argsort(which, kind="stable")
    return which[order], bucket[order]


@dataclass(frozen=True)
class Model:
    """Languages in ascending order; weights by feature and language (hashed ones
    first, then one for each lexicon), of transitions (from, to) and of the first word."""

    languages: tuple[str, ...]
    weights: np.ndarray
    transitions: np.ndarray
    first: np.ndarray
    lexicon: dict[str, int]

    def emissions(self, words: list[str]) -> np.ndarray:
        """A row of label weights for each word."""
        out = np.empty((len(words), len(self.languages)))
        for low in range(0, len(words), 20_000):
            part = words[low : low + 20_000]
            which, bucket = _hashed(part)
            begins = np.searchsorted(which, np.arange(len(part)))
            out[low : low + len(part)] = np.add.reduceat(self.weights[bucket], begins, axis=0)
        listed = [(i, self.lexicon[w]) for i, w in enumerate(words) if w in self.lexicon]
        if listed:
            at, of = np.array(listed).T
            out[at] += self.weights[BUCKETS + of]
        return out


def marginals(scores: np.ndarray, begins: np.ndarray, transitions: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probabilities of each label at each position of many chains laid end to end.

    ``scores`` are label weights by position, ``begins`` says where chains begin.
    """
    n, labels = scores.shape
    if n == 0:
        return np.zeros((0, labels))
    block = min(_BLOCK, n)
    blocks = -(-n // block)
    emit = np.ones((blocks * block, labels))
    emit[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    fresh = np.ones(blocks * block, dtype=bool)
    fresh[:n] = begins
    fresh[0] = True
    emit, fresh = emit.reshape(blocks, block, labels), fresh.reshape(blocks, block)
    step, start = np.exp(transitions - transitions.max()), np.exp(first - first.max())

    def forward(state: np.ndarray, t: int) -> np.ndarray:
        """Rows of label weights, one or ``labels`` of them a block, after step ``t``."""
        moved = state @ step
        new = fresh[:, t]
        moved[new] = state[new].sum(axis=-1, keepdims=True) * start
        moved *= emit[:, t, None, :]
        return moved / moved.max(axis=(-1, -2), keepdims=True)

    products = np.broadcast_to(np.eye(labels), (blocks, labels, labels)).copy()
    for t in range(block):
        products = forward(products, t)
    into, back = np.ones((blocks, 1, labels)), np.ones((blocks, labels))
    for b in range(1, blocks):
        state = into[b - 1] @ products[b - 1]
        into[b] = state / state.max()
    for b in range(blocks - 1, 0, -1):
        state = products[b] @ back[b]
        back[b - 1] = state / state.max()
    out = np.empty((blocks, block, labels))
    state = into
    for t in range(block):
        state = forward(state, t)
        out[:, t] = state[:, 0]
    for t in range(block - 1, -1, -1):
        out[:, t] *= back
        weighed = back * emit[:, t]
        back = np.where(fresh[:, t, None], (weighed * start).sum(axis=1, keepdims=True), weighed @ step.T)
        back = back / back.max(axis=1, keepdims=True)
    out = out.reshape(-1, labels)[:n]
    return out / out.sum(axis=1, keepdims=True)


def _lexicon(samples: dict[int, list[str]]) -> dict[str, int]:
    """Words that stand nearly always in one language, counts weighed by sample size."""
    counts = {label: Counter(words) for label, words in samples.items()}
    shares = {label: {w: n / len(samples[label]) for w, n in found.items()} for label, found in counts.items()}
    out = {}
    for label, found in counts.items():
        own = [
            w
            for w, n in found.items()
            if n >= LEAST_SEEN and shares[label][w] >= LEAST_SHARE * sum(s.get(w, 0.0) for s in shares.values())
        ]
        out.update((w, label) for w in sorted(own, key=lambda w: (-found[w], w))[:LEXICON_WORDS])
    return out


def _chains(samples: dict[int, list[str]]) -> tuple[list[str], np.ndarray]:
    """Words and labels of chains of ``CHAIN`` words that switch languages: segments of
    random length are drawn from the languages' samples until all have been used."""
    dice = np.random.default_rng(7)
    words: list[str] = []
    labels: list[int] = []
    used = dict.fromkeys(samples, 0)
    total = max(map(len, samples.values()))
    while min(used.values()) < total:
        label = min(used, key=lambda x: (used[x] + dice.integers(0, 2 * SEGMENT), x))
        size = int(min(dice.geometric(1 / SEGMENT), 4 * SEGMENT))
        source, at = samples[label], used[label] % len(samples[label])
        part = source[at : at + size]
        words += part
        labels += [label] * len(part)
        used[label] += len(part)
    whole = len(words) - len(words) % CHAIN
    if not whole:
        return words, np.array(labels).reshape(1, -1)
    return words[:whole], np.array(labels[:whole]).reshape(-1, CHAIN)


def _learned(samples: dict[int, list[str]], languages: tuple[str, ...]) -> Model:
    """Weights of greatest conditional likelihood, by Adagrad over all chains."""
    count = len(languages)
    lexicon = _lexicon(samples)
    words, labels = _chains(samples)
    chains, length = labels.shape
    names, flat = np.unique(np.array(words, dtype=object), return_inverse=True)
    names = names.tolist()
    which, bucket = _hashed(names)
    listed = np.array([(i, BUCKETS + lexicon[w]) for i, w in enumerate(names) if w in lexicon], dtype=np.int32)
    if len(listed):
        which, bucket = np.concatenate((which, listed[:, 0])), np.concatenate((bucket, listed[:, 1]))
    weights = np.zeros((BUCKETS + count, count))
    transitions, first = np.zeros((count, count)), np.zeros(count)
    seen = [np.full(x.shape, 1e-6) for x in (weights, transitions, first)]
    flat = flat.reshape(chains, length)
    truth = np.eye(count)[labels]
    pairs = np.zeros((count, count))
    np.add.at(pairs, (labels[:, :-1], labels[:, 1:]), 1)
    begins = np.zeros((chains, length), dtype=bool)
    begins[:, 0] = True
    for _ in range(ROUNDS):
        emissions = np.stack([np.bincount(which, weights[bucket, k], len(names)) for k in range(count)], axis=1)
        scores = emissions[flat]
        single, double = _expected(scores, transitions, first)
        gap = (truth - single).reshape(-1, count)
        by_word = np.stack([np.bincount(flat.ravel(), gap[:, k], len(names)) for k in range(count)], axis=1)
        slopes = (
            np.stack([np.bincount(bucket, by_word[which, k], len(weights)) for k in range(count)], axis=1)
            - DECAY * len(words) * weights,
            pairs - double,
            (truth[:, 0] - single[:, 0]).sum(axis=0),
        )
        for value, slope, sums in zip((weights, transitions, first), slopes, seen, strict=True):
            slope /= len(words)
            sums += slope * slope
            value += RATE * slope / np.sqrt(sums)
    return Model(languages, weights.astype(np.float32), transitions, first, lexicon)


def _expected(scores: np.ndarray, transitions: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of chains of one length, and expected transitions."""
    chains, length, count = scores.shape
    emit = np.exp(scores - scores.max(axis=2, keepdims=True))
    step, start = np.exp(transitions), np.exp(first)
    ahead, behind = np.empty_like(emit), np.ones_like(emit)
    ahead[:, 0] = start * emit[:, 0]
    for t in range(length):
        if t:
            ahead[:, t] = (ahead[:, t - 1] @ step) * emit[:, t]
        ahead[:, t] /= ahead[:, t].sum(axis=1, keepdims=True)
    double = np.zeros((count, count))
    for t in range(length - 1, 0, -1):
        weighed = emit[:, t] * behind[:, t]
        joint = ahead[:, t - 1, :, None] * step * weighed[:, None, :]
        double += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        behind[:, t - 1] = weighed @ step.T
        behind[:, t - 1] /= behind[:, t - 1].sum(axis=1, keepdims=True)
    single = ahead * behind
    return single / single.sum(axis=2, keepdims=True), double


def fit(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    stretches: int = STRETCHES,
) -> Model:
    """A model of the languages named in ``docs``, all of whose rows may be learned from.

    Learned is from about ``stretches`` stretches of ``STRETCH`` characters of each
    language, taken anywhere in its texts by a hash of id and place; that is all that
    comes to the driver. Sentences of one language say nothing on switches, so the
    chains learned from join segments of different languages.

    Rows with a null language or text are left out, as are languages without a letter
    in their sample; other columns are not looked at. Without any row the model knows
    no language. Languages are few: the model holds 130 KB for each.
    """
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), F.col(lang_column).cast("string").alias("lang")
    ).where("text is not null and lang is not null")
    rows = rows.withColumn("places", (F.length("text") / STRETCH).cast("long"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(F.col("places") + 1).alias("n")).collect()}
    if not counts:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0)), np.zeros(0), {})
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, stretches / n)).otherwise(share)
    chosen = F.filter(
        F.sequence(F.lit(0).cast("long"), F.col("places")),
        lambda k: F.pmod(F.xxhash64("id", F.octet_length("text"), k), F.lit(1_000_000)) < F.col("share") * 1_000_000,
    )
    cut = F.transform(chosen, lambda k: F.substring("text", (k * STRETCH + 1).cast("int"), F.lit(STRETCH)))
    found = rows.withColumn("share", share).select("lang", F.explode(cut).alias("text")).collect()
    samples: dict[str, list[str]] = {}
    for lang, text in sorted((r["lang"], r["text"]) for r in found):
        # Words at the borders of a stretch may be cut.
        samples.setdefault(lang, []).extend(words_of(text)[1:-1] or words_of(text))
    languages = tuple(sorted(lang for lang, words in samples.items() if words))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0)), np.zeros(0), {})
    return _learned({i: samples[lang] for i, lang in enumerate(languages)}, languages)


def _judged(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for part in chunks(batches, "text", _CHUNK_BYTES):
            texts = [words_of(text) for text in column(part, "text")]
            counts = np.array([len(words) for words in texts], dtype=np.int64)
            first = np.concatenate(([0], np.cumsum(counts)))
            coded = pa.array([w for words in texts for w in words], pa.string()).dictionary_encode()
            begins = np.zeros(first[-1] + 1, dtype=bool)
            begins[first] = True
            if model.languages:
                scores = model.emissions(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
                each = marginals(scores, begins[:-1], model.transitions, model.first)
                sums = np.concatenate((np.zeros((1, each.shape[1])), np.cumsum(each, axis=0)))
                mean = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(counts, 1)[:, None]
                best, label = mean.argmax(axis=1), each.argmax(axis=1)
                score = np.clip(mean[np.arange(len(counts)), best], 0.0, 1.0)
                best = np.where(counts > 0, best, len(model.languages))
            else:
                best, label = np.zeros(len(counts), dtype=int), np.zeros(first[-1], dtype=int)
                score = np.zeros(len(counts))
            # Spans: words of one label side by side in one document.
            cut = begins[:-1].copy()
            cut[1:] |= label[1:] != label[:-1]
            low = np.flatnonzero(cut)
            high = np.append(low, len(label))[1:]
            owner = np.searchsorted(first, low, side="right") - 1
            spans = pa.StructArray.from_arrays(
                [pa.array(low - first[owner], pa.int64()), pa.array(high - first[owner], pa.int64()), pa.array(names[label[low]], pa.string())],
                names=["start", "stop", "lang"],
            )
            offsets = np.searchsorted(owner, np.arange(len(counts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(names[best], pa.string()),
                    pa.array(np.where(counts > 0, score, 0.0)),
                    pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(offsets), spans),
                ],
                names=["carried", "lang_pred", "score", "n_words", "spans"],
            )

    return run


def language(
    docs: DataFrame, model: Model, text_column: str = "text", carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """One row per document: the ``carry`` columns, ``lang_pred``, ``score`` (the mean
    probability of that language over all words), ``n_words`` (runs of letters) and
    ``spans``, word ranges of one language each, by each word's likeliest one.

    Null texts and those without a letter get ``und``, score 0 and no span, as does
    every text under a model without languages. Of equally likely languages the first
    in order counts. Repeated rows are judged alike; columns that are not carried are
    not looked at, and a carried one may not be named like a result.
    """
    added = [field.split()[0] for field in FOUND.split(", ")]
    if clash := sorted(set(carry) & set(added)):
        raise ValueError(f"carried columns are named like results: {clash}")
    df = whole_texts(docs).select(
        F.struct(*(F.col(c) for c in carry)).alias("carried"), F.col(text_column).cast("string").alias("text")
    )
    kinds = df.schema["carried"].dataType.simpleString()
    return df.mapInArrow(_judged(model), f"carried {kinds}, {FOUND}").select("carried.*", *added)
