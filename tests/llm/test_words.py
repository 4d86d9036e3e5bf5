from __future__ import annotations

import numpy as np
import pyarrow as pa

from tilldeck.llm.words import (
    LETTER_DIGIT,
    LONG_WORD,
    Words,
    chunks,
    packed_ids,
    planes,
    unpacked_ids,
    unplaned,
)


def test_word_borders_and_equal_hashes():
    texts = [b"One two  one\t", None, b"", b"two", ("x" * (LONG_WORD + 9)).encode(), b"one" + b" " * 5000 + b"two"]
    words = Words.of(texts)
    found = [words.data[a:b] for a, b in zip(words.starts, words.ends, strict=True)]
    assert found == [w for t in texts for w in (t or b"").split()]
    assert words.counts.tolist() == [3, 0, 0, 1, 1, 2]
    by_word: dict[bytes, set[int]] = {}
    for word, value in zip(found, words.hashes().tolist(), strict=True):
        by_word.setdefault(word, set()).add(value)
    assert all(len(v) == 1 for v in by_word.values())
    assert len({min(v) for v in by_word.values()}) == len(by_word)


def test_letters_and_digits_lower_ascii_only():
    words = Words.of(["ÉTÉ-Café x1_y\x7f".encode()], letters=LETTER_DIGIT, lower=True)
    found = [words.data[a:b].decode() for a, b in zip(words.starts, words.ends, strict=True)]
    assert found == ["ÉtÉ", "café", "x1", "y"]


def test_windows_stay_inside_documents():
    texts = [b"a b c d", b"b c", b"x a b c", b""]
    words = Words.of(texts)
    hashes, at = words.windows(3)
    assert at.tolist() == [0, 1, 6, 7]
    assert hashes[0] == hashes[3] and len(set(hashes.tolist())) == 3
    assert not len(Words.of([b"a"]).windows(3)[0])


def test_packed_integers_come_back():
    values = np.array([0, 1, 255, 256, 70_000, 2**31])
    assert unplaned(planes(values)).tolist() == values.tolist()
    ids = np.array([-(2**62), -5, 0, 0, 7, 2**62])
    assert unpacked_ids(packed_ids(ids)).tolist() == ids.tolist()


def test_chunks_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": [b"a" * 30, None, b"b" * 80, b"", b"c" * 5]})
    parts = list(chunks(iter([batch]), "text", 50))
    assert [v for p in parts for v in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert len(parts) > 1
