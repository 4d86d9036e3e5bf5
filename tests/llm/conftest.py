from __future__ import annotations

import pytest

TOXIC = ("loser", "idiot", "scum")


def _sentence(seed: int, words: int) -> str:
    """Invented words, the same for the same seed."""
    state, out = seed * 7919 + 17, []
    for _ in range(words):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append("".join("bcdfglmnprst"[(state >> s) % 12] + "aeiou"[(state >> (s + 5)) % 5] for s in (3, 9, 15)))
    return " ".join(out)


@pytest.fixture(scope="session")
def sentence():
    return _sentence


@pytest.fixture(scope="session")
def documents(spark):
    """Copies, near copies, shared passages, repeated rows, blanks, nulls, one long
    text, and columns whose names clash with those of the operators."""
    shared = _sentence(1, 35)
    base = _sentence(2, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base),
        (2, " ".join(near)),
        (3, base.upper()),
        (4, base),
        (5, f"{_sentence(3, 30)} {shared} {_sentence(4, 30)}"),
        (6, f"{_sentence(5, 7)}\n\t{shared} tail {_sentence(6, 31)}"),
        (7, shared),
        (8, ""),
        (9, None),
        (10, " \n\t "),
        (11, "Three short WORDS"),
        (12, "three SHORT words"),
        (13, f"{shared} x {shared} {shared}"),
        (14, _sentence(7, 19)),
        (15, _sentence(7, 19)),
        (16, "aaaaa" * 2000),
        (17, " ".join(["same"] * 400)),
        (18, f"{_sentence(8, 20)} idiot {_sentence(9, 20)} été naïve"),
        (19, " ".join(_sentence(20 + i % 9, 500) for i in range(20))),
        (20, base),
        (20, base),
        (-3, _sentence(30, 60)),
        (21, _sentence(30, 60)),
        (None, base),
    ]
    extra = "n_words long, hits long, spans string, component_id long, carried string, kept_text string, lang string, source string, n_chars long"
    return spark.createDataFrame(
        [(i, t, 1, 2, "s", 3, "c", "k", "en", "web", len(t or "")) for i, t in rows], f"doc_id long, text string, {extra}"
    )


@pytest.fixture(scope="session")
def texts(documents):
    """Id and text of every row, in id order."""
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
