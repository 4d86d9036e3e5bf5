"""Public tokenizers applied to whole texts, piece by piece.

Neither vocabulary joins anything across the border from a character that is not
white space to one that is, nor from a letter to the stop that ends its word, so a
text's ids are those of its pieces (white space and what follows it up to the next
white space, stops apart). Pieces repeat far more than texts do; each goes to the
library once, as long as its place in a table of fixed size is not taken by another.
The table is looked up for all pieces at once.
"""

from __future__ import annotations

import os
import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tilldeck.llm.words import KEPT, give_back

# Fixed value: the characters with Unicode's White_Space property.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Texts cut into pieces at once.
TEXT_BYTES = 1 << 20
# Pieces looked up at once, which bounds the memory that a long text takes.
_PIECES = 1 << 18
# Pieces remembered at most, as a power of two, with bytes and ids of each.
_SLOT_BITS, _LONGEST, _MOST_IDS = 20, 15, 8

# Pieces end where one of these bytes follows a character that is no white space.
_SPACE = np.isin(np.arange(256), [*b"\t\n\x0b\x0c\r "])
# A stop between one of these letters and white space or the end is a piece itself.
_LETTER = np.isin(np.arange(256), [*range(0x41, 0x5B), *range(0x61, 0x7B)])
_STOP = np.isin(np.arange(256), [*b",.;:!?"])
_WIDE = [c.encode() for c in map(chr, range(0x80, 0x3001)) if re.match(f"[{WHITE_SPACE}]", c)]
_WIDE_SPACES = {n: [int.from_bytes(c, "big") for c in _WIDE if len(c) == n] for n in (2, 3)}
_STEP_1, _STEP_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)

# Ordinary pieces, at most one plain space in front, are encoded many at a time,
# with a mark between them that each vocabulary encodes as one id of its own.
_ORDINARY = re.compile(f" ?[^{WHITE_SPACE}\x01]+").fullmatch
_MARKS = ("\n", " \x01 ")
_TOGETHER = 512

# Pieces of letters, digits and signs, all known to the library as such, with at most
# one space or line feed in front. What its byte-level pattern makes of them is plain.
_LETTERS, _SIGNS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481\u048a-\u052f\u4e00-\u9fa5", "!-&(-/:;=-@[-`{}~"
_SIMPLE = re.compile(f"[ \n]?[{_LETTERS}0-9{_SIGNS}]+").fullmatch
_SIMPLE_PARTS = re.compile(f"\0|\n| ?(?:[{_LETTERS}]+|[0-9]+|[{_SIGNS}]+)").findall
# Characters that stand for bytes in byte-level vocabularies, where they differ.
_SHOWN = [(chr(b), chr(256 + k)) for k, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD]) if b in b"\n " or b > 0x7F]


def _starts(data: bytes, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of joined texts start. White space beyond ASCII starts none
    and lies inside a piece."""
    plain = np.frombuffer(data, dtype=np.uint8)
    space = _SPACE[plain]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[1:-1] = space[1:] & ~space[:-1]
    at = np.flatnonzero(first)
    beyond = at[plain[at - 1] >= 0x80]
    for size, known in _WIDE_SPACES.items():
        ends = beyond[beyond >= size]
        code = sum(plain[ends - 1 - k].astype(np.int64) << 8 * k for k in range(size))
        first[ends[np.isin(code, known)]] = False
    after = np.append(space, True)
    after[bounds] = True
    stops = np.flatnonzero(_STOP[plain[1:]]) + 1
    first[stops[_LETTER[plain[stops - 1]] & after[stops + 1]]] = True
    first[bounds] = True
    return np.flatnonzero(first[:-1])


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers in bytes.

    A special token that stands literally in a text gets its own id, as by the plain
    library call; with ``ordinary`` it is text like any other."""

    def __init__(self, path: str, ordinary: bool = False) -> None:
        # A task has one core; the library's own threads would each keep memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        # Of each remembered piece its bytes, the last of which is their number, and ids.
        slots = 1 << _SLOT_BITS
        self.keys = np.zeros((2, slots), dtype=np.uint64)
        self.counts = np.zeros(slots, dtype=np.uint8)
        # Slots whose piece came again since another one last wanted their place.
        self.used = np.zeros(slots, dtype=bool)
        self.ids = np.zeros(
            (slots, _MOST_IDS), dtype="<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        )
        marks = ((m, self.tokenizer.encode(m, add_special_tokens=False).ids) for m in _MARKS)
        self.mark, (self.mark_id,) = next((m, ids) for m, ids in marks if len(ids) == 1)
        split, added = self.tokenizer.pre_tokenizer, self.tokenizer.get_added_tokens_decoder().values()
        # The library's model alone gives the ids of parts that its pattern would cut out.
        plain = self.tokenizer.normalizer is None and isinstance(split, ByteLevel) and split.use_regex
        plain = plain and not split.add_prefix_space and all("<" in token.content for token in added)
        self.model = self.tokenizer.model if plain else None

    @classmethod
    def of(cls, path: str, ordinary: bool = False) -> Encoder:
        """The worker's one encoder for a file."""
        key = f"{path} {ordinary}"
        if key not in KEPT:
            KEPT[key] = cls(path, ordinary)
        return KEPT[key]

    @classmethod
    def release(cls) -> None:
        """Frees what encoders in this worker remember, for tasks that read."""
        KEPT.clear()
        give_back()

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(found.ids, dtype="<u4") for found in encoded]

    def _by_model(self, pieces: list[str]) -> tuple[np.ndarray, list[int]]:
        """Ids of simple pieces one after another, and how many each has."""
        parts = _SIMPLE_PARTS("\0".join([*pieces, ""]))
        text = "\x01".join(parts).encode().decode("latin-1")
        for byte, shown in _SHOWN:
            text = text.replace(byte, shown)
        ids: list[int] = []
        ends = [0]
        for part in text.split("\x01") if parts else ():
            if part == "\0":
                ends.append(len(ids))
            else:
                ids += [token.id for token in self.model.tokenize(part)]
        return np.array(ids, dtype="<u4"), np.diff(ends).tolist()

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pieces one after another, and how many each has."""
        counts = np.zeros(len(pieces), dtype=np.int64)
        simple, plain, rest = [], [], []
        for i, piece in enumerate(pieces):
            kind = simple if self.model and _SIMPLE(piece) else plain if _ORDINARY(piece) else rest
            kind.append(i)
        direct, counts[simple] = self._by_model([pieces[i] for i in simple])
        groups = [plain[i : i + _TOGETHER] for i in range(0, len(plain), _TOGETHER)]
        found = self._library([self.mark.join([pieces[i] for i in g]) for g in groups])
        for group, ids in zip(groups, found, strict=True):
            ends = np.concatenate((np.flatnonzero(ids == self.mark_id), [len(ids)]))
            counts[group] = np.diff(ends, prepend=-1) - 1
        own = self._library([pieces[i] for i in rest])
        counts[rest] = [len(ids) for ids in own]
        flat = np.concatenate([direct, *(ids[ids != self.mark_id] for ids in found), *own])
        # From the order of encoding back to that of the pieces.
        order = np.array(simple + plain + rest, dtype=np.int64)
        start = np.empty(len(pieces), dtype=np.int64)
        start[order] = np.cumsum(counts[order]) - counts[order]
        return flat[_spread(start, counts)], counts

    def _looked_up(self, data: bytes, eight: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and how many each has."""
        length = stops - starts
        low = eight[starts] & _LOW_BYTES[np.minimum(length, 8)]
        high = eight[starts + 8] & _LOW_BYTES[np.clip(length - 8, 0, 7)]
        high |= np.minimum(length, 255).astype(np.uint64) << np.uint64(56)
        slot = (low * _STEP_1) ^ (high * _STEP_2)
        slot = ((slot ^ (slot >> np.uint64(32))) * _STEP_1 >> np.uint64(64 - _SLOT_BITS)).view(np.int64)
        # All bytes are compared, so a slot's ids are those of this piece.
        hit = (self.keys[0][slot] == low) & (self.keys[1][slot] == high) & (length <= _LONGEST)
        miss = np.flatnonzero(~hit)
        beside = slot[miss] ^ 1
        there = (self.keys[0][beside] == low[miss]) & (self.keys[1][beside] == high[miss]) & (length[miss] <= _LONGEST)
        slot[miss[there]] = beside[there]
        hit[miss[there]] = True
        miss = miss[~there]
        counts, base = self.counts[slot].astype(np.int64), slot * _MOST_IDS
        seen: dict[bytes, int] = {}
        which = [seen.setdefault(data[a:b], len(seen)) for a, b in zip(starts[miss].tolist(), stops[miss].tolist(), strict=True)]
        new, n = self._encoded([piece.decode() for piece in seen])
        at = np.cumsum(n) - n
        counts[miss], base[miss] = n[which], at[which]
        from_table = np.repeat(hit, counts)
        place = _spread(base, counts)
        ids = np.empty(len(place), dtype="<u4")
        ids[from_table] = self.ids.reshape(-1)[place[from_table]]
        ids[~from_table] = new[place[~from_table]]
        self.used[slot[hit]] = True
        # One new piece a slot is remembered, in the less used of two neighbours. A place
        # in use is kept once.
        fit = miss[(length[miss] <= _LONGEST) & (counts[miss] <= _MOST_IDS)]
        pair = slot[fit] ^ np.array([[0], [1]])
        use = (self.keys[1][pair] > 0) + self.used[pair].view(np.int8)
        own, first = np.unique(np.where(use[1] < use[0], pair[1], pair[0]), return_index=True)
        busy = self.used[own]
        self.used[own] = False
        fit, own = fit[first[~busy]], own[~busy]
        self.keys[0][own], self.keys[1][own], self.counts[own] = low[fit], high[fit], counts[fit]
        inside = np.arange(_MOST_IDS) < counts[fit][:, None]
        rows = np.zeros(inside.shape, dtype=self.ids.dtype)
        rows[inside] = new[_spread(base[fit], counts[fit])]
        self.ids[own] = rows
        return ids, counts

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        encoded = [(text or "").encode() for text in texts]
        data = b"".join(encoded)
        bounds = np.cumsum([0, *map(len, encoded)])
        if not data:
            return [b""] * len(texts)
        eight = np.ndarray((len(data) + 9,), dtype="<u8", buffer=data + bytes(16), strides=(1,))
        starts = _starts(data, bounds)
        stops = np.append(starts[1:], len(data))
        parts, counts = [], [np.zeros(1, dtype=np.int64)]
        for low in range(0, len(starts), _PIECES):
            ids, n = self._looked_up(data, eight, starts[low : low + _PIECES], stops[low : low + _PIECES])
            parts.append(ids.tobytes())
            counts.append(n)
        flat = b"".join(parts)
        cuts = 4 * np.cumsum(np.concatenate(counts))[np.searchsorted(starts, bounds)]
        return [flat[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i]`` and the ``counts[i] - 1`` numbers after it, for each ``i``."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def tokenizer_path(name: str) -> str:
    return public_tokenizers.path(name)
