"""Adaptive context-mixing range coder for runs of token ids.

Three models each predict one id: what followed the last two ids (order 2), what
followed the last one (order 1), and what last had the same low byte (order 0).
One symbol says which prediction holds, if any. Its probabilities are mixed from
the adaptive counts of all three contexts and drive a range coder that puts out
words of 16 bits. Bytes that no model predicts are kept beside it.

Every block starts from scratch, so blocks are coded side by side: each numpy
step handles the next id of all of them. All arithmetic is on integers, so any
machine decodes what another has written.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

BLOCK_IDS = 4096
# Blocks coded side by side, which bounds the memory of the tables.
LANES = 2048
MAGIC = b"TKB3"
_HEADER = "<4sIIBII"
_CONTEXTS, _CONTEXT_SHIFT = 1024, np.uint64(54)
_SLOTS = 256
_LEVELS = 4
_OUTCOMES = 4
# Steps whose known parts are computed at once when encoding.
_STRIP = 16
# The range coder keeps 48 bits and puts out a word after every second id at most. An
# outcome has at least 128 parts of 4,096, so of the least span 2^32 two leave 2^21.
_WHOLE, _BOTTOM, _TOTAL, _EVERY = np.uint64((1 << 48) - 1), np.uint64(1 << 32), np.uint64(12), 2
_LOW_32 = np.uint64(0xFFFFFFFF)
# Counts of an outcome and all before it, 16 bits each in one 64-bit number, the first
# one lowest. The last one stays 1,024, and neighbours stay 32 apart at least. Order 1
# counts twice, so the mixture's last one is 4,096.
_FIRST = np.uint64(512 | 768 << 16 | 896 << 32 | 1024 << 48)
_RATE, _DECAYED = np.uint64(5), np.uint64(0x07FF07FF07FF07FF)
# Counts lose 1/32; an outcome adds 29 to its own and all later ones, each 1 to itself.
_GAIN = np.array([sum((k + 1 + 28 * (k >= own)) << (16 * k) for k in range(4)) for own in range(4)], dtype=np.uint64)
_NEXT = np.array([1, 2, 3, 3, 0])
_STEP_1, _STEP_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SHIFT = np.array([0, 16, 32, 48], dtype=np.uint64)
_FIELD = np.uint64(0xFFFF)


class _Models:
    """Predictions and counts of all blocks.

    A table entry is the predicted id and, in the two lowest bits, how often in a row
    it held. Order 2 and order 1 are the two rows of each array and change in one step;
    the counts have a third row for the context that is always the same.
    """

    def __init__(self, lanes: int, wide: int) -> None:
        # Ids of two bytes and their level fit into 32 bits, which halves the tables.
        self.kind, unknown = (np.uint32, 0xFFFF) if wide <= 2 else (np.uint64, 0xFFFFFFFF)
        self.table = np.full(2 * lanes * _CONTEXTS, self.kind(unknown << 2))
        self.slot = np.full(lanes * _SLOTS, unknown, dtype=np.uint32)
        self.counts = np.full((2 * _LEVELS + 1) * lanes, _FIRST)
        # Entries of one context lie side by side, as blocks share the frequent ones.
        self.lanes, self.lane = lanes, np.arange(lanes)
        self.by_context = self.lane + np.array([[0], [lanes * _CONTEXTS]])
        self.by_slot = self.lane * _SLOTS
        self.by_level = self.lane + np.array([[0], [lanes * _LEVELS]])
        self.row = np.repeat(self.lane[None] + 2 * lanes * _LEVELS, 3, axis=0)
        self.next = _NEXT.astype(self.kind)

    def places(self, ids: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Where the entries of what follows ``before`` and ``ids`` lie."""
        both = np.empty((*ids.shape[:-1], 2, ids.shape[-1]), dtype=np.uint64)
        two, one = both[..., 0, :], both[..., 1, :]
        np.multiply(ids, _STEP_1, out=one)
        np.multiply(before, _STEP_2, out=two)
        two ^= one
        both >>= _CONTEXT_SHIFT
        both = both.view(np.int64)
        both *= self.lanes
        both += self.by_context[:, : ids.shape[-1]]
        return both

    def slots_of(self, ids: np.ndarray) -> np.ndarray:
        """Where the last ids with the same low byte lie."""
        return (ids & np.uint32(255)) + self.by_slot[: ids.shape[-1]]

    def replace(self, at: np.ndarray, entry: np.ndarray, ids: np.ndarray) -> None:
        """Predicts ``ids``, which came where ``entry`` stood."""
        ids = ids.astype(self.kind) << self.kind(2)
        held = entry - ids
        np.minimum(held, self.kind(_LEVELS), out=held)
        entry = self.next.take(held)
        entry += ids
        self.table[at] = entry

    def mixed(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the three contexts in ``row``, and their mixture."""
        seen = self.counts.take(row)
        upto = seen[0] + seen[1]
        upto += seen[1]
        upto += seen[2]
        return seen, upto

    def count(self, row: np.ndarray, seen: np.ndarray, gain: np.ndarray) -> None:
        lost = seen >> _RATE
        lost &= _DECAYED
        seen -= lost
        seen += gain
        self.counts[row] = seen


def _bytes_of(ids: list[np.ndarray]) -> int:
    """Bytes of an id that no model predicts."""
    return 2 if max((int(i.max()) for i in ids if len(i)), default=0) < (1 << 16) - 1 else 4


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Each run of unsigned 32-bit ids as one self-contained block of bytes:
    magic, number of ids, crc32 of the ids, bytes of a literal, lengths of the
    coded and of the plain part, both parts."""
    out: list[bytes] = []
    for low in range(0, len(blocks), LANES):
        out += _encode(blocks[low : low + LANES])
    return out


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    runs = [blocks[i].astype(np.uint32) for i in order]
    lengths = np.array([len(r) for r in runs])
    longest = int(lengths[0]) if len(runs) else 0
    wide = _bytes_of(runs)
    by_lane = np.zeros((len(runs), longest), dtype="<u4")
    for lane, run in enumerate(runs):
        by_lane[lane, : len(run)] = run
    ids = _turned(by_lane)
    lanes = len(runs)
    models = _Models(lanes, wide)
    width = longest // _EVERY + 5
    words, at = np.zeros(lanes * width, dtype=np.uint32), np.arange(lanes) * width
    outcomes = np.zeros((longest, lanes), dtype=np.uint8)
    base, span = np.zeros(lanes, dtype=np.uint64), np.full(lanes, _WHOLE)
    for low, high, n in _strips(lengths, longest):
        own = ids[low:high, :n]
        before = np.zeros((high - low + 2, n), dtype=np.uint32)
        before[max(2 - low, 0) :] = ids[max(low - 2, 0) : high, :n]
        places, slots = models.places(before[1:-1], before[:-2]), models.slots_of(own)
        entries = np.empty((high - low, 2, n), dtype=models.kind)
        third = np.empty((high - low, n), dtype=np.uint32)
        for k in range(high - low):
            models.table.take(places[k], out=entries[k], mode="clip")
            models.replace(places[k], entries[k], own[k])
            models.slot.take(slots[k], out=third[k], mode="clip")
            models.slot[slots[k]] = own[k]
        missed = (entries >> models.kind(2)) != own[:, None]
        two, one = missed[:, 0].view(np.uint8), missed[:, 1].view(np.uint8)
        outcome = two * (one * ((third != own).view(np.uint8) + one) + two)
        outcomes[low:high, :n] = outcome
        rows = np.empty((high - low, 3, n), dtype=np.int64)
        rows[:] = models.row[:, :n]
        rows[:, :2] = (entries & models.kind(3)).astype(np.int64) * lanes + models.by_level[:, :n]
        gain, mixture = _GAIN.take(outcome), np.empty((high - low, n), dtype=np.uint64)
        for k in range(high - low):
            seen, mixture[k] = models.mixed(rows[k])
            models.count(rows[k], seen, gain[k])
        # Below outcome 0 lies nothing; the shift brings in a zero there.
        shift = _SHIFT.take(outcome)
        below = ((mixture << np.uint64(16)) >> shift) & _FIELD
        size = ((mixture >> shift) & _FIELD) - below
        for k in range(high - low):
            share = span[:n] >> _TOTAL
            base[:n] += share * below[k]
            np.multiply(share, size[k], out=span[:n])
            if (low + k) % _EVERY == _EVERY - 1:
                due = np.flatnonzero(span[:n] < _BOTTOM)
                left = base.take(due)
                to = at.take(due)
                # A carry is the 17th bit of the next word that is put out.
                words[to] = left >> np.uint64(32)
                at[due] = to + 1
                base[due] = (left & _LOW_32) << np.uint64(16)
                span[due] <<= np.uint64(16)
    for shift in (32, 16, 0):
        words[at] = base >> np.uint64(shift)
        base &= np.uint64((1 << shift) - 1)
        at += 1
    at -= np.arange(lanes) * width
    carried = np.flatnonzero(words >> np.uint32(16))
    words = words.astype("<u2")
    _carry(words, carried - 1)
    words = words.reshape(lanes, width)
    # Plain bytes: the slot for a slot's id, the whole id for a new one. Places past
    # the end of a run have outcome 0.
    outcomes = _turned(outcomes)
    kept = np.empty((len(runs), longest, wide), dtype=bool)
    kept[:, :, 0] = outcomes >= 2
    kept[:, :, 1:] = (outcomes == 3)[:, :, None]
    ends = np.cumsum(np.count_nonzero(kept.reshape(len(runs), -1), axis=1)).tolist()
    kept, plain = kept.reshape(-1), by_lane.view(np.uint8).reshape(len(runs), longest, 4)[:, :, :wide]
    plain = plain.reshape(-1)[kept].tobytes()
    done = [b""] * len(runs)
    for lane, (place, run) in enumerate(zip(order, runs, strict=True)):
        coded, rest = words[lane, : at[lane]].tobytes(), plain[ends[lane - 1] if lane else 0 : ends[lane]]
        check = zlib.crc32(run.astype("<u4").tobytes())
        done[place] = struct.pack(_HEADER, MAGIC, len(run), check, wide, len(coded), len(rest)) + coded + rest
    return done


def _strips(lengths: np.ndarray, longest: int) -> Iterator[tuple[int, int, int]]:
    """Steps from and to which the same number of blocks, sorted by falling length,
    still have ids; a strip's arrays stay in the cache."""
    borders = {*range(0, longest, _STRIP), *lengths.tolist()}
    borders = sorted(b for b in borders if b < longest) + [longest]
    for low, high in zip(borders, borders[1:], strict=False):
        yield low, high, int(np.searchsorted(-lengths, -low, side="left"))


def _turned(values: np.ndarray) -> np.ndarray:
    """The transposed array, copied in strips that stay in the cache."""
    out = np.empty(values.shape[::-1], dtype=values.dtype)
    for low in range(0, values.shape[1], 64):
        out[low : low + 64] = values[:, low : low + 64].T
    return out


def _carry(words: np.ndarray, places: np.ndarray) -> None:
    """Adds one to words already put out; a word that overflows passes it on."""
    while len(places):
        words[places] += np.uint16(1)
        places = places[words[places] == 0] - 1


def split_block(data: bytes | memoryview, start: int) -> tuple[tuple, int]:
    """The block at ``start`` in its parts, and where it ends."""
    magic, count, check, wide, coded, plain = struct.unpack_from(_HEADER, data, start)
    if magic != MAGIC:
        raise ValueError(f"no block of ids at byte {start}")
    begin = start + struct.calcsize(_HEADER)
    end = begin + coded + plain
    if end > len(data):
        raise ValueError(f"the block at byte {start} is cut off")
    return (count, check, wide, data[begin : begin + coded], data[begin + coded : end]), end


def decode_blocks(blocks: list[tuple]) -> list[np.ndarray]:
    """The ids of blocks from ``split_block``; a wrong checksum is an error."""
    out: list[np.ndarray] = []
    for low in range(0, len(blocks), LANES):
        out += _decode(blocks[low : low + LANES])
    return out


def _decode(blocks: list[tuple]) -> list[np.ndarray]:
    order = sorted(range(len(blocks)), key=lambda i: -blocks[i][0])
    lengths = np.array([blocks[i][0] for i in order])
    longest = int(lengths[0]) if len(blocks) else 0
    lanes = len(blocks)
    # More than there is: the last words and bytes of a damaged block may be overrun.
    width = max((len(b[3]) // 2 for b in blocks), default=0) + 4
    words = np.zeros((lanes, width), dtype="<u2")
    length = max((len(b[4]) for b in blocks), default=0) + 8
    plain = np.zeros((lanes, length), dtype=np.uint8)
    wides = np.array([blocks[i][2] for i in order])
    for lane, i in enumerate(order):
        words[lane, : len(blocks[i][3]) // 2] = np.frombuffer(blocks[i][3], dtype="<u2")
        plain[lane, : len(blocks[i][4])] = np.frombuffer(blocks[i][4], dtype=np.uint8)
    code = words[:, :3].astype(np.uint64) @ np.array([1 << 32, 1 << 16, 1], dtype=np.uint64)
    words, plain = words.reshape(-1), plain.reshape(-1)
    at, rest = np.arange(lanes) * width + 3, np.arange(lanes) * length
    most = int(wides.max()) if lanes else 0
    models = _Models(lanes, most)
    ids = np.zeros((longest, lanes), dtype=np.uint32)
    span = np.full(lanes, _WHOLE)
    # Bytes that each outcome takes from the plain part.
    used = np.stack((0 * wides, 0 * wides, 0 * wides + 1, wides)).astype(np.int64)
    for low, high, n in _strips(lengths, longest):
        lane, row = models.lane[:n], models.row[:, :n].copy()
        # Where each outcome's part of the span begins and ends, and its id.
        ends = np.zeros((_OUTCOMES + 1, n), dtype=np.uint64)
        choice = np.empty((_OUTCOMES, n), dtype=np.uint32)
        taken, narrow = np.ascontiguousarray(used[:, :n]), wides[:n] == 2
        nothing = np.zeros(n, dtype=np.uint32)
        last = ids[low - 1, :n] if low else nothing
        before = ids[low - 2, :n] if low > 1 else nothing
        for step in range(low, high):
            place = models.places(last, before)
            entry = models.table.take(place)
            row[:2] = entry & models.kind(3)
            row[:2] *= lanes
            row[:2] += models.by_level[:, :n]
            seen, upto = models.mixed(row)
            share = span[:n] >> _TOTAL
            parts = upto.astype("<u8", copy=False).view("<u2").reshape(n, _OUTCOMES)
            np.multiply(parts.T, share, out=ends[1:])
            over = (code[:n] >= ends[1:4]).view(np.uint8)
            outcome = over[0] + over[1]
            outcome += over[2]
            own_part = outcome * np.int64(n)
            own_part += lane
            # The slot's id and the plain one are looked up whether needed or not.
            byte = plain.take(rest[:n], mode="clip")
            choice[:2] = entry >> models.kind(2)
            models.slot.take(models.by_slot[:n] + byte, out=choice[2], mode="clip")
            whole = byte.astype(np.uint32)
            for k in range(1, most):
                byte = plain.take(rest[:n] + k, mode="clip").astype(np.uint32)
                byte <<= np.uint32(8 * k)
                if k > 1:
                    byte[narrow] = 0
                whole |= byte
            choice[3] = whole
            own = choice.take(own_part)
            rest[:n] += taken.take(own_part)
            ids[step, :n] = own
            models.replace(place, entry, own)
            models.slot[models.slots_of(own)] = own
            models.count(row, seen, _GAIN.take(outcome))
            below = ends.take(own_part)
            code[:n] -= below
            own_part += n
            np.subtract(ends.take(own_part), below, out=span[:n])
            if step % _EVERY == _EVERY - 1:
                due = np.flatnonzero(span[:n] < _BOTTOM)
                to = at.take(due)
                code[due] = (code.take(due) << np.uint64(16)) | words.take(to, mode="clip")
                at[due] = to + 1
                span[due] <<= np.uint64(16)
            last, before = own, last
    out: list[np.ndarray] = [np.empty(0, dtype=np.uint32)] * lanes
    ids = _turned(ids)
    for lane, place in enumerate(order):
        run = ids[lane, : lengths[lane]].copy()
        if zlib.crc32(run.astype("<u4").tobytes()) != blocks[place][1]:
            raise ValueError("a block of ids does not match its checksum")
        out[place] = run
    return out
