"""Tokenizer pieces, token files, separator scan and packing."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tilldeck.llm import tokens
from tilldeck.llm.coder import _GAIN, _carry, _Models, decode_blocks, encode_blocks, split_block
from tilldeck.llm.flat_tokens import document_token_counts, write_flat_tokens
from tilldeck.llm.packing import pack_documents
from tilldeck.llm.token_files import _frame, read_frames, read_token_files, write_token_files
from tilldeck.llm.tokens import WHITE_SPACE, Encoder, tokenizer_path
from tilldeck.session import scratch_dir

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")


def whole(name, texts, ordinary=False):
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    tokenizer.encode_special_tokens = ordinary
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", NAMES)
@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.lists(
            st.sampled_from([*"ab'sÉé\u0301 \t\n\r\x1c\x85\xa0\u2003\u3000.1é<|end>of", "<|endoftext|>", "<|startoftext|>"]),
            max_size=40,
        ).map("".join),
        max_size=4,
    )
)
def test_pieces_give_the_ids_of_whole_texts(name, texts):
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in Encoder.of(tokenizer_path(name))(texts)]
    assert got == whole(name, texts)


@pytest.mark.parametrize("ordinary", [True, False])
def test_special_tokens_in_a_text(ordinary):
    texts = ["a <|endoftext|> b", "x" * 300 + "<|endoftext|>", "one  <|endoftext|>two<|endoftext|>"]
    for name, special in zip(NAMES, (50256, 49407), strict=True):
        encode = Encoder(tokenizer_path(name), ordinary)
        got = [np.frombuffer(b, dtype="<u4").tolist() for b in encode(texts)]
        assert got == whole(name, texts, ordinary)
        assert all((special in ids) is not ordinary for ids in got)


@pytest.mark.parametrize("name", NAMES)
def test_pieces_by_a_small_table(monkeypatch, name):
    monkeypatch.setattr(tokens, "_SLOT_BITS", 3)
    monkeypatch.setattr(tokens, "_PIECES", 7)
    encode = Encoder(tokenizer_path(name))
    texts = [
        "Ends, of. words; with: stops! and? more.", "no.stop a.\u03a3 \u03a3. b,\x85c e\u0301, don't. it's, 'll.", "x.",
        ".", "", None, "a\xa0 b\u3000 c\u00e9 d\u2003", "nul\0 nul nul\0\0", "fifteen_bytes__ sixteen__bytes__",
        "\u0130\u0130\u0130\u0130\u0130\u0130\u0130", "\ud7ff\U0001f600 " * 9, " \n", "same " * 40, "a<|endoftext|>, b.<|endoftext|>.",
    ]
    for _ in range(2):
        got = [np.frombuffer(b, dtype="<u4").tolist() for b in encode(texts)]
        assert got == whole(name, texts)


def test_a_piece_goes_to_the_library_once(monkeypatch):
    """More pieces than a dictionary of 300,000 held, over texts of a megabyte."""
    encode, sent = Encoder(tokenizer_path(NAMES[1])), []
    library = encode._encoded
    monkeypatch.setattr(encode, "_encoded", lambda pieces: (sent.append(len(pieces)), library(pieces))[1])
    texts = [" ".join(f"{k:x}," for k in range(i, 1_000_000, 10)[:40_000]) for i in range(10)]
    first = [encode([t]) for t in texts]
    assert 390_000 < sum(sent) <= 400_100
    sent.clear()
    assert [encode([t]) for t in texts] == first
    assert sum(sent) < 200_000


def test_simple_pieces_by_the_model_alone(monkeypatch):
    """Every letter and sign that counts as simple; the library's pattern is not needed."""
    encode = Encoder(tokenizer_path(NAMES[0]))
    monkeypatch.setattr(encode, "_library", lambda pieces: [pytest.fail(p) for p in pieces])
    known = [c for c in map(chr, range(0x2FFFF)) if tokens._SIMPLE(c) and c not in " \n"]
    signs = [c for c in known if ord(c) < 0x80 and not c.isalnum()]
    assert len(known) > 21_000 and not {"'", "<", "|"} & {*signs} and len(signs) == 29
    texts = [f"{c}a{c}9{c} {c}b{c}!\n{c}{c}" for c in known]
    texts += [f"{a}{b} x{a}{b}y\n{a}7{b}" for a in signs for b in signs]
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in encode(texts)]
    assert got == whole(NAMES[0], texts)


def test_a_piece_in_use_keeps_its_place(monkeypatch):
    monkeypatch.setattr(tokens, "_SLOT_BITS", 1)
    encode, sent = Encoder(tokenizer_path(NAMES[0])), []
    encoded = encode._encoded
    monkeypatch.setattr(encode, "_encoded", lambda pieces: (sent.append(len(pieces)), encoded(pieces))[1])
    texts = ["often", "often", "once", "often", "other", "often", "once", "often", "once"]
    assert [np.frombuffer(encode([t])[0], dtype="<u4").tolist() for t in texts] == whole(NAMES[0], texts)
    assert sent == [1, 0, 1, 0, 1, 0, 1, 0, 0]


def test_white_space_is_unicodes():
    expected = [c for c in map(chr, range(0x110000)) if c.isspace() and not "\x1c" <= c <= "\x1f"]
    import re

    assert [c for c in map(chr, range(0x110000)) if re.match(f"[{WHITE_SPACE}]", c)] == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60) | st.integers(0, 2**32 - 1), max_size=300), max_size=6))
def test_coder_round_trip(runs):
    blocks = [np.array(r, dtype=np.uint32) for r in runs]
    coded = encode_blocks(blocks)
    back = decode_blocks([split_block(c, 0)[0] for c in coded])
    assert [b.tolist() for b in back] == runs


def test_coder_on_whole_blocks():
    draw = np.random.default_rng(11)
    for most in (50_000, 2**32 - 1):
        runs = [draw.zipf(1.3, n).clip(0, most).astype(np.uint32) for n in draw.integers(0, 4096, 40)]
        runs += [np.tile(run[:50], 30) for run in runs[:10]]
        parts = [split_block(c, 0)[0] for c in encode_blocks(runs)]
        assert all(np.array_equal(a, b) for a, b in zip(decode_blocks(parts), runs, strict=True))
        # A word of 16 bits after every second id at most, and three at the end.
        assert all(len(p[3]) <= len(run) + 6 for p, run in zip(parts, runs, strict=True))


def test_counts_leave_every_outcome_its_part():
    """What the coder's 48 bits rest on, after any outcomes."""
    draw, models = np.random.default_rng(12), _Models(64, 2)
    row = models.row.copy()
    row[:2] = models.by_level
    often = draw.dirichlet([0.3] * 4, 64)
    for step in range(3_000):
        outcome = [draw.choice(4, p=p) for p in often] if step % 10 == 0 else outcome
        seen, upto = models.mixed(row)
        fields = np.diff(upto.astype("<u8").view("<u2").reshape(-1, 4).astype(np.int64), prepend=0)
        assert fields.min() >= 128 and (fields.sum(axis=1) == 4096).all()
        models.count(row, seen, _GAIN.take(outcome))


def test_coder_finds_repeats_and_damage():
    run = np.tile(np.arange(100, 160, dtype=np.uint32), 60)
    noise = np.random.default_rng(3).integers(0, 50_000, 4096).astype(np.uint32)
    coded, other = encode_blocks([run, noise])
    assert len(coded) < len(run) // 4 and len(other) < 2.2 * len(noise)
    broken = bytearray(other)
    broken[-1] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        decode_blocks([split_block(bytes(broken), 0)[0]])
    with pytest.raises(ValueError, match="cut off"):
        split_block(other[:-1], 0)


def test_blocks_of_narrow_and_wide_ids_decode_together():
    draw = np.random.default_rng(5)
    runs = [[65_534] * 40 + [0, 65_534], [65_535, 1] * 30, draw.integers(0, 2**32, 500).tolist(), [2**32 - 1] * 50, []]
    coded = [encode_blocks([np.array(r, dtype=np.uint32)])[0] for r in runs]
    back = decode_blocks([split_block(c, 0)[0] for c in coded])
    assert [b.tolist() for b in back] == runs
    assert [split_block(c, 0)[0][2] for c in coded] == [2, 4, 4, 4, 2]


def test_words_of_the_coder_carry():
    words = np.array([7, 0xFFFF, 0xFFFF, 3, 9, 0xFFFF], dtype="<u2")
    _carry(words, np.array([2, 3, 5]))
    assert words.tolist() == [8, 0, 0, 4, 10, 0]
    # A word is put out at most once an id, plus two at the end.
    run = np.random.default_rng(6).integers(0, 300, 5_000).astype(np.uint32)
    block = encode_blocks([run])[0]
    assert len(split_block(block, 0)[0][3]) % 2 == 0


def test_any_damage_is_a_value_error():
    draw = np.random.default_rng(7)
    run = draw.zipf(1.4, 300).clip(0, 60_000).astype(np.uint32)
    block = encode_blocks([run])[0]
    for at in draw.integers(21, len(block), 60).tolist():
        broken = bytearray(block)
        broken[at] ^= 1 << at % 8
        try:
            assert decode_blocks([split_block(bytes(broken), 0)[0]])[0].tolist() == run.tolist()
        except ValueError as error:
            assert "checksum" in str(error)


def test_token_files(spark, documents, texts):
    path = scratch_dir(spark, "test-token-files")
    write_token_files(documents, path, block_ids=64)
    rows = read_token_files(spark, path, keep_ids=True).collect()
    ordered = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids = [[*i, 0] for i in whole(NAMES[0], [t for _, t in ordered])]
    expected, at = [], 0
    for (node, _), own in zip(ordered, ids, strict=True):
        blob = np.array(own, dtype="<u4").tobytes()
        expected.append((node, at, len(own), zlib.crc32(blob), blob))
        at += len(own)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in rows), key=lambda r: r[1])
    assert got == expected


def test_damaged_token_file():
    frame = _frame([4, None], [bytes(8), bytes(4)], 64)
    assert [(n, s.tolist(), i.tolist()) for n, s, i in read_frames(frame + b"\n")] == [([4, None], [2, 1], [0, 0, 0])]
    for broken in (b"x" + frame[1:], frame[:30] + b"?" + frame[31:]):
        with pytest.raises(ValueError, match="damaged"):
            list(read_frames(broken + b"\n"))
    with pytest.raises(ValueError, match="length"):
        list(read_frames(frame))


@pytest.mark.parametrize("block_bytes", [1 << 20, 64, 2])
def test_separator_scan(spark, documents, texts, block_bytes):
    path = scratch_dir(spark, "test-flat")
    write_flat_tokens(documents.where("coalesce(doc_id, 0) != 19").coalesce(2), path)
    rows = document_token_counts(spark, path, block_bytes).collect()
    expected = Counter(len(i) for i in whole(NAMES[0], [t for d, t in texts if d != 19]))
    assert Counter(r.n_tokens for r in rows) == expected and all(r.closed for r in rows)
    for part in {r.part for r in rows}:
        own = sorted((r.ordinal, r.start, r.n_tokens) for r in rows if r.part == part)
        assert [o for o, *_ in own] == list(range(len(own)))
        assert all(b[1] == a[1] + a[2] + 1 for a, b in zip(own, own[1:], strict=False))


def test_unclosed_last_document(spark, tmp_path):
    (tmp_path / "part-00003-x.txt").write_bytes(np.array([5, 6, 0, 0, 7, 8, 9], dtype="<u2").tobytes())
    (tmp_path / "part-00004-x.txt").write_bytes(b"")
    for block in (4, 1 << 20):
        rows = sorted(tuple(r) for r in document_token_counts(spark, str(tmp_path), block).collect())
        assert rows == [(3, 0, 0, 2, True), (3, 1, 3, 0, True), (3, 2, 4, 3, False)]


@pytest.mark.parametrize(("length", "most"), [(2048, 32), (64, 2)])
def test_packing(spark, documents, texts, length, most):
    rows = pack_documents(documents.repartition(3), length=length, open_windows=most, least_cut=4, keep_tokens=True).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(bytes(r.tokens)) == r.ids_crc32 and len(r.tokens) == 4 * r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= length
    total = 0
    for (node, _), ids in zip(texts, whole(NAMES[1], [t for _, t in texts]), strict=True):
        total += len(ids) + 1
        if Counter(i for i, _ in texts)[node] == 1:
            own = sorted(pieces[node], key=lambda r: r.start)
            flat = np.frombuffer(b"".join(bytes(r.tokens) for r in own), dtype="<u4").tolist()
            assert flat == [*ids, 1] and {r.doc_tokens for r in own} == {len(flat)}
            assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
    assert sum(r.length for r in rows) == total
    assert total >= 0.9 * length * (len(sequences) - 2 * most)


def test_empty_tables(spark, documents):
    nothing = documents.where("false")
    assert pack_documents(nothing).collect() == []
    for write, read in ((write_token_files, read_token_files), (write_flat_tokens, document_token_counts)):
        path = scratch_dir(spark, "test-empty")
        write(nothing, path)
        assert read(spark, path).collect() == []
