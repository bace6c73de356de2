"""Encoding, counting and packing against the tokenizers library."""

import random
import struct
import zlib
from hashlib import sha256

import pytest
from tokenizers import Tokenizer

from rankflow.llm import bpe_codec, packing, token_count
from rankflow.llm.common import tokenizer_path

from .conftest import ODD_IDS, ODD_TEXTS, docs_of

WORD, BYTE = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
PARTS = ["a", "B", "é", "É", " ", "  ", "\n", "\t", "\r\n", "\xa0", " ", "　", "'s", "'LL",
         "'", "don't", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "123", "½", "Ⅷ", "İ",
         "Σ", "ς", "漢", "🙂", "é", "́", "\x00", "\x1c", "\x85", "ſ", "K", "...", "$$",
         "_", "word", "Hello", "​", "ﬁ", "ǅ"]


def adversarial(n=1500, seed=3):
    rng = random.Random(seed)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(n)]
    for size in (255, 256, 257, 400, 3000):
        out.append("".join(rng.choice("abcdefgth") for _ in range(size)))
    return [*out, "a" * 3000, "🙂" * 300, "", " ", "\n\n", " x ", "x\n"]


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD)


def pack_ids(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_codec_matches_the_library(word):
    with open(WORD, "rb") as f:
        codec = bpe_codec.Codec(f.read())
    for text in adversarial():
        ids = word.encode(text, add_special_tokens=False).ids
        got, decoded = codec.run(text.encode())
        assert got == pack_ids(ids), text[:80]
        assert decoded.decode() == word.decode(ids, skip_special_tokens=False)


def test_counter_matches_the_library():
    byte = Tokenizer.from_file(BYTE)
    with open(BYTE, "rb") as f:
        counter = token_count.Counter(f.read())
    for text in adversarial(seed=4):
        assert counter.count(text.encode()) == len(byte.encode(text, add_special_tokens=False).ids)


def test_library_encoder_matches_whole_texts(word):
    with open(WORD, "rb") as f:
        encoder = packing.LibraryEncoder(f.read())
    for text in adversarial(seed=5):
        assert encoder.encode(text.encode()) == pack_ids(
            word.encode(text, add_special_tokens=False).ids), text[:80]


def test_remembered_chunks_are_bounded(word):
    with open(WORD, "rb") as f:
        codec = bpe_codec.Codec(f.read())
    codec.known.most = 3
    text = "one two three four five one two six one"
    assert codec.run(text.encode())[0] == pack_ids(word.encode(text).ids)
    assert len(codec.known) <= 3 and len(codec.known.before) <= 3


def test_codec_on_odd_rows(odd, none, word):
    got = sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256)
                 for r in bpe_codec.digests(odd, WORD).collect())
    want = []
    for i, t in zip(ODD_IDS, ODD_TEXTS, strict=True):
        ids = word.encode(t or "", add_special_tokens=False).ids
        text = word.decode(ids, skip_special_tokens=False)
        want.append((repr(i), len(ids), sha256(pack_ids(ids)).hexdigest(),
                     sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe_codec.encode_decode(none, WORD).collect() == []


def test_round_trip(spark):
    texts = ["hello world, this is it.", "déjà vu 12"]
    rows = bpe_codec.encode_decode(docs_of(spark, texts), WORD).orderBy("doc_id").collect()
    with open(WORD, "rb") as f:
        vocabulary = bpe_codec.Vocabulary(f.read())
    back = {s: b for b, s in enumerate(bpe_codec.byte_symbols())}
    for text, row in zip(texts, rows, strict=True):
        ids = list(struct.unpack(f"<{len(row.ids) // 4}I", row.ids))
        assert vocabulary.decode(ids) == row.decoded
        joined = "".join(vocabulary.names[i] for i in ids).replace("</w>", "Ġ")
        plain = bytes(back[c] for c in joined).decode()
        assert plain.replace(" ", "") == text.replace(" ", "")


def test_counts_on_odd_rows(odd, none):
    byte = Tokenizer.from_file(BYTE)
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit)
                 for r in token_count.count_tokens(odd, BYTE).collect())
    want = []
    for i, t in zip(ODD_IDS, ODD_TEXTS, strict=True):
        n = len(byte.encode(t or "", add_special_tokens=False).ids)
        want.append((repr(i), len((t or "").encode()), n, n > 1024))
    assert got == sorted(want)
    assert token_count.count_tokens(none, BYTE).collect() == []


def check_places(rows, capacity):
    """Every sequence is filled from 0 on without gaps; gives their number."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_odd_rows(odd, none, word):
    rows = packing.pack_documents(odd, WORD, capacity=64, with_ids=True).collect()
    want = []
    for i, t in zip(ODD_IDS, ODD_TEXTS, strict=True):
        ids = [*word.encode(t or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), 64)):
            part = ids[at:at + 64]
            want.append((repr(i), n, at, len(part), zlib.crc32(pack_ids(part)), part))
    assert sorted((repr(r.doc_id), r.piece, r.start, r.length, r.ids_crc32, r.ids)
                  for r in rows) == sorted(want)
    assert check_places(rows, 64) == -(-sum(r.length for r in rows) // 64)
    assert packing.pack_documents(none, WORD).collect() == []


def test_packing_a_hot_length(spark):
    texts = ["one two three"] * 300 + [f"word {'x ' * (i % 40)}" for i in range(200)]
    rows = packing.pack_documents(docs_of(spark, texts), WORD, capacity=48).collect()
    assert len(rows) == 500 and len({r.doc_id for r in rows}) == 500
    bins = check_places(rows, 48)
    assert bins <= -(-sum(r.length for r in rows) // 48) + 1


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 37, 128])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 400))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    slots = packing.plan(counts, capacity)
    filled, ranks = {}, {n: 0 for n in counts}
    for s in slots:
        assert s.first_rank == ranks[s.length]
        ranks[s.length] += s.ranks
        for r in range(s.ranks):
            bin_, at = s.first_bin + r // s.per_bin, s.offset + r % s.per_bin * s.length
            filled.setdefault(bin_, []).append((at, s.length))
    assert ranks == counts
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(filled) == best_fit_decreasing(lengths, capacity)


def test_codec_matches_the_library_on_every_code_point(word):
    """Alone, between letters, and before a digit: classes, case and NFC."""
    with open(WORD, "rb") as f:
        codec = bpe_codec.Codec(f.read())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"b{chr(c)}c {chr(c)}1 " for c in points[i:i + 64])
             for i in range(0, len(points), 64)]
    wanted = word.encode_batch(texts, add_special_tokens=False)
    odd = [t for t, w in zip(texts, wanted, strict=True) if codec.run(t.encode())[0] != pack_ids(w.ids)]
    assert not odd


def test_very_long_words(word):
    import time

    with open(WORD, "rb") as f:
        codec = bpe_codec.Codec(f.read())
    rng = random.Random(9)
    for text in ("a" * 300_000, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000)),
                 "ab" * 100_000, "é" * 50_000):
        began = time.time()
        got = codec.run(text.encode())[0]
        assert time.time() - began < 30
        assert got == pack_ids(word.encode(text, add_special_tokens=False).ids)


def test_minima():
    rng = random.Random(2)
    for n in (1, 2, 64, 65, 5000):
        values = [rng.randrange(50) for _ in range(n)]
        tree = bpe_codec.Minima(list(values))
        for _ in range(200):
            assert tree.where() == (values.index(min(values)) if min(values) < bpe_codec.NONE else None)
            k, new = rng.randrange(n), rng.choice([rng.randrange(50), bpe_codec.NONE])
            values[k] = new
            tree.set(k, new)


def test_remembered_bytes_are_bounded():
    from rankflow.llm.common import Remembered

    known = Remembered(lambda k: k * 100, most=50, longest=8)
    for i in range(2000):
        for key in (f"{i:05d}", f"a long key, {i}"):
            assert known[key] == key * 100
        assert len(known) <= 50 and len(known.before) <= 50
        assert all(len(k) <= 8 for k in (*known, *known.before))


@pytest.mark.parametrize("seed", range(6))
def test_pieces_meet_few_slots_of_their_length(seed):
    """Blocks of ranks: every rank finds its entry, and not many others."""
    rng = random.Random(seed)
    capacity = 64
    counts = {n: rng.choice([1, 7, 300, 5000]) for n in rng.sample(range(1, capacity + 1), 20)}
    slots = packing.plan(counts, capacity)
    rows = packing.rank_blocks(slots, counts)
    entries, met = {}, 0
    for length, first, ranks, *_, size, block in rows:
        entries.setdefault((length, block), []).append((first, ranks, size))
    for length, n in counts.items():
        size = next(s for (k, _), e in entries.items() if k == length for *_, s in e)
        own = len([s for s in slots if s.length == length])
        assert len([r for r in rows if r[0] == length]) <= 2 * own + n // size + 1
        for rank in range(n):
            near = entries[length, rank // size]
            met += len(near)
            assert sum(first <= rank < first + ranks for first, ranks, _ in near) == 1
    assert met <= 4 * sum(counts.values()) + len(rows)
