import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetmeter.llm import bpe, packing
from odd import ROWS, empty, odd

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
VOCABULARY = bpe.load_vocabulary()


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def own_ids(texts):
    out = defaultdict(list)
    for row, ids, _ in bpe.encoded(pa.record_batch({"text": pa.array(texts, pa.string())}), bpe.Encoder(VOCABULARY)):
        out[row] += ids.tolist()
    return [out[i] for i in range(len(texts))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \t\n'strelvmd.,09aé 　\x1c\x85<|>endoftx"), st.characters(exclude_categories=["Cs"])), max_size=60),
                min_size=1, max_size=5))
def test_ids_equal_the_library(texts):
    assert own_ids(texts) == [ids_of(t) for t in texts]


def test_long_and_special_texts(monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 100)
    texts = ["a<|endoftext|>b <|endoftext|><|endoftext|>", "ab " * 200 + "don't", "x" * 3000, " '" * 150, "é" * 333, "word  \n " * 90]
    assert own_ids(texts) == [ids_of(t) for t in texts]


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_of_equal_letter_patterns(n):
    """Thue-Morse words and their complements, which polynomials modulo a power of two can't tell apart."""
    signs = [bin(i).count("1") % 2 for i in range(n)]
    texts = ["".join("ab"[x] for x in signs), "".join("ba"[x] for x in signs)]
    assert own_ids([texts[0], texts[1], " ".join(texts)]) == [ids_of(t) for t in (*texts, " ".join(texts))]


def test_a_full_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 20)
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 50)
    texts = [f"some words {i} differ {i * i}" for i in range(50)]
    assert own_ids(texts) == [ids_of(t) for t in texts]


def test_encode_decode_on_odd_rows(spark):
    def expected(i, t):
        ids = ids_of(t)
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        return i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    got = bpe.encode_decode(odd(spark)).collect()
    assert Counter(map(tuple, got)) == Counter(expected(i, t) for i, t, _ in ROWS)
    assert bpe.encode_decode(empty(spark)).collect() == []


def test_ids_and_back(spark):
    ids = bpe.token_ids(odd(spark))
    assert Counter((r.doc_id, tuple(r.ids)) for r in ids.collect()) == Counter((i, tuple(ids_of(t))) for i, t, _ in ROWS)
    assert Counter(map(tuple, bpe.decode_ids(ids).collect())) == Counter((i, t or "") for i, t, _ in ROWS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_decreasing_takes_the_tightest_window(lengths):
    place, offset = packing.best_fit_decreasing(np.array(lengths, np.int64), 64)
    left, expected = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [w for w, room in enumerate(left) if room >= lengths[i]]
        if not fits:
            left.append(64)
            fits = [len(left) - 1]
        room = min(left[w] for w in fits)
        assert 64 - offset[i] == room
        window = next(w for w in fits if left[w] == room)
        left[window] -= lengths[i]
        expected[i] = window
    assert (place.max() + 1 if len(lengths) else 0) == len(left)
    used = defaultdict(int)
    for p, n in zip(place.tolist(), lengths):
        used[p] += n
    assert all(n <= 64 for n in used.values())


@pytest.mark.parametrize("group_rows", [20_000, 5])
def test_packing_on_odd_rows(spark, group_rows):
    texts = defaultdict(list)
    for i, t, _ in ROWS:
        texts[i].append(np.array([*ids_of(t), 1], "<u4"))
    got = packing.pack(odd(spark), group_rows=group_rows).collect()
    pieces, sequences = defaultdict(Counter), defaultdict(list)
    for r in got:
        assert 1 <= r.length <= 2048
        pieces[r.doc_id][(r.start, r.length, r.ids_crc32, r.doc_tokens)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, all_ids in texts.items():
        assert pieces[i] == Counter(
            (at, len(x[at: at + 2048]), zlib.crc32(x[at: at + 2048].tobytes()), len(x)) for x in all_ids for at in range(0, len(x), 2048))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    if group_rows > 5:
        total = sum(r.length for r in got)
        assert len(sequences) <= total // 2048 + 2
    assert packing.pack(empty(spark)).collect() == []
