import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from fleetmeter.llm import suffix_dedup as s

from odd import PASSAGE, ROWS, empty, odd


def brute(rows, window=400):
    """(id, bytes, removed, spans, digest of the rest) from counts of all windows."""
    rows = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(t[p: p + window] for _, t in rows for p in range(len(t) - window + 1))
    out = []
    for i, t in rows:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - window + 1):
            if count[t[p: p + window]] > 1:
                gone[p: p + window] = True
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(t) else 0
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, b"n", 1, 2, "r") for i, t in rows], "doc_id long, text string, name binary, `at` long, n long, runs string").repartition(4)
    return sorted(map(tuple, s.suffix_dedup(df, **kw).collect()), key=repr)


def texts(seed=5):
    rng = random.Random(seed)

    def prose(n):
        return "".join(rng.choice("abcdefgh é\n") for _ in range(n))

    shared = [prose(n) for n in (399, 400, 401, 700, 1500, 300)]
    rows = []
    for i in range(120):
        parts = [prose(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            if rng.random() < 0.3:
                at = rng.randrange(len(p))
                p = p[:at] + "X" + p[at + 1:]
            parts += [p[rng.choice([0, 0, 7]):], prose(rng.choice([0, 20, 200]))]
        rows.append((i, "".join(parts)))
    return rows + [(900 + i, rows[3][1]) for i in range(5)] + [(3, rows[3][1]), (4, "y" * 399), (5, "y" * 401), (6, "ab" * 600)]


def test_equals_brute_force(spark):
    rows = texts()
    expected = brute(rows)
    assert sum(r[2] > 0 for r in expected) > 50 and max(r[3] for r in expected) > 1
    assert run(spark, rows) == expected


@pytest.mark.parametrize("hot", [3000, 0])
def test_hot_anchors_are_split(spark, monkeypatch, hot):
    """A passage below a window's length inside many different texts, and longer ones, with and without a second split."""
    monkeypatch.setattr(s, "HOT_BYTES", hot)
    monkeypatch.setattr(s, "BUCKET_BYTES", 4000)
    rng = random.Random(1)
    notice = "".join(rng.choice("abcdef ") for _ in range(390))
    rows = [(i, "".join(rng.choice("uvwxyz") for _ in range(rng.randint(0, 400))) + notice[: rng.choice([390, 390, 300])] + rng.choice(["tail one " * 5, f"{i} " * 90]))
            for i in range(30)] + texts(8)[:10]
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(i, t) for i, t, _ in ROWS if len(t or "") < 100_000] + [(None, PASSAGE), (None, None), (77, "\x00" * 500), (78, "é" * 300)]
    found = sorted(map(tuple, s.suffix_dedup(odd(spark, [(i, t, "en") for i, t in rows])).collect()), key=repr)
    assert found == brute(rows)
    assert s.suffix_dedup(empty(spark)).collect() == []


def test_long_texts_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(s, "_BLOCK", 2**11)
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefghij ") for _ in range(30_000))
    rows = [(1, long), (2, long[5_000:9_000] + "!" + long[20_000:]), (3, long[7:450])]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("length", [1, 3, 7, 8, 20])
def test_boundaries_are_common_prefixes(length):
    rng = np.random.default_rng(length)
    symbols = np.concatenate((rng.integers(0, 3, 300), np.tile(rng.integers(0, 3, 30), 4), np.zeros(25, np.int64)))
    order, marked = s.boundaries(symbols, length)
    text = symbols.tolist()
    expected = sorted(range(len(text)), key=lambda i: text[i:])
    assert order.tolist() == expected
    for i in range(1, len(text)):
        a, b = text[expected[i - 1]:], text[expected[i]:]
        assert marked[i] == (a[:length] != b[:length] or min(len(a), len(b)) < length), (i, a[:25], b[:25])
