import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetmeter.llm import exact_dedup, minhash, substring
from fleetmeter.llm.components import components
from odd import ROWS, component_ids, empty, odd, shingle_set, words

WITH_ID = [(i, t) for i, t, _ in ROWS if i is not None]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", max_size=6).map(str.encode), max_size=40), st.booleans())
def test_trie_counts_copies_and_keeps_one_id(keys, largest):
    trie = exact_dedup.Trie(largest)
    expected = defaultdict(list)
    for i, key in enumerate(keys):
        trie.add(key, 1, i)
        expected[key].append(i)
    pick = max if largest else min
    assert sorted(trie.drain()) == sorted((k, len(v), pick(v)) for k, v in expected.items())
    assert trie.held == 0


def test_trie_hands_on_its_largest_subtree():
    trie = exact_dedup.Trie(False)
    for key in (b"a" * 10, b"a" * 9 + b"b", b"z"):
        trie.add(key, 1, 0)
    assert {k[:1] for k, _, _ in trie.cut_largest()} == {b"a"}
    assert trie.held == 1 and list(trie.drain()) == [(b"z", 1, 0)]


def test_exact_dedup_on_odd_rows(spark):
    for keep, pick in (("largest", max), ("smallest", min)):
        groups = defaultdict(list)
        for i, t in WITH_ID:
            groups[t or ""].append(i)
        expected = Counter(
            (i, pick(groups[t or ""]), len(groups[t or ""]), i == pick(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
            for i, t in WITH_ID)
        got = exact_dedup.exact_dedup(odd(spark), keep).drop("row").collect()
        assert Counter(map(tuple, got)) == expected
    assert exact_dedup.exact_dedup(empty(spark)).collect() == []


def test_map_side_trie_may_flush_at_any_time(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "TRIE_BYTES", 50)
    docs = odd(spark, [(i, f"text {i % 7} " * 3, None) for i in range(200)])
    assert {(r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(docs).collect()} == {(k, 29 if k < 4 else 28) for k in range(7)}


def test_near_duplicates_on_odd_rows(spark):
    for n, percent in ((3, 85), (5, 80)):
        expected = component_ids(WITH_ID, n, percent)
        got = minhash.near_duplicates(odd(spark), n, percent).collect()
        assert len(got) == len(WITH_ID)
        assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {
            (i, len(shingle_set(t, n)), expected[i], i == expected[i]) for i, t in WITH_ID}
    assert minhash.near_duplicates(empty(spark)).collect() == []


def edited(rng, text, rate):
    return [rng.choice("abcdefgh") * 3 + str(rng.random())[:6] if rng.random() < rate else w for w in text]


def test_near_duplicates_of_a_large_family_match_all_pairs(spark, monkeypatch):
    """Copies with few to many edits: some link to the base, some only to each other, some to nothing."""
    monkeypatch.setattr(minhash, "BLOCK_NODES", 16)
    rng = random.Random(5)
    rows = []
    for family in range(3):
        base = [f"f{family}w{i}" for i in range(120)]
        rows += [edited(rng, base, rng.choice((0, 0.005, 0.02, 0.03, 0.05, 0.1))) for _ in range(70)]
        middle = edited(rng, base, 0.08)
        rows += [edited(rng, middle, 0.01) for _ in range(15)]
    rng.shuffle(rows)
    docs = [(i + 1, " ".join(w)) for i, w in enumerate(rows)]
    expected = component_ids(docs, 3, 85)
    got = minhash.near_duplicates(odd(spark, [(i, t, None) for i, t in docs]), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == expected
    assert 3 < len(set(expected.values())) < len(docs)


def test_half_keys_follow_the_miss_chance():
    for percent in (80, 85, 90):
        m = minhash.half_keys(percent)
        hit = 1 - (percent / 100) ** minhash.HALF_ROWS
        assert 1 - (1 - hit**m) ** 2 <= minhash.MISS < 1 - (1 - hit ** (m - 1)) ** 2 * 0.99999


def test_components_of_a_long_chain(spark):
    links = spark.range(60).selectExpr("id AS a", "id + 1 AS b").union(spark.range(100, 103).selectExpr("103 AS a", "id AS b"))
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 104)}
    assert components(links.where("a < 0")).collect() == []


def removed(docs, window):
    """(words, words removed, words kept) of each row, from all windows of all documents."""
    least = {}
    for i, t in docs:
        w = words(t)
        for p in range(len(w) - window + 1):
            key = tuple(w[p: p + window])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, t in docs:
        w = words(t)
        gone = set()
        for p in range(len(w) - window + 1):
            if least[tuple(w[p: p + window])] < i:
                gone |= set(range(p, p + window))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return out


def test_cover_reaches_every_pair_of_remainders():
    for i in range(substring.PERIOD):
        for j in range(substring.PERIOD):
            assert any((i + s) % substring.PERIOD in substring.COVER and (j + s) % substring.PERIOD in substring.COVER
                       for s in range(substring.PERIOD))


def test_substring_dedup_on_odd_rows(spark):
    short = [(i, t) for i, t in WITH_ID if t is None or len(t) < 100_000]
    got = substring.substring_dedup(odd(spark, [(i, t, None) for i, t in short] + [(None, "x", None)])).collect()
    assert Counter(map(tuple, got)) == Counter(removed(short, 50))
    assert substring.substring_dedup(empty(spark)).collect() == []


def test_substring_dedup_of_long_texts(spark):
    got = {r.doc_id: r for r in substring.substring_dedup(odd(spark)).collect()}
    assert got[9].n_removed == 60_000 and got[8].n_removed == 0


def test_substring_dedup_of_random_overlaps(spark):
    rng = random.Random(9)
    pool = [str(rng.randrange(10**6)) for _ in range(4000)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            at = rng.randrange(3900)
            parts += pool[at: at + rng.randrange(20, 140)]
        docs.append((100 - i, " ".join(parts)))
    got = substring.substring_dedup(odd(spark, [(i, t, None) for i, t in docs])).collect()
    assert sorted(map(tuple, got)) == sorted(removed(docs, 50))
    texts = substring.substring_dedup(odd(spark, [(i, t, None) for i, t in docs]), texts=True).collect()
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in texts)


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_of_equal_letter_patterns(spark, n):
    """Thue-Morse words and their complements, which polynomials modulo a power of two can't tell apart."""
    signs = [bin(i).count("1") % 2 for i in range(n)]
    one, other = "".join("ab"[x] for x in signs), "".join("ba"[x] for x in signs)
    words_of = [f"w{i}" for i in range(49)]
    docs = [(1, " ".join([*words_of, one])), (2, " ".join([*words_of, other])), (3, f"{one} {one} {one}"), (4, f"{other} {other} {other}"),
            (5, " ".join((one, other)[x] for x in signs)), (6, " ".join((other, one)[x] for x in signs))]
    found = substring.substring_dedup(odd(spark, [(i, t, None) for i, t in docs])).collect()
    assert sorted(map(tuple, found)) == sorted(removed(docs, 50))
    near = {r.doc_id: r.component_id for r in minhash.near_duplicates(odd(spark, [(i, t, None) for i, t in docs]), 3, 85).collect()}
    assert near == component_ids(docs, 3, 85)


def test_windows_of_copies_stay_small_in_memory():
    """Every window of 1,100 near copies is sent on; a task's arrays stay below 250 MB."""
    text, n = " ".join(f"word{i * 7919 % 5003}" for i in range(2000)), 1100
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array([f"{text} end{i}" for i in range(n)]),
         pa.array([np.arange(0, 1900, 5, dtype=np.int32)] * n, pa.list_(pa.int32()))], ["doc_id", "text", "places"])
    tracemalloc.start()
    sent = sum(len(h) // 8 for b in substring._windows(50, 64)(iter([rows])) for h in b.column("hash").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sent > n * 1890 and peak < 250e6, peak
