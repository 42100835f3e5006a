import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from fleetmeter.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, path binary, shard long, depth long, skeleton long"


def brute(rows):
    """All nodes from prefixes as tuples."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, key, role, text))
    turns = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (conv % 100 if conv >= 0 else -(-conv % 100))
        seq = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(conv)
        ends[seq].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    total = {}
    for node in sorted(members, key=len, reverse=True):
        below = [total[c] for c in children[node]]
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        total[node] = (sum(x for x, _ in below) or 1, saved + sum(y for _, y in below))
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(children[node]), *total[node],
                   hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()) for node, m in members.items())


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, b"x", 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    found = prefix_trie.prefix_trie(df, **kw).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *tuple(r)[3:]) for r in found)


def chats(n, seed=3, words="ab", longest=7):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(words) * rng.randint(0, 3))
            for c in range(n) for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("shard_bytes", [64, 700, 10**9])
def test_equals_brute_force_however_it_is_cut(spark, shard_bytes):
    rows = chats(420)
    assert run(spark, rows, shard_bytes=shard_bytes) == brute(rows)


def test_copies_are_cut_between_shards(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", 7)
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(9)] + [(c, t, "user", "x") for c in range(400, 460) for t in range(2)]
    stored = prefix_trie.spill_to_table(prefix_trie.paths(spark.createDataFrame([(*r, b"", 1, 2, 3) for r in rows], SCHEMA)), "t")
    cuts = prefix_trie.splitters([(bytes(p), c) for c, p in stored.collect()], 20)
    same = [c for p, c in cuts if len(p) == 9 * prefix_trie.ENTRY and c >= 0]
    assert len(same) > 10  # one path, many shards
    assert run(spark, rows, shard_bytes=2000) == brute(rows)


def test_odd_rows(spark):
    rows = chats(40) + [(1, None, "user", "first"), (1, None, "user", "again"), (1, None, "user", "again"), (2, 1, None, None), (2, 1, "", ""), (3, 5, "u", "é𝒳"),
                        (None, 0, "user", "nobody"), (-7, 0, "user", "below"), (-100, 0, "user", "head"), (-100, 1, "a", "b"), (250, 0, "a", "no head"),
                        (9, -4, "user", "y" * 300_000), (10, 0, "us", "er x"), (11, 0, "user", " x")] + [(12, t, "user", "z") for t in range(700)]
    for size in (300, 10**9):
        assert run(spark, rows, shard_bytes=size) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_skeleton_bound_only_costs_shards(spark, monkeypatch):
    rows = chats(200)
    monkeypatch.setattr(prefix_trie, "SKELETON_BYTES", 100)
    sample = [(bytes([c % 7]) * 40, c) for c in range(50)]
    assert sum(len(p) for p, _ in prefix_trie.splitters(sample, 40, 100)) <= 100
    assert run(spark, rows, shard_bytes=64) == brute(rows)
