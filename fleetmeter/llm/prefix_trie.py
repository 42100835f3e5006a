"""Conversation prefix trie by a splitter skeleton.

A conversation is a path of fixed-width entries, one per turn (16 bytes of the SHA-256 of role and text, 4 bytes of
the text's code points), so byte order is the order of a depth-first walk. Splitters drawn from a sample cut the sorted
(path, conv_id) pairs into shards. A node whose members lie in two shards is a prefix of the splitter between them:
the trie of the splitters' paths, the skeleton, is broadcast, and every other node is finished inside its shard from one
pass over sorted rows that holds the open path only. Skeleton nodes leave each shard as partial aggregates, which a
grouping adds up; totals over subtrees follow from the skeleton's preorder.

conv_id takes part in the order, so copies of one conversation, however many, are cut into shards like anything else.
A node's list of members that end there must be hashed in order: it is sent as packed blocks, sorted by Spark and streamed.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.session import spill_to_table

#: Bytes of an entry, and of its digest.
ENTRY, DIGEST = 20, 16
#: Target size of a shard, counting 32 bytes a path besides its entries.
SHARD_BYTES = 256 * 1024
MAX_SHARDS = 16_384
#: Bounds of what the driver gathers and broadcasts. Longer paths are not drawn as splitters and a skeleton above
#: its bound gets fewer splitters: shards get larger, which costs time, as they are sorted with spilling and streamed.
SAMPLES_PER_SHARD, SAMPLE_BYTES, LONGEST_SPLITTER, SKELETON_BYTES = 16, 32 * 1024 * 1024, 1024 * 1024, 16 * 1024 * 1024
#: Ids of a block of members that end at one skeleton node.
BLOCK_IDS = 8192

_LOWEST = -(2**63) - 1
_PARTS = ("skeleton long, conv_id long, depth long, parent_conv_id long, parent_skeleton long, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, ends_sha256 string, first_end long, ends string")
_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id and the path of its turns in order (null turns first, equal ones by digest); null ids are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    entry = F.concat(F.substring(F.sha2(marked, 256), 1, 2 * DIGEST), F.lpad(F.hex(F.char_length(text)), 2 * (ENTRY - DIGEST), "0"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"), entry.alias("entry")).alias("at"))
    ordered = F.transform(F.array_sort(F.collect_list("at")), lambda x: x["entry"])
    return turns.groupBy("conv_id").agg(F.unhex(F.array_join(ordered, "")).alias("path"))


def rebuilt(stored: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Each path with its first h entries taken from the conversation at the start of its block of ``every`` ids,
    h = crc32(decimal conv_id) mod ``most``. At most ``every`` conversations read one head, and a head is most - 1 turns."""
    heads = stored.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("first"), F.substring("path", 1, ENTRY * (most - 1)).alias("head"))
    cut = F.expr(f"cast({ENTRY} * (crc32(cast(conv_id as string)) % {most}) as int)")
    joined = stored.withColumns({"first": F.col("conv_id") - F.col("conv_id") % every, "cut": cut}).join(heads, "first", "left")
    return joined.select("conv_id", F.expr("concat(substring(coalesce(head, X''), 1, cut), substring(path, cut + 1))").alias("path"))


def _common(a: bytes, b: bytes) -> int:
    """Whole entries that two paths share at their start."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // ENTRY
    low, high = 0, most // ENTRY  # the first low entries agree, the first high do not all
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[: middle * ENTRY] == b[: middle * ENTRY] else (low, middle)
    return low


def splitters(sample: Iterable[tuple[bytes, int]], shards: int, bound: int = SKELETON_BYTES) -> list[tuple[bytes, int]]:
    """At most shards - 1 ascending (path, conv_id) at about equal weights of the sample, each the shortest that parts two
    neighbours of it."""
    ordered = sorted(sample)
    weight = np.cumsum([len(p) + 32 for p, _ in ordered])
    while shards > 1 and ordered:
        places = np.searchsorted(weight, weight[-1] * np.arange(1, shards) / shards)
        found = []
        for i in sorted(set(places.tolist()) - {0}):
            (a, _), (b, conv) = ordered[i - 1], ordered[i]
            found.append((b, conv) if a == b else (b[: (_common(a, b) + 1) * ENTRY], _LOWEST))
        found = sorted(set(found))
        if sum(len(p) for p, _ in found) <= bound:
            return found
        shards //= 2
    return []


class Skeleton:
    """The trie of the splitters' paths, numbered in preorder; 0 is the root."""

    def __init__(self, cuts: list[tuple[bytes, int]]):
        self.cuts = cuts
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth, self.own = [-1], [0], [0]
        for path, _ in cuts:
            node = 0
            for at in range(0, len(path), ENTRY):
                entry = path[at: at + ENTRY]
                found = self.child.get((node, entry))
                if found is None:
                    found = self.child[node, entry] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(at // ENTRY + 1)
                    self.own.append(int.from_bytes(entry[DIGEST:], "big"))
                node = found
        self.end = [i + 1 for i in range(len(self.parent))]
        for i in range(len(self.parent) - 1, 0, -1):
            self.end[self.parent[i]] = max(self.end[self.parent[i]], self.end[i])


class _Node:
    __slots__ = ("skeleton", "own", "conv", "n", "children", "leaves", "saved", "digest", "first", "ids", "waiting")

    def __init__(self, skeleton, own):
        self.skeleton, self.own, self.conv = skeleton, own, None
        self.n = self.children = self.leaves = self.saved = 0
        self.digest = self.first = None
        self.ids, self.waiting = [], []


class _Shard:
    """One pass over ascending (path, conv_id); rows gather in ``out``."""

    def __init__(self, skeleton: Skeleton, out: list):
        self.skeleton, self.out, self.path = skeleton, out, b""
        self.open = [_Node(0, 0)]

    def add(self, path: bytes, conv: int) -> None:
        if path != self.path:
            self._close(_common(path, self.path))
            for at in range(ENTRY * (len(self.open) - 1), len(path), ENTRY):
                above, entry = self.open[-1].skeleton, path[at: at + ENTRY]
                known = None if above is None else self.skeleton.child.get((above, entry))
                self.open.append(_Node(known, int.from_bytes(entry[DIGEST:], "big")))
            self.path = path
        # Members are counted where they end and handed up when a node closes.
        node = self.open[-1]
        node.n += 1
        node.conv = conv if node.conv is None else min(node.conv, conv)
        if node.skeleton is not None:
            node.ids.append(str(conv))
            node.first = conv if node.first is None else node.first
            if len(node.ids) >= BLOCK_IDS:
                self._block(node)
        elif node.digest is None:
            node.digest = hashlib.sha256(str(conv).encode())
        else:
            node.digest.update(b",%d" % conv)

    def _block(self, node) -> None:
        self.out.append((node.skeleton, None, None, None, None, 0, 0, 0, 0, None, node.first, ",".join(node.ids)))
        node.ids, node.first = [], None

    def _close(self, depth: int) -> None:
        """Finish all open nodes below a depth."""
        while len(self.open) > depth + 1:
            node, at = self.open.pop(), len(self.open)
            above = self.open[-1]
            above.n += node.n
            above.conv = node.conv if above.conv is None else min(above.conv, node.conv)
            if node.skeleton is not None:
                self._partial(node)
                continue
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.n - 1) * node.own
            above.children, above.leaves, above.saved = above.children + 1, above.leaves + leaves, above.saved + saved
            self.out += [(None, c, d, node.conv, None, *rest) for c, d, *rest in node.waiting]
            ends = (node.digest or hashlib.sha256()).hexdigest()
            row = (node.conv, at, node.n, node.children, leaves, saved, ends, None, None)
            if above.skeleton is None:
                above.waiting.append(row)  # its parent's smallest member is known when the parent closes
            else:
                self.out.append((None, node.conv, at, None, above.skeleton, *row[2:]))

    def _partial(self, node) -> None:
        if node.ids:
            self._block(node)
        self.out.append((node.skeleton, node.conv, None, None, None, node.n, node.children, node.leaves, node.saved, None, None, None))

    def finish(self) -> None:
        self._close(0)
        self._partial(self.open.pop())


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _sharded(cuts):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column("conv_id"), batch.column("path")
            shard = [bisect_right(cuts.value, x) for x in zip(found.to_pylist(), ids.to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), ids, found], ["shard", "conv_id", "path"])

    return number


def _finished(cuts):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, number = pa.string(), pa.int64()
        schema = pa.schema([(x.split()[0], text if x.endswith("string") else number) for x in _PARTS.split(", ")])
        skeleton, out, shard, now = Skeleton(cuts.value), [], None, None
        for batch in batches:
            for k, conv, path in zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path"))):
                if k != now:
                    if shard:
                        shard.finish()
                    shard, now = _Shard(skeleton, out), k
                shard.add(path, conv)
                if len(out) >= 4096:
                    yield _batch(out, schema)
                    out.clear()
        if shard:
            shard.finish()
        if out:
            yield _batch(out, schema)

    return walk


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the blocks of each skeleton node, which come in order."""
    node, digest, out = None, None, []
    for batch in batches:
        for k, ends in zip(batch.column("skeleton").to_pylist(), batch.column("ends").to_pylist()):
            if k != node:
                if digest:
                    out.append((node, digest.hexdigest()))
                node, digest = k, hashlib.sha256(ends.encode())
            else:
                digest.update(b"," + ends.encode())
    if digest:
        out.append((node, digest.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([d for _, d in out])], ["skeleton", "ends_sha256"])


def _rolled(cuts):
    def roll(rows: pd.DataFrame) -> pd.DataFrame:
        """Totals over subtrees of the skeleton; its size is bounded, so this is one small group."""
        trie = Skeleton(cuts.value)
        rows = rows.sort_values("skeleton").reset_index(drop=True)
        parent, end, own = (np.array(x, np.int64) for x in (trie.parent, trie.end, trie.own))
        children = rows["n_children"].to_numpy() + np.bincount(parent[1:], minlength=len(parent))
        leaves = np.concatenate(([0], np.cumsum(rows["n_leaves"].to_numpy() + (children == 0))))
        saved = np.concatenate(([0], np.cumsum(rows["saved_tokens"].to_numpy() + (rows["n_convs"].to_numpy() - 1) * own)))
        at = np.arange(len(parent))
        convs = rows["conv_id"].to_numpy()
        return pd.DataFrame({
            "skeleton": at, "conv_id": convs, "depth": trie.depth,
            "parent_conv_id": pd.array([None, *convs[parent[1:]].tolist()], "Int64"), "n_convs": rows["n_convs"], "n_children": children,
            "n_leaves": leaves[end] - leaves[at], "saved_tokens": saved[end] - saved[at],
            "ends_sha256": rows["ends_sha256"].fillna(hashlib.sha256().hexdigest())})

    return roll


def trie_nodes(stored: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """All nodes of the trie of stored (conv_id, path) rows, which are read more than once.

    An empty table gives no node, not even a root. conv_id is unique. Returns conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    spark = stored.sparkSession
    width: Column = F.octet_length("path")
    rows, size = stored.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    shards = min(MAX_SHARDS, max(1, math.ceil((size + 32 * rows) / shard_bytes)))
    share = min(1.0, SAMPLES_PER_SHARD * shards / max(rows, 1), SAMPLE_BYTES / max(size, 1)) if shards > 1 else 0.0
    drawn = F.pmod(F.xxhash64("conv_id"), F.lit(2**30)) < int(share * 2**30)
    sample = stored.where(drawn & (width <= LONGEST_SPLITTER)).select("path", "conv_id").collect() if share else []
    cuts = spark.sparkContext.broadcast(splitters(((bytes(p), c) for p, c in sample), shards))
    dealt = stored.mapInArrow(_sharded(cuts), "shard long, conv_id long, path binary").repartition(len(cuts.value) + 1, "shard")
    parts = spill_to_table(dealt.sortWithinPartitions("shard", "path", "conv_id").mapInArrow(_finished(cuts), _PARTS), "trie-parts")
    partial = parts.where("skeleton is not null")
    sums = partial.groupBy("skeleton").agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")))
    blocks = partial.where("ends is not null").select("skeleton", "first_end", "ends").repartition("skeleton")
    ends = blocks.sortWithinPartitions("skeleton", "first_end").mapInArrow(_hashed, "skeleton long, ends_sha256 string")
    schema = "skeleton long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    joints = spill_to_table(sums.join(ends, "skeleton", "left").groupBy().applyInPandas(_rolled(cuts), schema), "trie-skeleton")
    inner = parts.where("skeleton is null")
    above = joints.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("joint"))  # bounded by SKELETON_BYTES
    filled = inner.join(F.broadcast(above), "parent_skeleton", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "joint"))
    return joints.select(*_COLUMNS).unionByName(filled.select(*_COLUMNS))


def prefix_trie(conversations: DataFrame, every: int = 100, most: int = 6, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The trie of rebuilt conversations, one row per node.

    conversations: conv_id, turn, role, text; other columns are ignored. Null role or text counts as empty, a null turn
    comes first, turns with the same number are ordered by the SHA-256 of role and text (repeated rows are so many turns),
    rows without conv_id are left out, and an empty table gives no rows. Rebuilding: see ``rebuilt``; a conversation may
    end up without turns and is then a member of the root only. Texts of any length are 20 bytes; one task holds the
    entries of the conversation it reads, 20 bytes a turn. Runs Spark jobs when called.
    """
    stored = spill_to_table(paths(conversations), "trie-turns")
    return trie_nodes(spill_to_table(rebuilt(stored, every, most), "trie-paths"), shard_bytes)
