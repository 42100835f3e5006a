"""Exact deduplication: owners of (length, content hash) partitions keep full texts in compressed radix tries.

Map tasks first fold their own copies into a trie, so that a text which a third of all rows
share leaves each task once. The survivors go to owners by length and content hash; an owner
sees them sorted by that pair, holds the trie of one pair at a time and lets Spark's sort keep
what waits on disk: the spill unit is a subtree (one length and hash), so no owner holds more
than the texts that share one. The map-side trie is flushed downstream subtree by subtree when
it reaches a byte bound; a text flushed twice merely meets its other half at the owner.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import filled, picked

#: Text bytes that a map task's trie holds before it hands its largest subtree on.
TRIE_BYTES = 64 * 1024 * 1024


class Trie:
    """Patricia trie over byte strings; a terminal holds the number of copies and the id that stays."""

    def __init__(self, largest: bool):
        self.pick = max if largest else min
        self.roots: dict[int, list] = {}
        self.bytes: dict[int, int] = {}
        self.held = 0

    # A node is [label, children by first byte, (copies, id) or None].
    def add(self, key: bytes, copies: int, ident) -> None:
        first = key[0] if key else -1
        if first not in self.roots:
            self.roots[first], self.bytes[first] = [key, {}, (copies, ident)], 0
            self._grow(first, len(key))
            return
        node, at = self.roots[first], 0
        while True:
            label = node[0]
            if not key.startswith(label, at):
                same = _common(key, at, label)
                node[:] = [label[:same], {label[same]: [label[same:], node[1], node[2]]}, None]
                label = node[0]
            at += len(label)
            if at == len(key):
                if node[2]:
                    node[2] = (node[2][0] + copies, self.pick(node[2][1], ident))
                else:
                    node[2] = (copies, ident)
                return
            child = node[1].get(key[at])
            if child is None:
                node[1][key[at]] = [key[at:], {}, (copies, ident)]
                self._grow(first, len(key) - at)
                return
            node = child

    def _grow(self, first: int, size: int) -> None:
        self.bytes[first] += size
        self.held += size

    def cut_largest(self) -> Iterator[tuple[bytes, int, int]]:
        """Terminals of the heaviest subtree, which leaves the trie."""
        first = max(self.bytes, key=self.bytes.get)
        self.held -= self.bytes.pop(first)
        yield from _terminals(self.roots.pop(first))

    def drain(self) -> Iterator[tuple[bytes, int, int]]:
        while self.roots:
            yield from self.cut_largest()


def _common(key: bytes, at: int, label: bytes) -> int:
    """Bytes that label shares with key from ``at`` on, by halving."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if key[at + low: at + mid] == label[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _terminals(root: list) -> Iterator[tuple[bytes, int, int]]:
    stack = [(b"", root)]
    while stack:
        prefix, (label, children, end) = stack.pop()
        key = prefix + label
        if end:
            yield key, *end
        stack.extend((key, child) for child in children.values())


def _folder(largest: bool):
    """Map side: (doc_id, text) to (text, copies, keep_id), each text once per task while memory allows."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(largest)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for i, text in enumerate(batch.column("text")):
                trie.add(text.as_py(), 1, ids[i])
                if trie.held > TRIE_BYTES:
                    yield from _packed(trie.cut_largest())
        yield from _packed(trie.drain())

    return fold


def _packed(terminals: Iterator[tuple[bytes, int, int]]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for row in terminals:
        rows.append(row)
        size += len(row[0])
        if size > 4_000_000 or len(rows) == 5_000:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    texts, copies, ids = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(texts, pa.binary()), pa.array(copies, pa.int64()), pa.array(ids, pa.int64())],
        ["content", "copies", "keep_id"],
    )


def _owner(largest: bool):
    """Owner side: rows sorted by (bytes, digest); one trie per pair, emptied when the pair ends."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, current, done = Trie(largest), None, []

        def settle():
            done.extend((current[1], n, ident) for _, n, ident in trie.drain())

        for batch in batches:
            digests, contents = batch.column("digest").to_pylist(), batch.column("content")
            copies, ids, sizes = (batch.column(c).to_pylist() for c in ("copies", "keep_id", "bytes"))
            for i, digest in enumerate(digests):
                if current != (sizes[i], digest):
                    if current:
                        settle()
                    current = (sizes[i], digest)
                trie.add(contents[i].as_py(), copies[i], ids[i])
            if done:
                yield _owned(done)
                done = []
        if current:
            settle()
        if done:
            yield _owned(done)

    return own


def _owned(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    digests, copies, ids = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(digests, pa.binary()), pa.array(copies, pa.int64()), pa.array(ids, pa.int64())],
        ["digest", "group_size", "keep_id"],
    )


def owners(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row per distinct text: digest (SHA-256), group_size, keep_id."""
    largest = keep == "largest"
    folded = picked(docs).select("doc_id", filled().cast("binary").alias("text")).where("doc_id is not null")
    folded = folded.mapInArrow(_folder(largest), "content binary, copies long, keep_id long")
    keyed = folded.withColumns({"bytes": F.octet_length("content"), "digest": F.unhex(F.sha2("content", 256))})
    dealt = keyed.repartition("bytes", "digest").sortWithinPartitions("bytes", "digest")
    return dealt.mapInArrow(_owner(largest), "digest binary, group_size long, keep_id long")


def exact_dedup(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """Group documents by identical text and name the row that stays.

    docs: doc_id and text, other columns are ignored. A null text counts as empty, so null and
    empty texts form one group. Rows without doc_id belong to no group and are left out.
    Repeated rows count each; when the id that stays is repeated, all its rows have kept=true.
    keep: "smallest" or "largest" doc_id stays. An empty table gives an empty result.
    Returns doc_id, keep_id, group_size, kept, text_sha256 (lower-case hex) and row, a hash of the text.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    digest = F.unhex(F.sha2(filled().cast("binary"), 256))
    rows = picked(docs).where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("row"), digest.alias("digest"))
    return rows.join(owners(docs, keep), "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "row",
    )
