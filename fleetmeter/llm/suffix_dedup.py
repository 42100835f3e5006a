"""Removal of repeated byte strings with suffix arrays cut by content.

Every window of ``window`` bytes belongs to its anchor, the least-hashed 128-byte piece inside it (the leftmost at ties), so equal
windows have equal anchors. Neighbouring windows with one anchor form a string; strings whose anchor comes once in the corpus
hold no repeat and leave. The others meet by anchor in buckets of bounded size, equal strings as one with their number.

A bucket settles its strings with a Burrows-Wheeler transform: boundaries between suffixes that share few bytes are known from
packed words, and breadth-first backward extension of the intervals behind newly found boundaries derives the boundaries of
the next longer common prefix. It stops at the window's length: suffixes between two boundaries then begin one window.

An anchor with more strings than a bucket may hold (a notice in a third of all documents) is split: its windows are dealt again
by the longer piece that 16 neighbouring windows have in common, and if need be by the whole window.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.session import spill_to_table

from .support import _BYTE, joined_small, mixed, picked, text_bytes

#: Bytes of an anchor.
ANCHOR = 128
#: Target bytes of a bucket; bytes of one key from which it is split; windows of a piece at each level of splitting.
BUCKET_BYTES, HOT_BYTES, STEPS = 1024 * 1024, 4 * 1024 * 1024, (16, 1)
#: Bytes of distinct strings that a task holds before it sends them on.
HELD_BYTES = 32 * 1024 * 1024

_BLOCK = 2**20
_BASE = 0x9E3779B97F4A7C15
_SYMBOL_BITS, _PACKED = 9, 7
_STRINGS = "key long, name binary, owner binary, at long, n int, anchor int, times int, bytes binary"
_STRING_SCHEMA = pa.schema([("key", pa.int64()), ("name", pa.binary()), ("owner", pa.binary()), ("at", pa.int64()), ("n", pa.int32()),
                            ("anchor", pa.int32()), ("times", pa.int32()), ("bytes", pa.binary())])


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    found = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        step = np.full(_BLOCK, base, np.uint64)
        step[0] = 1
        found.append(np.multiply.accumulate(step))
    return found[0], found[1]


def _gram_hashes(data: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Hash of the ANCHOR bytes at each place. It only deals strings out: grams that share a hash meet and are told apart by
    their bytes."""
    n = len(data) - ANCHOR + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[0][: len(data)], out=sums[1:])
    return mixed((sums[ANCHOR:] - sums[:n]) * powers[1][:n])


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.uint64(2**64 - 1), np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1: width - 1 + n])


def _blocks(offsets: np.ndarray, window: int) -> Iterator[tuple[int, int]]:
    """Stretches of whole texts, or of one long text; where a text is cut depends on nothing but the text, so copies have equal strings."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _BLOCK - 1, "right")) - 1)
        begin, end = int(offsets[row]), int(offsets[stop])
        if stop > row + 1 or end - begin < _BLOCK:
            yield begin, end
        else:
            for at in range(begin, end - window + 1, _BLOCK - window):
                yield at, min(at + _BLOCK - 1, end)
        row = stop


def anchored(data: np.ndarray, offsets: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Strings of neighbouring windows with one anchor over texts that lie back to back, block by block:
    (key, place of the first window, number of windows, place of the anchor), places in data."""
    width, powers = window - ANCHOR + 1, _powers()
    low = np.uint64(_BLOCK - 1)
    for begin, end in _blocks(offsets, window):
        piece = data[begin:end]
        if len(piece) < window:
            continue
        hashes = _gram_hashes(piece, powers)
        keys = hashes & ~low
        keys |= np.arange(len(hashes), dtype=np.uint64)
        anchor = (_sliding_least(keys, width) & low).astype(np.int64)
        place = np.arange(len(anchor)) + begin
        inside = offsets[np.searchsorted(offsets, place, "right")] - place >= window
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
        first = np.flatnonzero(new)
        if len(first):
            stop = np.flatnonzero(inside & np.concatenate((new[1:] | ~inside[1:], [True]))) + 1
            yield hashes[anchor[first]].view(np.int64), place[first], stop - first, anchor[first] + begin


def _runs(window: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for key, place, n, anchor in anchored(data, offsets, window):
                row = np.searchsorted(offsets, place, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), batch.column("name").take(pa.array(row)), pa.array(place - offsets[row]), pa.array(n.astype(np.int32)),
                     pa.array((anchor - place).astype(np.int32))], ["key", "name", "at", "n", "anchor"])

    return find


class _Sender:
    """Strings of a task: each distinct one with its bytes and number once per flush, and one row per place where it lies."""

    def __init__(self):
        self.held: dict[bytes, list] = {}
        self.size, self.rows = 0, []

    def add(self, key: int, owner: bytes, at: int, n: int, anchor: int, times: int, data: bytes) -> None:
        name = hashlib.blake2b(data, digest_size=16).digest()
        known = self.held.get(name)
        if known is None:
            self.held[name] = [key, n, anchor, times, data]
            self.size += len(data) + 200
        else:
            known[3] += times
        self.rows.append((key, name, owner, at, n, None, None, None))

    def batches(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if last or self.size >= HELD_BYTES:
            self.rows += [(key, name, None, None, n, anchor, min(times, 2), data) for name, (key, n, anchor, times, data) in self.held.items()]
            self.held, self.size = {}, 0
        if self.rows and (last or len(self.rows) >= 4096 or not self.held):
            for at in range(0, len(self.rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows[at: at + 4096]), _STRING_SCHEMA)], schema=_STRING_SCHEMA)
            self.rows = []


def _cut_out(window: int):
    """Texts with their shared strings (runs) to strings."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, seen = _Sender(), set()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            names, copies, runs = batch.column("name").to_pylist(), batch.column("copies").to_pylist(), batch.column("runs")
            for row, name in enumerate(names):
                if name in seen:  # a copy of a text: its number is known
                    continue
                seen.add(name)
                found = runs[row].values
                for key, at, n, anchor in zip(*(found.field(c).to_pylist() for c in ("key", "at", "n", "anchor"))):
                    start = int(offsets[row]) + at
                    sender.add(key, name, at, n, anchor, copies[row], data[start: start + n + window - 1].tobytes())
                yield from sender.batches()
        yield from sender.batches(last=True)

    return cut


def _split(window: int, step: int):
    """Strings to pieces of up to ``step`` windows, keyed by the bytes that all windows at these distances to the anchor share."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender()
        for batch in batches:
            for name, n, anchor, times, data in zip(*(batch.column(c).to_pylist() for c in ("name", "n", "anchor", "times", "bytes"))):
                for j in range(max(0, (anchor - n + 1) // step), anchor // step + 1):
                    first, last = max(0, anchor - (j + 1) * step + 1), min(n - 1, anchor - j * step)
                    core = data[anchor - j * step: anchor - (j + 1) * step + 1 + window]
                    key = int.from_bytes(hashlib.blake2b(core, digest_size=8).digest(), "little", signed=True)
                    sender.add(key, name, first, last - first + 1, anchor - first, times, data[first: last + window])
                yield from sender.batches()
        yield from sender.batches(last=True)

    return cut


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, the place of each suffix in it, and the packed first symbols of each, by prefix doubling on
    groups that are not settled yet. Symbols are below 2**9 - 1; the end of the text sorts before all of them."""
    n = len(symbols)
    packed, padded = np.zeros(n, np.int64), np.concatenate((symbols + 1, np.zeros(_PACKED, np.int64)))
    for j in range(_PACKED):
        packed = (packed << _SYMBOL_BITS) | padded[j: j + n]
    order = np.argsort(packed)
    slots = np.arange(n)
    value = packed[order]
    rank = np.zeros(n + 1, np.int64)
    first = np.concatenate(([True], value[1:] != value[:-1]))
    depth = _PACKED
    rank[order] = slots[first][np.cumsum(first) - 1]
    rank[n] = -1
    while True:
        alone = first & np.concatenate((first[1:], [True]))
        slots, members = slots[~alone], order[~alone]
        if not len(slots):
            break
        key = (rank[members] << 32) | (rank[np.minimum(members + depth, n)] + 1)
        by = np.argsort(key)
        order, key = members[by], key[by]  # from here on the open slots only
        first = np.concatenate(([True], key[1:] != key[:-1]))
        rank[order] = slots[first][np.cumsum(first) - 1]
        depth *= 2
    rank = rank[:n]
    whole = np.empty(n, np.int64)
    whole[rank] = np.arange(n)
    return whole, rank, packed


class _Marks:
    """Marked places, with one flag for 64 of them, so that the next mark is found without a pass over all."""

    def __init__(self, marked: np.ndarray):
        self.marked = np.concatenate((marked, np.ones(-len(marked) % 64 + 64, bool)))
        self.some = self.marked.reshape(-1, 64).any(axis=1)

    def add(self, places: np.ndarray) -> None:
        self.marked[places] = True
        self.some[places >> 6] = True

    def _ahead(self, at: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Distance to the first mark of the next ``reach`` places, and whether there is one."""
        near = self.marked[np.minimum(at[:, None] + np.arange(1, reach + 1), len(self.marked) - 1)]
        first = near.argmax(axis=1)
        return first + 1, near[np.arange(len(at)), first]

    def widths(self, at: np.ndarray) -> np.ndarray:
        """Distance from each place to the next marked one; most are near."""
        width, found = self._ahead(at, 8)
        far = np.flatnonzero(~found)
        if len(far):
            width[far], found = self._ahead(at[far], 72)
            far = far[~found]
        if len(far):  # no mark up to 72 places on, so the first flagged block from there has it
            blocks = np.flatnonzero(self.some)
            block = blocks[np.searchsorted(blocks, (at[far] + 73) >> 6)] << 6
            width[far] = block + self.marked[block[:, None] + np.arange(64)].argmax(axis=1) - at[far]
        return width


def boundaries(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, whether each shares fewer than ``length`` symbols with the one before it)."""
    order, rank, packed = suffix_array(symbols)
    n = len(order)
    value = packed[order]
    differ = value[1:] ^ value[:-1]
    shared = np.zeros(n - 1, np.int64)  # common prefix, at most the packed symbols
    for j in range(1, _PACKED + 1):
        shared += differ < (1 << (_SYMBOL_BITS * (_PACKED - j)))
    marked = np.ones(n + 1, bool)
    marked[1:n] = shared < min(_PACKED, length)
    marks = _Marks(marked)
    back = np.where(order > 0, rank[order - 1], -1)  # the suffix one symbol longer
    before = np.where(order > 0, symbols[order - 1], 0)  # the transform
    new = np.flatnonzero(shared == _PACKED - 1) + 1
    for _ in range(_PACKED, length):
        if not len(new):
            break
        width = marks.widths(new)
        single = new[width == 1]
        wide, size = new[width > 1], width[width > 1]
        reach = back[single]
        if len(wide):
            total = np.cumsum(size)
            flat = np.repeat(wide - (total - size), size) + np.arange(total[-1])
            kind = (np.repeat(np.arange(len(wide)), size) << _SYMBOL_BITS) | before[flat]
            _, at = np.unique(kind, return_index=True)  # the first place of each symbol in each interval
            reach = np.concatenate((reach, back[flat[at]]))
        reach = reach[reach >= 0]
        new = reach[~marks.marked[reach]]  # distinct, as no two places lead to one
        marks.add(new)
    return order, marks.marked[:n]


def repeated_windows(strings: list[bytes], times: np.ndarray, window: int) -> list[np.ndarray]:
    """For each of several distinct strings, that come times[i] times, the starts of windows that come more than once in all."""
    sizes = np.array([len(s) for s in strings])
    ends = np.cumsum(sizes + 1)
    symbols = np.zeros(int(ends[-1]), np.int64)
    symbols[np.arange(len(symbols)) != np.repeat(ends - 1, sizes + 1)] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
    order, first = boundaries(symbols, window)
    group = np.cumsum(first) - 1
    of = np.repeat(np.arange(len(strings)), sizes + 1)
    found = np.empty(len(symbols), bool)
    found[order] = (np.bincount(group, weights=np.minimum(times, 2)[of[order]]) >= 2)[group]
    begin = ends - sizes - 1
    return [np.flatnonzero(found[a: a + max(0, s - window + 1)]) for a, s in zip(begin.tolist(), sizes.tolist())]


def _settled(window: int):
    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        grouped = rows.groupby("name", sort=False)
        distinct, times = grouped["bytes"].first(), grouped["times"].sum().to_numpy()
        found = repeated_windows(distinct.tolist(), times, window)
        hit = [i for i, x in enumerate(found) if len(x)]
        return pd.DataFrame({"name": [distinct.index[i] for i in hit], "found": [_ranges(found[i]) for i in hit]}, columns=["name", "found"])

    return settle


def _ranges(places: np.ndarray) -> bytes:
    """Sorted places as (first, number) pairs of 64-bit integers."""
    cut = np.flatnonzero(np.diff(places, prepend=-2) != 1)
    return np.stack((places[cut], np.diff(cut, append=len(places))), axis=1).astype("<i8").tobytes()


def _moved(rows: pd.DataFrame) -> np.ndarray:
    """(first, number) of all ranges found in the strings of one owner, as places in the owner."""
    parts = [np.frombuffer(f, "<i8").reshape(-1, 2) + [at, 0] for at, f in zip(rows["at"], rows["found"])]
    return np.concatenate(parts)


def _within_owner(links: DataFrame, found: DataFrame) -> DataFrame:
    """(name, found) of owners from (name, found) of the strings that lie in them."""
    placed = links.select("name", "owner", "at").join(found, "name").groupBy("owner").agg(F.collect_set(F.struct("at", "found")).alias("all"))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            merged = [_moved(pd.DataFrame([x.asDict() if hasattr(x, "asDict") else dict(x) for x in cells])) for cells in batch["all"]]
            yield pd.DataFrame({"name": batch["owner"], "found": [m.astype("<i8").tobytes() for m in merged]})

    return placed.mapInPandas(merge, "name binary, found binary")


def settled(strings: DataFrame, window: int, steps: tuple[int, ...] = STEPS) -> DataFrame:
    """(name, found): repeated windows of the strings of a stored table."""
    content = strings.where("bytes is not null")
    sizes = content.groupBy("key").agg(F.sum(F.octet_length("bytes")).alias("size"))
    hot = spill_to_table(sizes.where(F.col("size") > HOT_BYTES).select("key"), "hot-keys") if steps else None
    parts = []
    if hot is not None and hot.count():
        pieces = spill_to_table(joined_small(content, hot, "key", "left_semi").select("name", "n", "anchor", "times", "bytes").mapInArrow(_split(window, steps[0]), _STRINGS), "pieces")
        parts.append(_within_owner(pieces.where("owner is not null"), settled(pieces, window, steps[1:])))
        content = joined_small(content, hot, "key", "left_anti")
    total = content.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    bucket = F.pmod(F.xxhash64("key"), F.lit(max(1, math.ceil(total / BUCKET_BYTES))))
    parts.append(content.select(bucket.alias("bucket"), "name", "times", "bytes").groupBy("bucket").applyInPandas(_settled(window), "name binary, found binary"))
    return spill_to_table(parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0], "repeats")


def _cleaned(window: int, texts: bool):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            out = []
            for row, (doc, found) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("found").to_pylist())):
                piece = data[offsets[row]: offsets[row + 1]]
                ranges = np.frombuffer(found, "<i8").reshape(-1, 2)
                edge = np.zeros(len(piece) + 1, np.int64)
                np.add.at(edge, ranges[:, 0], 1)
                np.add.at(edge, ranges[:, 0] + ranges[:, 1] + window - 1, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = piece[~gone].tobytes()
                spans = int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1]))))
                out.append((doc, len(piece), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), *([kept] if texts else [])))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            columns = list(zip(*out)) or [()] * (5 + texts)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names[: 5 + texts])

    return clean


def suffix_dedup(docs: DataFrame, window: int = 400, texts: bool = False) -> DataFrame:
    """Remove each byte covered by a string of ``window`` bytes that also starts anywhere else, same document included.

    docs: doc_id and text, other columns are ignored; the result has one row per input row, rows without doc_id and repeated
    rows too (a repeated row is a second place of all its strings). Matches lie within one text. Null counts as empty; texts
    shorter than the window stay whole; texts of any length are worked on in blocks of 1 MB. No occurrence is preferred, so
    there are no ties. An empty table gives an empty result. window is at least 2 * 128 and at most 2**19. Runs Spark jobs when called.
    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with texts=True the remaining bytes as kept.
    """
    if not 2 * ANCHOR <= window <= _BLOCK // 2:
        raise ValueError(f"window is {2 * ANCHOR} to {_BLOCK // 2}")
    filled = picked(docs).withColumn("text", F.coalesce("text", F.lit("")))
    rows = filled.withColumn("name", F.expr("substring(unhex(sha2(text, 256)), 1, 16)"))
    able = rows.where(F.octet_length("text") >= window)
    runs = spill_to_table(able.select("name", "text").mapInArrow(_runs(window), "key long, name binary, at long, n int, anchor int"), "windows")
    shared = runs.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key")
    of_text = runs.join(shared, "key", "left_semi").groupBy("name").agg(
        F.collect_set(F.struct("key", "at", "n", "anchor")).alias("runs"), F.count("*").alias("rows"))
    wanted = spill_to_table(of_text.select("name", "runs", (F.col("rows") / F.size("runs")).cast("int").alias("copies")), "shared-anchors")
    touched = joined_small(able.select("name", "text"), wanted.select("name"), "name", "left_semi").join(wanted, "name")
    strings = spill_to_table(touched.mapInArrow(_cut_out(window), _STRINGS), "strings")
    found = spill_to_table(_within_owner(strings.where("owner is not null"), settled(strings, window)), "removed")
    whole = joined_small(rows, found.select("name"), "name", "left_anti")
    cut = joined_small(rows, found.select("name"), "name", "left_semi").join(found, "name").select("doc_id", "text", "found")
    same = [F.col("doc_id"), F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
            F.lit(0).cast("long").alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")]
    if texts:
        same.append(F.col("text").cast("binary").alias("kept"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    return whole.select(*same).unionByName(cut.mapInArrow(_cleaned(window, texts), schema))
