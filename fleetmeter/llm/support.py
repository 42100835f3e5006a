"""Shared helpers: tables, word hashes of Arrow text, and gathers of variable-length pieces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step handles at a time (a longer text is cut between words); its arrays of
#: eight bytes a place stay in the CPU's caches.
BLOCK_BYTES = 128 * 1024

_HASH_BASE = 0x9E3779B97F4A7C15 | 1
_MIX_1 = 0xBF58476D1CE4E5B9
_MIX_2 = 0x94D049BB133111EB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that go to Python at a time; documents are long, and Spark's default of 10,000 is meant for short rows.
BATCH_ROWS = 1_000


def short_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to BATCH_ROWS where it is above (it is read when a plan starts)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def picked(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The two columns an operator works on, under its own names; other columns, whatever
    they are called, stay behind."""
    short_batches(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def filled(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(_MIX_1)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(_MIX_2)
    return h ^ (h >> np.uint64(31))


#: Span hashes are polynomials modulo this prime; modulo a power of two, some structured texts collide at every base.
_PRIME = (1 << 61) - 1
_P, _LOW30, _LOW31 = np.uint64(_PRIME), np.uint64((1 << 30) - 1), np.uint64((1 << 31) - 1)
_30, _31, _61 = np.uint64(30), np.uint64(31), np.uint64(61)
#: Symbols whose sum is below this may be weighted by 31-bit halves and summed without reduction.
_PLAIN_SUM = 1 << 33


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime."""
    x = (x & _P) + (x >> _61)
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, both below it: 2**61 counts as 1, so halves of 30 and 31 bits stay within 64 bits."""
    ah, al, bh, bl = a >> _31, a & _LOW31, b >> _31, b & _LOW31
    middle = ah * bl + al * bh
    return _reduced(((ah * bh) << np.uint64(1)) + (middle >> _30) + ((middle & _LOW30) << _31) + al * bl)


class SpanHasher:
    """64-bit hashes of spans of a symbol sequence from cumulative sums.

    A span's hash is a polynomial in its symbols at a fixed base, modulo 2**61 - 1, scrambled
    together with its length; it depends on nothing outside the span.
    """

    def __init__(self, base: int = _HASH_BASE):
        self.base, self.inverse = base % _PRIME, pow(base, -1, _PRIME)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) <= n:
            size = 1 << max(10, int(n).bit_length())
            for name, b in (("up", self.base), ("down", self.inverse)):
                step = np.ones(1, np.uint64)
                while len(step) < size:
                    step = np.concatenate((step, _times(step, np.uint64(pow(b, len(step), _PRIME)))))
                setattr(self, name, step)

    def __call__(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """symbols: uint64, or uint16 or uint32 below 2**22; start, end: span bounds."""
        n = len(symbols)
        self._powers(n)
        up = self.up[:n]
        wide, symbols = symbols.dtype == np.uint64, symbols.astype(np.uint64)
        if wide:
            terms = _times(_reduced(symbols), up)
        else:
            high, low = symbols * (up >> _31), symbols * (up & _LOW31)
            plain = int(symbols.sum()) < _PLAIN_SUM
            terms = None if plain else _reduced(((high & _LOW30) << _31) + (high >> _30) + low)
        if terms is not None:
            high, low = terms >> _31, terms & _LOW31
        sums = []
        for part in (high, low):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(part, out=total[1:])
            sums.append(total[end] - total[start])
        high, low = sums
        value = _reduced(((high & _LOW30) << _31) + _reduced(high >> _30) + _reduced(low))
        return mixed(_times(value, self.down[start]) + (end - start).astype(np.uint64) * np.uint64(_HASH_BASE))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_PLAIN = np.arange(1, 257, dtype=np.uint16)
_LOWER = np.arange(256)
_LOWER[ord("A"): ord("Z") + 1] += 32
_LOWERED = _PLAIN[_LOWER]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than space and 0x09-0x0D."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8)))
    return edge[::2], edge[1::2]


def _cut(data: np.ndarray, at: int) -> int:
    """The first place from ``at`` on where a piece can end without splitting a word."""
    while at < len(data):
        gap = np.flatnonzero(_SPACE[data[at: at + 4096]])
        if len(gap):
            return at + int(gap[0])
        at += 4096
    return len(data)


def word_hashes(data: np.ndarray, hasher: SpanHasher, lower: bool) -> np.ndarray:
    """The hash of each word of one text given as bytes."""
    values, out, at = _LOWERED if lower else _PLAIN, [], 0
    while at < len(data):
        end = _cut(data, min(at + BLOCK_BYTES, len(data)))
        piece = data[at:end]
        out.append(hasher(values[piece], *word_bounds(piece)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets behind a string column without copying; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def document_words(batch: pa.RecordBatch, hasher: SpanHasher, lower: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of its words) for each row of a batch; short texts are hashed together."""
    data, offsets = text_bytes(batch.column("text"))
    n, row = len(offsets) - 1, 0
    values = _LOWERED if lower else _PLAIN
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1)
        if stop == row + 1:
            yield row, word_hashes(data[offsets[row]: offsets[stop]], hasher, lower)
        else:
            piece = data[offsets[row]: offsets[stop]]
            inner = offsets[row: stop + 1] - offsets[row]
            start, end = _bounds_within(piece, inner)
            hashes = hasher(values[piece], start, end)
            of_doc = np.searchsorted(start, inner)
            for i in range(stop - row):
                yield row + i, hashes[of_doc[i]: of_doc[i + 1]]
        row = stop


def _bounds_within(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word bounds over several texts that lie back to back: a text's end also ends its words."""
    word = ~_SPACE[data]
    before = np.concatenate(([False], word[:-1]))
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    start = np.flatnonzero(word & ~before)
    after = np.concatenate((word[1:], [False]))
    after[inner - 1] = False
    return start, np.flatnonzero(word & ~after) + 1


#: Words of a chunk of whole documents.
CHUNK_WORDS = 2_000_000


def document_chunks(batches: Iterator[pa.RecordBatch], lower: bool, extra: str | None = None, most: int = CHUNK_WORDS):
    """(doc ids, their extra cells, words of all, where each document's words begin) of chunks of whole documents."""
    hasher, ids, cells, parts, size = SpanHasher(), [], [], [], 0
    for batch in batches:
        names = batch.column("doc_id").to_pylist()
        extras = batch.column(extra) if extra else None
        for row, words in document_words(batch, hasher, lower):
            ids.append(names[row])
            cells.append(extras[row].values.to_numpy(zero_copy_only=False) if extra else None)
            parts.append(words)
            size += len(words)
            if size >= most:
                yield _chunk(ids, cells, parts)
                ids, cells, parts, size = [], [], [], 0
    if ids:
        yield _chunk(ids, cells, parts)


def _chunk(ids, cells, parts):
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.array(ids, np.int64), cells, np.concatenate(parts), np.concatenate(([0], np.cumsum(lengths)))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words in order; a shorter text is one run; no word, no run."""
    if len(words) == 0:
        return words
    size = min(n, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        total = mixed(total + words[i: len(words) - size + 1 + i] + np.uint64(i))
    return total


def gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pieces flat[start[i] : start[i] + length[i]], one behind the other."""
    total = np.cumsum(length)
    if not len(total) or total[-1] == 0:
        return flat[:0]
    return flat[np.repeat(start - (total - length), length) + np.arange(total[-1])]


#: Ids that are broadcast at most (8 bytes each, 32 MB in all); beyond it the join shuffles.
BROADCAST_IDS = 4_000_000


def joined_small(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """Join with a stored table of ids: broadcast if its counted rows are few enough."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, how)
