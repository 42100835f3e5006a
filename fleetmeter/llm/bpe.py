"""Byte-level BPE encoding and decoding with segment trees over adjacent pair ranks.

Texts are cut into words by the tokenizer's pattern, each new word of a task is merged once, and
ids are gathered from what the task knows. Merging works on many words of similar length side by
side: one segment tree per word holds the rank of each adjacent pair, its root names the lowest
rank, a descent that prefers the left child finds the leftmost place, and a merge updates three
leaves and their ancestors, until no root holds a rank.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import SpanHasher, filled, gathered, picked, text_bytes

#: Code points that one numpy step encodes at a time (a longer text is cut between words).
BLOCK_CHARS = 1_000_000
#: Words that a task remembers before it starts anew.
KNOWN_WORDS = 1_000_000

_NONE = np.int32(2**30)
_SPACE, _LETTER, _NUMBER, _OTHER, _END = range(5)
#: Marks outside Unicode between texts, and in place of the special token.
_STOP, _SPECIAL = 0x110000, 0x110001
#: The contractions of the pattern, by their length after the apostrophe.
_SHORT, _LONG = ("s", "t", "m", "d"), ("re", "ve", "ll")


@dataclass
class Vocabulary:
    """Arrays of a byte-level BPE tokenizer file (bounded by its vocabulary, about 2 MB)."""

    byte_id: np.ndarray  # id of each byte
    pair: np.ndarray  # hash table of pairs: left << 32 | right
    rank: np.ndarray  # rank by slot of the hash table
    merged: np.ndarray  # id made by each rank
    token: np.ndarray  # bytes of all tokens
    token_at: np.ndarray  # where each id's bytes begin, and the end
    kind: np.ndarray  # class of each code point
    special: str
    special_id: int


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte: its own where printable, else the next from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str | None = None) -> Vocabulary:
    """Read a tokenizer file on the driver; path defaults to the public byte_bpe_50k.json."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, vocab = _byte_letters(), spec["model"]["vocab"]
    byte_id = np.zeros(256, np.int32)
    for letter, b in letters.items():
        byte_id[b] = vocab[letter]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
    keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
    pair = np.full(1 << (2 + len(keys).bit_length()), -1, np.int64)
    rank = np.full(len(pair), _NONE, np.int32)
    for i, (key, slot) in enumerate(zip(keys.tolist(), _slot(keys, len(pair)).tolist())):
        while pair[slot] >= 0:
            slot = (slot + 1) % len(pair)
        pair[slot], rank[slot] = key, i
    (added,) = spec["added_tokens"]
    content = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
    content[added["id"]] = added["content"].encode()
    size = max(content) + 1
    tokens = [content.get(i, b"") for i in range(size)]
    kinds = {"L": _LETTER, "N": _NUMBER}
    kind = np.array([kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)] + [_END] * 2, np.uint8)
    # The code points with the Unicode property White_Space.
    kind[[*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return Vocabulary(
        byte_id, pair, rank, merged, np.frombuffer(b"".join(tokens), np.uint8),
        np.concatenate(([0], np.cumsum([len(t) for t in tokens]))), kind, added["content"], added["id"],
    )


def _slot(key: np.ndarray, size: int) -> np.ndarray:
    shift = np.uint64(65 - int(size).bit_length())
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)


def pair_rank(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each pair of ids, or a value above all ranks; a negative id pairs with nothing."""
    key = left.astype(np.int64) << 32 | right.astype(np.int64)
    slot = _slot(key, len(v.pair))
    found = v.pair[slot]
    out = np.where(found == key, v.rank[slot], _NONE)
    open_ = np.flatnonzero((found != key) & (found >= 0))
    while len(open_):
        slot[open_] = (slot[open_] + 1) % len(v.pair)
        found = v.pair[slot[open_]]
        hit = found == key[open_]
        out[open_[hit]] = v.rank[slot[open_[hit]]]
        open_ = open_[~hit & (found >= 0)]
    out[(left < 0) | (right < 0)] = _NONE
    return out


def _merge_block(v: Vocabulary, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words of at most ``width`` bytes (a power of two), and the number of ids of each."""
    n = len(words)
    length = np.fromiter(map(len, words), np.int64, n)
    symbol = np.full((n, width + 1), -1, np.int32)  # the last column is never filled
    inside = np.arange(width + 1) < length[:, None]
    symbol[inside] = v.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    after = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
    before = after - 2
    tree = [pair_rank(v, symbol[:, :-1].ravel(), symbol[:, 1:].ravel()).reshape(n, width)]
    while tree[-1].shape[1] > 1:
        tree.append(np.minimum(tree[-1][:, ::2], tree[-1][:, 1::2]))
    root = tree[-1][:, 0]

    def update(rows: np.ndarray, at: np.ndarray, value) -> None:
        tree[0][rows, at] = value
        for level in range(1, len(tree)):
            at = at >> 1
            below = tree[level - 1]
            tree[level][rows, at] = np.minimum(below[rows, 2 * at], below[rows, 2 * at + 1])

    rows = np.flatnonzero(root < _NONE)
    while len(rows):
        best, at = root[rows], np.zeros(len(rows), np.int64)
        for below in reversed(tree[:-1]):
            at = 2 * at
            at += below[rows, at] != best
        gone = after[rows, at]
        far = after[rows, gone]
        new = v.merged[best]
        symbol[rows, at], symbol[rows, gone] = new, -1
        after[rows, at] = far
        linked = far <= width
        before[rows[linked], far[linked]] = at[linked]
        right = np.where(linked, symbol[rows, np.minimum(far, width)], -1)
        pre = before[rows, at]
        left = np.where(pre >= 0, symbol[rows, pre], -1)
        in_tree = gone < width
        update(rows[in_tree], gone[in_tree], _NONE)
        update(rows, at, pair_rank(v, new, right))
        some = pre >= 0
        update(rows[some], pre[some], pair_rank(v, left[some], new[some]))
        rows = rows[root[rows] < _NONE]
    alive = symbol >= 0
    return symbol[alive], alive.sum(1)


def merge_words(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one behind the other, and the number of ids of each."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    width = np.left_shift(1, np.ceil(np.log2(np.maximum(length, 2))).astype(np.int64))
    flat, count, start = [], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    filled_to = 0
    for w in np.unique(width):
        of_width = np.flatnonzero(width == w)
        step = max(1, 1_000_000 // int(w))
        for part in (of_width[i: i + step] for i in range(0, len(of_width), step)):
            ids, n = _merge_block(v, [words[i] for i in part], int(w))
            count[part], start[part] = n, filled_to + np.cumsum(n) - n
            flat.append(ids)
            filled_to += len(ids)
    return gathered(np.concatenate(flat) if flat else np.zeros(0, np.int32), start, count), count


def word_starts(codes: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where the pattern's words begin: runs of letters, numbers or other characters with one space
    before them, contractions, and what white space is left."""
    n = len(codes)
    is_start = np.ones(n, bool)
    is_start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _END)
    first = np.flatnonzero(is_start)
    last = np.concatenate((first[1:], [n])) - 1
    # The last character of white space before something else stands alone, or joins it if it is a space.
    tail = last[(kind[first] == _SPACE) & (last + 1 < n)]
    tail = tail[kind[tail + 1] != _END]
    is_start[tail] = True
    is_start[tail[codes[tail] == 0x20] + 1] = False
    mark = np.flatnonzero((codes == 0x27) & is_start)
    mark = mark[mark + 1 < n]
    second = codes[np.minimum(mark + 2, n - 1)]
    for tail_text in (*_SHORT, *_LONG):
        hit = codes[mark + 1] == ord(tail_text[0])
        if len(tail_text) == 2:
            hit &= (mark + 2 < n) & (second == ord(tail_text[1]))
        at = mark[hit]
        is_start[at + 1] = False
        rest = at + 1 + len(tail_text)
        rest = rest[rest < n]
        # A space that follows belongs to the next word as before.
        is_start[rest[kind[rest] == _LETTER]] = True
    return np.flatnonzero(is_start)


class Encoder:
    """Encodes texts for one task, remembering the words it has met."""

    def __init__(self, v: Vocabulary):
        self.v, self.hasher = v, SpanHasher()
        self._forget()

    def _forget(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def __call__(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that marks separate, and how many each text has (as many as there are _STOP marks)."""
        kind = self.v.kind[codes]
        start = word_starts(codes, kind)
        end = np.concatenate((start[1:], [len(codes)]))
        hashes = self.hasher(codes.astype(np.uint32) + np.uint32(1), start, end)
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        slot = self._slots(distinct, codes, start[at], end[at])[which]
        count = self.count[slot]
        ids = gathered(self.ids, self.start[slot], count)
        until = np.cumsum(count)[codes[start] == _STOP]
        return ids, np.diff(np.concatenate(([0], until)))

    def _slots(self, distinct, codes, start, end) -> np.ndarray:
        at = np.searchsorted(self.key, distinct)
        known = np.zeros(len(distinct), bool)
        if len(self.key):
            known = self.key[np.minimum(at, len(self.key) - 1)] == distinct
        if len(self.key) + len(distinct) > KNOWN_WORDS and len(self.key):
            self._forget()
            return self._slots(distinct, codes, start, end)
        new = np.flatnonzero(~known)
        if len(new):
            marks = codes[start[new]]
            text = np.where(codes < _STOP, codes, 0x20).astype("<u4").tobytes().decode("utf-32-le")
            words = [
                b"" if m >= _STOP else text[s:e].encode()
                for m, s, e in zip(marks.tolist(), start[new].tolist(), end[new].tolist())
            ]
            ids, count = merge_words(self.v, words)
            if (special := np.flatnonzero(marks == _SPECIAL)).size:
                where = (np.cumsum(count) - count)[special]
                ids = np.insert(ids, where, self.v.special_id)
                count[special] = 1
            place = at[new]
            self.key = np.insert(self.key, place, distinct[new])
            self.start = np.insert(self.start, place, len(self.ids) + np.cumsum(count) - count)
            self.count = np.insert(self.count, place, count)
            self.ids = np.concatenate((self.ids, ids))
            at = np.searchsorted(self.key, distinct)
        return at


def _codes(text: str, special: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if special and special in text:
        keep, at = [], 0
        while (found := text.find(special, at)) >= 0:
            keep += [codes[at:found], np.array([_SPECIAL], np.uint32)]
            at = found + len(special)
        codes = np.concatenate([*keep, codes[at:]])
    return codes


def _pieces(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Parts of a long text, cut before a space between two characters that aren't white space."""
    at = 0
    while len(codes) - at > BLOCK_CHARS:
        cut = at + BLOCK_CHARS
        while cut < len(codes) - 1:
            c = codes[cut - 1: cut + 4096]
            plain = (c > 0x20) & (c < 0x7F)
            hit = np.flatnonzero(plain[:-2] & (c[1:-1] == 0x20) & plain[2:])
            if len(hit):
                cut += int(hit[0])
                break
            cut += 4094
        cut = min(cut, len(codes))
        yield codes[at:cut]
        at = cut
    yield codes[at:]


def encoded(batch: pa.RecordBatch, encoder: Encoder) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(row, ids, whether they are the row's last) for each row of a batch; null counts as empty."""
    stop = np.array([_STOP], np.uint32)
    rows, parts, size = [], [], 0

    def flush():
        ids, count = encoder(np.concatenate(parts))
        end = np.cumsum(count)
        for (row, final), e, c in zip(rows, end.tolist(), count.tolist()):
            yield row, ids[e - c: e], final

    data, offsets = text_bytes(batch.column("text"))
    for row in range(len(offsets) - 1):
        text = data[offsets[row]: offsets[row + 1]].tobytes().decode()
        pieces = list(_pieces(_codes(text, encoder.v.special)))
        for i, codes in enumerate(pieces):
            if rows and size + len(codes) > BLOCK_CHARS:
                yield from flush()
                rows, parts, size = [], [], 0
            rows.append((row, i == len(pieces) - 1))
            parts += [codes, stop]
            size += len(codes) + 1
    if rows:
        yield from flush()


class _Digests:
    """SHA-256 of the decimal ids and of the decoded text of one document, fed piece by piece."""

    def __init__(self, v: Vocabulary):
        self.v = v
        numbers = [b"%d," % i for i in range(len(v.token_at) - 1)]
        self.number = np.frombuffer(b"".join(numbers), np.uint8)
        self.number_len = np.fromiter(map(len, numbers), np.int64, len(numbers))
        self.number_at = np.cumsum(self.number_len) - self.number_len
        self.token_len = np.diff(v.token_at)
        self.fresh()

    def fresh(self) -> None:
        self.n, self.of_ids, self.of_text = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray) -> None:
        if not len(ids):
            return
        text = gathered(self.number, self.number_at[ids], self.number_len[ids]).tobytes()[:-1]
        self.of_ids.update(b"," * (self.n > 0) + text)
        self.of_text.update(self.decode(ids).encode())
        self.n += len(ids)

    def decode(self, ids: np.ndarray) -> str:
        return gathered(self.v.token, self.v.token_at[ids], self.token_len[ids]).tobytes().decode("utf-8", "replace")


def encode_decode(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Encode every whole text, then decode the ids.

    docs: doc_id and text; other columns are ignored. A null text counts as empty and has no ids.
    Repeated rows and rows without doc_id come out as they came in. An empty table gives an empty result.
    The special token's own string in a text becomes its id, as the tokenizers library does by default.
    Returns doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256 (of UTF-8).
    """
    v = load_vocabulary(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, digests = Encoder(v), _Digests(v)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for _, ids, final in encoded(batch, encoder):
                digests.add(ids)
                if final:
                    counts.append(digests.n)
                    of_ids.append(digests.of_ids.hexdigest())
                    of_text.append(digests.of_text.hexdigest())
                    digests.fresh()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = picked(docs).select("doc_id", filled().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_ids(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id and ids (array<int>) of every whole text, for use of the ids themselves; as encode_decode."""
    v = load_vocabulary(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(v)
        for batch in batches:
            parts, out = [], []
            for _, ids, final in encoded(batch, encoder):
                parts.append(ids)
                if final:
                    out.append(np.concatenate(parts))
                    parts = []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return picked(docs).select("doc_id", filled().alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encodings: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """doc_id and text of arrays of ids; null ids count as empty, bytes that are no UTF-8 become U+FFFD."""
    v = load_vocabulary(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = _Digests(v)
        for batch in batches:
            texts = [digests.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encodings.select("doc_id", F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")
