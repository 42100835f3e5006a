"""Substring deduplication with difference-cover anchors.

Words at positions whose remainder modulo a period lies in a difference cover begin an anchor. For any
two positions there is a shift below the period that puts both on the cover, so two equal windows of
``window`` words always share an anchor of window - period + 1 words at the same place inside them.
Anchors that two documents share are extended to every window around them, and those windows are
settled by the smallest doc_id that has them.

Both steps send packed entries (hash, document, place) to hash buckets, one message per bucket and
chunk of documents. What a chunk can settle by itself never travels: a hash that several of its
documents hold is known to be shared there, and of equal windows only the smallest document's goes
on. So a passage that a third of all documents hold reaches its bucket once per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.session import input_bytes, spill_to_table

from .support import SpanHasher, document_chunks, joined_small, picked, text_bytes, word_bounds

#: A perfect difference set modulo 31 (every remainder is a difference of two members).
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Input bytes per hash bucket.
BUCKET_BYTES = 4 * 1024 * 1024
#: Words of a chunk. Where all documents share their windows, a task holds some 300 bytes for each word.
CHUNK_WORDS = 400_000

_MESSAGE = "bucket long, settled boolean, base long, hash binary, proof binary, doc binary, place binary"
_SECOND_BASE = 0xC2B2AE3D27D4EB4F


def _messages(hashes, proof, docs, places, settled, buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries packed by bucket; documents as distances from the least one."""
    if not len(hashes):
        return
    base = int(docs.min())
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((docs, bucket))
    bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    width = "<u4" if int(docs.max()) - base < 2**32 else "<u8"

    def cut(values, kind):
        values = values[order].astype(kind)
        return pa.array([values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())

    n = len(bounds) - 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket[order][bounds[:-1]]), pa.array([settled] * n), pa.array([base] * n, pa.int64()),
         cut(hashes, "<u8"), cut(proof, "<u4"), cut(docs - base, width), cut(places, "<u4")],
        ["bucket", "settled", "base", "hash", "proof", "doc", "place"])


def _entries(rows: pd.DataFrame):
    """hash, proof, doc, place of messages, one behind the other."""
    def column(name, kind):
        return np.concatenate([np.frombuffer(x, kind) for x in rows[name]]) if len(rows) else np.zeros(0, kind)

    docs = [np.frombuffer(d, "<u4" if len(d) == len(p) else "<u8").astype(np.int64) + b
            for d, p, b in zip(rows["doc"], rows["place"], rows["base"])]
    return column("hash", "<u8"), column("proof", "<u4"), np.concatenate(docs) if docs else np.zeros(0, np.int64), column("place", "<u4")


def _runs(*keys) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal keys begin in sorted arrays, and the run of each element."""
    first = np.zeros(len(keys[0]), bool)
    first[:1] = True
    for key in keys:
        first[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(first), np.cumsum(first) - 1


def _anchors(window: int, buckets: int):
    length, on_cover = window - PERIOD + 1, np.isin(np.arange(PERIOD), COVER)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for ids, _, words, at in document_chunks(batches, lower=False, most=CHUNK_WORDS):
            size = np.diff(at)
            place = np.arange(len(words)) - np.repeat(at[:-1], size)
            of_doc = np.repeat(np.arange(len(ids)), size)
            start = np.flatnonzero(on_cover[place % PERIOD] & (place + length <= size[of_doc]) & (size[of_doc] >= window))
            hashes = hasher(words, start, start + length)
            order = np.argsort(hashes, kind="stable")
            hashes, start = hashes[order], start[order]
            docs, place = ids[of_doc[start]], place[start]
            first, run = _runs(hashes)
            # A hash of several documents is shared for sure: its places are settled, one entry goes on.
            least, most = (f.reduceat(docs, first) if len(first) else docs for f in (np.minimum, np.maximum))
            shared = (least < most)[run]
            alone, lead = ~shared, np.zeros(len(hashes), bool)
            lead[first] = True
            none = np.zeros(len(hashes), np.uint32)
            yield from _messages(hashes[shared], none[shared], docs[shared], place[shared], True, buckets)
            sent = alone | lead
            yield from _messages(hashes[sent], shared[sent], docs[sent], place[sent], False, buckets)

    return send


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Places whose anchor another document has; settled messages are such places already."""
    _, _, known_docs, known_places = _entries(rows[rows["settled"]])
    hashes, several, docs, places = _entries(rows[~rows["settled"]])
    order = np.argsort(hashes, kind="stable")
    hashes, several, docs, places = hashes[order], several[order], docs[order], places[order]
    first, run = _runs(hashes)
    if len(first):
        hit = ((np.minimum.reduceat(docs, first) < np.maximum.reduceat(docs, first)) | (np.maximum.reduceat(several, first) > 0))[run]
        docs, places = docs[hit], places[hit]
    return pd.DataFrame({"doc_id": np.concatenate((known_docs, docs)), "place": np.concatenate((known_places, places)).astype(np.int32)})


def _windows(window: int, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, second = SpanHasher(), SpanHasher(_SECOND_BASE)
        for ids, anchors, words, at in document_chunks(batches, lower=False, extra="places", most=CHUNK_WORDS):
            size = np.diff(at)
            # Window starts from which an anchor can be reached, by marking where such stretches begin and end.
            edge = np.zeros(len(words) + 1, np.int64)
            for i, places in enumerate(anchors):
                most = size[i] - window
                if most >= 0:
                    places = places.astype(np.int64)
                    low, high = np.maximum(places - PERIOD + 1, 0), np.minimum(places, most)
                    good = low <= high
                    np.add.at(edge, at[i] + low[good], 1)
                    np.add.at(edge, at[i] + high[good] + 1, -1)
            start = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
            of_doc = np.searchsorted(at, start, "right") - 1
            place, docs = start - at[of_doc], ids[of_doc]
            hashes = hasher(words, start, start + window)
            proof = second(words, start, start + window).astype(np.uint32)
            order = np.lexsort((docs, proof, hashes))
            hashes, proof, docs, place = hashes[order], proof[order], docs[order], place[order]
            first, run = _runs(hashes, proof)
            later = docs > docs[first][run] if len(first) else np.zeros(0, bool)
            yield from _messages(hashes[later], proof[later], docs[later], place[later], True, buckets)
            yield from _messages(hashes[~later], proof[~later], docs[~later], place[~later], False, buckets)

    return send


def _repeated(rows: pd.DataFrame) -> pd.DataFrame:
    """Places of windows that a smaller document has too."""
    _, _, known_docs, known_places = _entries(rows[rows["settled"]])
    hashes, proof, docs, places = _entries(rows[~rows["settled"]])
    order = np.lexsort((docs, proof, hashes))
    hashes, proof, docs, places = hashes[order], proof[order], docs[order], places[order]
    first, run = _runs(hashes, proof)
    if len(first):
        later = docs > docs[first][run]
        docs, places = docs[later], places[later]
    return pd.DataFrame({"doc_id": np.concatenate((known_docs, docs)), "place": np.concatenate((known_places, places)).astype(np.int32)})


def _by_document(df: DataFrame, send, settle) -> DataFrame:
    """doc_id and its sorted places after a step over hash buckets."""
    found = df.mapInArrow(send, _MESSAGE).groupBy("bucket").applyInPandas(settle, "doc_id long, place int")
    return found.groupBy("doc_id").agg(F.array_sort(F.collect_set("place")).alias("places"))


def _cover(places: np.ndarray, n: int, window: int) -> np.ndarray:
    edge = np.zeros(n + window + 1, np.int64)
    good = places[places + window <= n]
    np.add.at(edge, good, 1)
    np.add.at(edge, good + window, -1)
    return np.cumsum(edge)[:n] > 0


def _cleaned(window: int, texts: bool):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            has_places = "places" in batch.schema.names
            counts, removed, digests, kept_texts = [], [], [], []
            for i in range(len(offsets) - 1):
                piece = data[offsets[i]: offsets[i + 1]]
                start, end = word_bounds(piece)
                n, gone = len(start), 0
                if has_places and n:
                    keep = ~_cover(batch.column("places")[i].values.to_numpy(zero_copy_only=False).astype(np.int64), n, window)
                    gone = int(n - keep.sum())
                    start, end = start[keep], end[keep]
                # Each kept word with one space before it, then without the first space.
                mask = np.zeros(len(piece) + 1, np.int64)
                np.add.at(mask, start, 1)
                np.add.at(mask, end, -1)
                inside = np.flatnonzero(np.cumsum(mask[:-1]) > 0)
                kept = np.insert(piece[inside], np.searchsorted(inside, start), 0x20)[1:].tobytes()
                counts.append(n)
                removed.append(gone)
                digests.append(hashlib.sha256(kept).hexdigest())
                if texts:
                    kept_texts.append(kept.decode())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if texts:
                columns, names = [*columns, pa.array(kept_texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return clean


def substring_dedup(docs: DataFrame, window: int = 50, texts: bool = False) -> DataFrame:
    """Remove words covered by a window of words that also starts in a document with a smaller doc_id.

    docs: doc_id and text, other columns are ignored. Words are runs of bytes other than space and
    0x09-0x0D; a null text has none. Windows are judged on the input; a text shorter than a window
    keeps all words. Rows without doc_id are left out. Rows that share a doc_id count as one
    document (none repeats another), and a place found in one of them is removed in all. An empty
    table gives an empty result. window is at least the period of the cover, 31.
    Returns doc_id, n_words, n_removed, kept_sha256 (of kept words joined by one space), and with
    texts=True kept_text itself.
    """
    if window < PERIOD:
        raise ValueError(f"window is at least {PERIOD}")
    rows = picked(docs).where("doc_id is not null")
    buckets = max(64, -(-input_bytes(docs) // BUCKET_BYTES))
    near = spill_to_table(_by_document(rows, _anchors(window, buckets), _shared), "anchors")
    touched = joined_small(rows, near.select("doc_id"), "doc_id", "left_semi")
    again = touched.join(near, "doc_id")
    places = spill_to_table(_by_document(again, _windows(window, buckets), _repeated), "windows")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts
    whole = joined_small(rows, places.select("doc_id"), "doc_id", "left_anti")
    cut = joined_small(rows, places.select("doc_id"), "doc_id", "left_semi").join(places, "doc_id")
    clean = _cleaned(window, texts)
    return whole.mapInArrow(clean, schema).unionByName(cut.mapInArrow(clean, schema))
