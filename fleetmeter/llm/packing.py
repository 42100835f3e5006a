"""Packing token sequences: best-fit decreasing over a segment tree of open windows by remaining capacity.

Tokens never travel: a map task encodes whole texts, cuts full windows off the front and keeps the
length and checksum of each piece. A full window is a sequence of its own. The rests, a few
numbers each, are dealt over groups whose number follows the number of documents, and each group
is packed best-fit decreasing. Sequence ids are made of the group and a number within it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.session import spill_to_table

from .bpe import Encoder, encoded, load_vocabulary
from .support import filled, picked

WINDOW = 2048
#: Rests that one group packs; more only lessens the padding at a group's end.
GROUP_ROWS = 20_000


class OpenWindows:
    """Segment tree over remaining capacities 0..size: which have an open window, and which windows."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.stacks: dict[int, list[int]] = {}

    def _change(self, capacity: int, by: int) -> None:
        at = self.leaves + capacity
        while at:
            self.count[at] += by
            at >>= 1

    def open(self, window: int, capacity: int) -> None:
        self.stacks.setdefault(capacity, []).append(window)
        self._change(capacity, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take the window with the least remaining capacity of at least ``need``."""
        at, count = self.leaves + need, self.count
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        self._change(capacity, -1)
        return self.stacks[capacity].pop(), capacity


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each length; the longest go first, ties in the given order."""
    tree, opened = OpenWindows(window), 0
    place, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = tree.tightest(n)
        if found is None:
            found, opened = (opened, window), opened + 1
        number, capacity = found
        place[i], offset[i] = number, window - capacity
        if capacity > n:
            tree.open(number, capacity - n)
    return place, offset


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, window: int = WINDOW, tokenizer_path: str | None = None, end_id: int = 1) -> DataFrame:
    """Cut every document, its end id included, into full windows and a rest."""
    v = load_vocabulary(tokenizer_path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(v), np.array([end_id], np.int64)
        for batch in batches:
            docs_of, parts = batch.column("doc_id").to_pylist(), []
            out: list[tuple] = []
            for row, ids, final in encoded(batch, encoder):
                parts.append(ids)
                if final:
                    whole = np.concatenate([*parts, end]).astype("<u4")
                    parts = []
                    for at in range(0, len(whole), window):
                        piece = whole[at: at + window]
                        out.append((docs_of[row], at, len(piece), zlib.crc32(piece.tobytes()), len(whole)))
            columns = list(zip(*out)) or [()] * 5
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return picked(docs).select("doc_id", filled().alias("text")).mapInArrow(cut, PIECE)


def pack(docs: DataFrame, window: int = WINDOW, tokenizer_path: str | None = None, end_id: int = 1,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens.

    docs: doc_id and text; other columns are ignored. A null or empty text is its end id alone.
    Repeated rows and rows without doc_id are packed like any other. An empty table gives an
    empty result. Every id lies in exactly one piece; pieces fill a sequence from offset 0 without gaps.
    Returns per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    """
    cut = spill_to_table(pieces(docs, window, tokenizer_path, end_id), "pieces")
    whole, rest = cut.where(F.col("length") == window), cut.where(F.col("length") < window)
    groups = max(1, math.ceil(rest.count() / group_rows))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        number, offset = best_fit_decreasing(rows["length"].to_numpy(), window)
        rows["sequence_id"] = (rows["group"].to_numpy() << 24 | number) << 1 | 1
        rows["offset"] = offset
        return rows.drop(columns="group")

    dealt = rest.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    packed = dealt.groupBy("group").applyInPandas(fit, f"{PIECE}, sequence_id long, offset long")
    # Odd ids name a group and a window in it, even ids the full windows.
    alone = whole.withColumns({"sequence_id": F.monotonically_increasing_id() * 2, "offset": F.lit(0).cast("long")})
    return packed.unionByName(alone)
