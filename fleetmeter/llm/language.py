"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 drawn from its code point. An n-gram's vector binds
its letters' vectors, each rotated by its place, by multiplication. A text is the bundle (sum) of
its n-grams' vectors, a language the bundle of its documents, and a text goes to the language
whose bundle has the highest cosine with its own. Bundles add up, so tasks sum their own per
language and Spark adds the sums by language and dimension; what reaches the driver is one vector
per language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import filled, mixed, short_batches

DIMENSIONS = 1024
#: What a text without letters is called.
UNKNOWN = "und"
#: Characters read at a time, and n-grams whose vectors a task remembers.
BLOCK_CHARS, KNOWN_GRAMS = 250_000, 60_000
_GRAM = 3
_CODE_BITS = 21
_TEXT_END = 1


class Profiler:
    """Counts letter n-grams of texts and turns counts into bundles, for one task."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.keys, self.vectors = np.zeros(0, np.int64), np.zeros((0, dimensions), np.int8)
        code = np.arange(0x110000)
        self.is_letter = np.fromiter((chr(c).isalpha() for c in code), bool, len(code))

    def letters(self, codes: np.ndarray) -> np.ndarray:
        """+1 and -1 per dimension for each code point; 0 stands for a gap between words."""
        words = self.dimensions // 64
        seed = codes.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64)
        bits = np.unpackbits(mixed(mixed(seed + np.uint64(0x51ED270B))).view(np.uint8).reshape(len(codes), -1), axis=1)
        return (1 - 2 * bits.astype(np.int8)).astype(np.int8)

    def bind(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones((len(keys), self.dimensions), np.int8)
        for place in range(_GRAM):
            codes, which = np.unique(keys >> (_CODE_BITS * place) & (2**_CODE_BITS - 1), return_inverse=True)
            out *= np.roll(self.letters(codes), place, axis=1)[which]
        return out

    def vectors_of(self, keys: np.ndarray) -> np.ndarray:
        """Vectors of sorted distinct n-grams."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        new = keys if not len(self.keys) else keys[self.keys[at] != keys]
        if len(new):
            if len(self.keys) + len(new) > KNOWN_GRAMS:
                return self.bind(keys)
            order = np.searchsorted(self.keys, new)
            self.vectors = np.insert(self.vectors, order, self.bind(new), axis=0)
            self.keys = np.insert(self.keys, order, new)
            at = np.searchsorted(self.keys, keys)
        return self.vectors[at]

    def grams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, n-gram key) of all n-grams; a text's letters, lower-cased, with gaps as one 0."""
        codes = [np.frombuffer((t.lower()).encode("utf-32-le"), np.uint32) for t in texts]
        lengths = np.fromiter(map(len, codes), np.int64, len(codes))
        flat = np.concatenate([x for c in codes for x in (c, np.zeros(1, np.uint32))])
        owner = np.repeat(np.arange(len(codes)), lengths + 1)
        flat = np.where(self.is_letter[flat], flat, 0).astype(np.int64)
        first = np.ones(len(flat), bool)
        first[1:] = owner[1:] != owner[:-1]
        keep = (flat > 0) | np.concatenate(([True], flat[:-1] > 0)) & ~first
        flat, owner = flat[keep], owner[keep]
        # A gap before the first letter as well, so that a word's start counts.
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, np.int64)
        flat, owner = np.insert(flat, starts, 0), np.insert(owner, starts, owner[starts])
        if len(flat) < _GRAM:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key = flat[:-2] << 2 * _CODE_BITS | flat[1:-1] << _CODE_BITS | flat[2:]
        same = owner[:-2] == owner[2:]
        return owner[:-2][same], key[same]

    def bundles(self, texts: list[str]) -> np.ndarray:
        """One row per text; sums of whole numbers, exact in doubles."""
        return self.measured(texts)[0]

    def measured(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The bundles, and the number of n-grams of each text."""
        out = np.zeros((len(texts), self.dimensions))
        owner, key = self.grams(texts)
        if len(key):
            keys, which = np.unique(key, return_inverse=True)
            for at in range(0, len(keys), 8192):
                part = (which >= at) & (which < at + 8192)
                width = min(8192, len(keys) - at)
                counts = np.bincount(owner[part] * width + which[part] - at, minlength=len(texts) * width)
                out += counts.reshape(len(texts), width).astype(np.float32) @ self.vectors_of(keys[at: at + 8192]).astype(np.float32)
        return out, np.bincount(owner, minlength=len(texts))


def _groups(texts: list[str], size: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    start, total = 0, 0
    for i, text in enumerate(texts):
        if total + len(text) > size and i > start:
            yield start, i
            start, total = i, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)


def _slices(text: str) -> list[str]:
    """Parts of a long text, cut at a space where there is one near."""
    out, at = [], 0
    while len(text) - at > BLOCK_CHARS:
        cut = text.rfind(" ", at + BLOCK_CHARS // 2, at + BLOCK_CHARS)
        cut = at + BLOCK_CHARS if cut < 0 else cut
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def _bundled(profiler: Profiler, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bundles, numbers of n-grams) group by group."""
    for start, end in _groups(texts):
        group = texts[start:end]
        if len(group) == 1:
            parts = [profiler.measured([part]) for part in _slices(group[0])]
            yield start, sum(b for b, _ in parts), sum(n for _, n in parts)
        else:
            yield start, *profiler.measured(group)


def learn(labelled: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The bundle of each lang over rows of lang and text, summed by Spark from each task's sums."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler, sums = Profiler(dimensions), {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for start, bundles, _ in _bundled(profiler, texts):
                of = np.array(langs[start: start + len(bundles)], object)
                for lang in set(of):
                    sums[lang] = sums.get(lang, 0) + bundles[of == lang].sum(0)
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(names, dimensions), pa.string()) if names else pa.array([], pa.string()),
             pa.array(np.tile(np.arange(dimensions), len(names)), pa.int32()),
             pa.array(np.concatenate([sums[n] for n in names]).astype(np.int64) if names else [], pa.int64())],
            ["lang", "dimension", "total"])

    rows = labelled.mapInArrow(add, "lang string, dimension int, total long").groupBy("lang", "dimension").agg(F.sum("total").alias("total"))
    profiles = rows.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("dimension", "total"))), lambda x: x["total"]).alias("v"))
    return {r["lang"]: np.array(r["v"], float) for r in profiles.orderBy("lang").collect()}


def identify(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Predict the language of every whole text from profiles of the documents that aren't held out.

    docs: doc_id, text, lang; other columns are ignored. Held out are rows with crc32(doc_id as text) mod 4 = 2;
    profiles come from text and lang of the other rows whose lang isn't null. A null text or one
    without a letter is "und" with score 0, and so is every text if nothing could be learnt. Ties
    go to the language that sorts first. Repeated rows come out as often; a row without doc_id is
    predicted, neither held out nor learnt from. An empty table gives an empty result.
    Texts of any length count whole, cut into slices for the sums. Returns doc_id, held_out, lang_pred, score (the cosine, not
    below 0, to six decimals), row, a hash of the text, letters, whether it has any,
    and grams, the number of its letter n-grams.
    """
    if dimensions % 64:
        raise ValueError("dimensions is a multiple of 64")
    short_batches(docs.sparkSession)
    ident = F.col("doc_id").cast("string").cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), filled().cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
        F.coalesce(F.crc32(ident) % 4 == 2, F.lit(False)).alias("held_out"), F.xxhash64(F.col("text").cast("string")).alias("row"))
    profiles = learn(rows.where("NOT held_out AND lang IS NOT NULL AND doc_id IS NOT NULL").select("lang", "text"), dimensions)
    names = sorted(profiles)
    matrix = np.array([profiles[n] / (np.linalg.norm(profiles[n]) or 1) for n in names]).reshape(len(names), dimensions)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiler = Profiler(dimensions)
        for batch in batches:
            pred, score, letters, grams = [], [], [], []
            for _, bundles, sizes in _bundled(profiler, batch.column("text").to_pylist()):
                norm = np.sqrt((bundles**2).sum(1))
                letters += (norm > 0).tolist()
                grams += sizes.tolist()
                if names:
                    cosine = np.round(bundles @ matrix.T / np.where(norm, norm, 1)[:, None], 6)
                    best = cosine.argmax(1)
                    pred += [names[b] if n else UNKNOWN for b, n in zip(best, norm)]
                    score += np.where(norm > 0, np.clip(cosine.max(1), 0, 1), 0).tolist()
                else:
                    pred += [UNKNOWN] * len(bundles)
                    score += [0.0] * len(bundles)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), batch.column("row"), pa.array(letters, pa.bool_()), pa.array(grams, pa.int64())],
                ["doc_id", "held_out", "lang_pred", "score", "row", "letters", "grams"])

    return rows.select("doc_id", "text", "held_out", "row").mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double, row long, letters boolean, grams long")
