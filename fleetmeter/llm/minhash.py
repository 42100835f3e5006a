"""Near-duplicate detection: MinHash with tensored banding, links confirmed on full shingle sets.

Two small collections of half keys (each a few minhashes) are computed per document; every pair of
a first and a second half is a table key, so m halves a side stand for m * m tables at a cost that
grows with m. Documents with equal sets are one node. Halves that only one node has can't make a
shared table, so only shared halves are paired.

Candidates are never paired up within a table. First each node is held against the nodes that head
most of its tables, which gathers groups of copies into components. What is left are tables
that hold more than one component: their nodes are dealt into blocks, and blocks whose nodes could
still link two components are compared by matrix products; a block reports at most a spanning
forest. No two nodes that share a table escape, except inside a component.
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

from .components import components
from .support import SpanHasher, document_words, joined_small, mixed, picked, shingles

#: Minhashes per half key, and the chance that two documents at the threshold share no table.
HALF_ROWS, MISS = 3, 2e-5
#: Table heads that a node is held against first (the rest is compared in blocks).
HEADS = 2
#: Nodes of a block.
BLOCK_NODES = 256


def half_keys(percent: int, rows: int = HALF_ROWS, miss: float = MISS) -> int:
    """Half keys a side so that a pair at the threshold shares one on both sides but for ``miss``."""
    return math.ceil(math.log(miss / 2) / math.log(1 - (percent / 100) ** rows))


def _signer(words: int, halves: int, rows: int):
    """doc_id, text to doc_id, n (size of the set), digest of the set, and 2 * halves half keys."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        seeds = mixed(np.arange(1, 2 * halves * rows + 1, dtype=np.uint64)) | np.uint64(1)
        place = np.arange(2 * halves, dtype=np.uint64)
        for batch in batches:
            sizes, digests, keys = [], [], []
            for _, hashes in document_words(batch, hasher, lower=True):
                items = np.unique(shingles(hashes, words))
                sizes.append(len(items))
                digests.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                keys.append(_halves(items, seeds, place, rows) if len(items) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n", "digest", "halves"])

    return sign


def _halves(items: np.ndarray, seeds: np.ndarray, place: np.ndarray, rows: int) -> np.ndarray:
    least = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 4096):
        spread = items[at: at + 4096]
        np.minimum(least, np.array([(spread * s).min() for s in seeds]), out=least)
    key = place.copy()
    for least_of in least.reshape(len(place), rows).T:
        key = mixed(key + least_of)
    return key.view(np.int64)


def _sets(words: int):
    """doc_id, text to doc_id and its sorted set of shingle hashes."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            items = [np.unique(shingles(h, words).view(np.int64)) for _, h in document_words(batch, hasher, lower=True)]
            at = 0
            while at < len(items):
                stop, size = at, 0
                while stop < len(items) and size < 1_000_000:
                    size, stop = size + len(items[stop]), stop + 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, stop - at), pa.array(items[at:stop], pa.list_(pa.int64()))], ["doc_id", "items"])
                at = stop

    return build


def _similar(left: str, right: str, percent: int):
    common = F.size(F.array_intersect(left, right))
    return 100 * common >= percent * (F.size(left) + F.size(right) - common)


def _roots(parent: dict, x):
    while parent[x] != x:
        parent[x] = x = parent[parent[x]]
    return x


def _compare(percent: int):
    """Links between components within one pair of blocks, at most a spanning forest of them."""
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        items = [np.asarray(x, np.int64) for x in rows["items"]]
        comp, side = rows["component"].to_numpy(), rows["outer"].to_numpy()
        size = np.array([len(x) for x in items])
        token, count = np.unique(np.concatenate(items), return_counts=True)
        token = token[count > 1]
        common = np.zeros((len(items), len(items)), np.float32)
        for at in range(0, len(token), 8192):
            part = token[at: at + 8192]
            has = np.zeros((len(items), len(part)), np.float32)
            for i, x in enumerate(items):
                inside = x[np.searchsorted(x, part[0]): np.searchsorted(x, part[-1], "right")]
                place = np.searchsorted(part, inside)
                has[i, place[part[place] == inside]] = 1
            common += has @ has.T
        linked = 100 * common >= percent * (size[:, None] + size[None, :] - common)
        linked &= (comp[:, None] != comp[None, :]) & (side[:, None] | side[None, :])
        parent, found = {c: c for c in comp.tolist()}, []
        for i, j in zip(*np.nonzero(np.triu(linked))):
            a, b = _roots(parent, int(comp[i])), _roots(parent, int(comp[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                found.append((a, b))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return compare


def _between_components(members: DataFrame, sets: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a table: members is (table, node)."""
    def of(df):
        return df.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))

    within = spill_to_table(of(members), "members")
    mixed_tables = within.groupBy("table").agg(F.min("component").alias("home"), F.max("component").alias("last")).where("home < last")
    open_ = within.join(mixed_tables.select("table", "home"), "table").select("home", "node", "component").distinct()
    open_ = open_.withColumn("outer", F.col("component") != F.col("home"))
    # A node of more than 1 - threshold shingles that no other open node has can't be linked.
    nodes = open_.select("node").distinct()
    tokens = sets.join(nodes, "node").select("node", F.size("items").alias("n"), F.explode("items").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("times"), F.min("node").alias("node"), F.min("n").alias("n"))
    alone = shared.where("times = 1").groupBy("node", "n").count().where(F.col("count") * 100 > (100 - percent) * F.col("n"))
    open_ = spill_to_table(open_.join(alone.select("node"), "node", "left_anti"), "open")
    sizes = open_.groupBy("home").agg(
        F.ceil(F.count_if(~F.col("outer")) / BLOCK_NODES).alias("inner_blocks"),
        F.ceil(F.count_if("outer") / BLOCK_NODES).alias("outer_blocks")).where("outer_blocks > 0")
    dealt = open_.join(sizes, "home").withColumn("hash", F.xxhash64("node"))
    inner = dealt.where("NOT outer").withColumn(
        "meets", F.expr("transform(sequence(0L, outer_blocks - 1), o -> struct(o AS x, -1 - pmod(hash, inner_blocks) AS y))"))
    outer = dealt.where("outer").withColumn("own", F.expr("pmod(hash, outer_blocks)")).withColumn("meets", F.expr(
        "transform(sequence(0L, outer_blocks - 1), o -> struct(least(o, own) AS x, greatest(o, own) AS y))")).withColumn(
        "meets", F.expr("concat(meets, transform(IF(inner_blocks > 0, sequence(0L, greatest(inner_blocks, 1L) - 1), CAST(array() AS array<bigint>)), "
        "i -> struct(own AS x, -1 - i AS y)))"))
    columns = ["home", "node", "component", "outer", F.explode("meets").alias("meet")]
    pairs = inner.select(*columns).union(outer.select(*columns)).select("home", "node", "component", "outer", "meet.x", "meet.y")
    held = pairs.join(sets, "node")
    return held.groupBy("home", "x", "y").applyInPandas(_compare(percent), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents whose sets of word shingles have a Jaccard similarity of percent / 100 or more.

    docs: doc_id and text, other columns are ignored. Words are runs of bytes other than space and
    0x09-0x0D, with A-Z lower-cased; a text of fewer words than a shingle is one shingle. A null
    text or one without words has an empty set, n_shingles 0 and is linked with nothing. Rows
    without doc_id are left out. Rows that repeat a doc_id count as one document. An empty table
    gives an empty result. Returns doc_id, n_shingles, component_id (the smallest doc_id reachable)
    and kept (doc_id = component_id).
    """
    halves = half_keys(percent)
    rows = picked(docs).where("doc_id is not null")
    signed = spill_to_table(
        rows.mapInArrow(_signer(words, halves, HALF_ROWS), "doc_id long, n long, digest binary, halves array<long>"), "signed")
    nodes = spill_to_table(
        signed.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("halves").alias("halves")), "nodes")
    half = nodes.select("node", F.posexplode("halves").alias("place", "half"))
    common = half.groupBy("half").agg(F.count("*").alias("times")).where("times > 1").select("half")
    sided = half.join(common, "half").groupBy("node").agg(
        F.collect_list(F.when(F.col("place") < halves, F.col("half"))).alias("first"),
        F.collect_list(F.when(F.col("place") >= halves, F.col("half"))).alias("second"))
    tables = sided.select("node", "second", F.explode("first").alias("one")).select("node", "one", F.explode("second").alias("two"))
    members = spill_to_table(tables.select("node", F.xxhash64("one", "two").alias("table")), "tables")
    heads = members.groupBy("table").agg(F.min("node").alias("head"), F.count("*").alias("times")).where("times > 1").select("table", "head")
    members = spill_to_table(members.join(heads, "table"), "tables")
    pairs = members.where("node <> head").groupBy("node", "head").agg(F.count("*").alias("times"))
    pairs = pairs.withColumn("n", F.expr("row_number() OVER (PARTITION BY node ORDER BY times DESC, head)")).where(F.col("n") <= HEADS)
    pairs = spill_to_table(pairs.select("node", "head"), "pairs")
    named = spill_to_table(members.select("node").distinct(), "named")
    wanted = joined_small(rows, named.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
    sets = spill_to_table(wanted.mapInArrow(_sets(words), "doc_id long, items array<long>").withColumnRenamed("doc_id", "node"), "sets")
    held = pairs.join(sets, "node").join(sets.select(F.col("node").alias("head"), F.col("items").alias("others")), "head")
    links = spill_to_table(held.where(_similar("items", "others", percent)).select(F.col("node").alias("a"), F.col("head").alias("b")), "links")
    comps = components(links)
    more = spill_to_table(_between_components(members.select("table", "node"), sets, comps, percent), "links")
    comps = components(links.union(more))
    owner = nodes.select("digest", "node").join(comps, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    return signed.select("doc_id", "n", "digest").join(owner, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
        (F.col("doc_id") == F.coalesce("component", "doc_id")).alias("kept"))
