"""Exact top-k by inner product: a KD-tree per shard, searched best-first with bounds of tight boxes.

Shards hold a bounded number of vectors. Each builds a tree by median splits along the widest
side; its leaves keep tight bounding boxes. Queries come in blocks: a query's bound for a box is
the largest inner product any point in the box can have, leaves are visited from the best bound
down, and a query stops at the first leaf whose bound is below its kth score so far. That score
starts from what the query reaches in one small pilot shard, so the other shards prune from the
first leaf on. Scores are exact integers; ties go to the smaller vec_id.

Blocks meet shards in a shuffle by home, a few shards that one task holds while blocks stream past
them; neither trees nor queries ever reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.session import spill_to_table

from .support import short_batches

#: Vectors per shard, vectors per leaf, queries per block.
SHARD_ROWS, LEAF_ROWS, BLOCK_ROWS = 8_192, 64, 512
#: Homes from which on a home takes several shards, and how many it takes at most; a block is sent once to each home.
HOMES, HOME_SHARDS = 256, 16
#: Blocks that one copy of a pilot shard serves.
PILOT_BLOCKS = 8
#: Sizes up to which sums of products are exact in doubles.
_EXACT = 2.0**53
_LEAST = -(2**63)


def quantized(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and v: floor(scale * component) of every vector that takes part."""
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))

    values = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), values.alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(F.forall("v", finite))
    return rows.select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold each of them, behind that number of bytes."""
    least, most = int(values.min(initial=0)), int(values.max(initial=0))
    size = next(s for s in (1, 2, 4, 8) if max(most, -1 - least) < 1 << (8 * s - 1))
    return bytes([size]) + values.astype(f"<i{size}").tobytes()


def unpacked(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell, f"<i{cell[0]}", offset=1).astype(np.int64)


def build_tree(ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> dict[str, np.ndarray]:
    """Points in leaf order, leaf bounds, tight boxes and the smallest id of each leaf."""
    order, at, todo = [], [0], [np.argsort(ids, kind="stable")]
    while todo:
        members = todo.pop()
        if len(members) > leaf_rows:
            side = np.ptp(points[members], axis=0)
            if len(side) and side.max() > 0:
                widest = points[members, side.argmax()]
                members = members[np.argsort(widest, kind="stable")]
            middle = len(members) // 2
            todo += [members[middle:], members[:middle]]
        else:
            order.append(members)
            at.append(at[-1] + len(members))
    order = np.concatenate(order)
    starts = np.array(at[:-1])
    points, ids = points[order], ids[order]
    return {
        "ids": ids, "points": points, "at": np.array(at), "least_id": np.minimum.reduceat(ids, starts),
        "low": np.minimum.reduceat(points, starts), "high": np.maximum.reduceat(points, starts),
    }


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(scores) > 4 * k:
        kept = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[kept], ids[kept]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def search(tree: dict[str, np.ndarray], queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, k: int,
           leaves: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Scores and ids of the best k of the tree for each query, without rows of the query's own id.

    floors: a score that k rows elsewhere reach (or the least integer); what lies below it may be left out.
    leaves: look at no more leaves than that (for a first floor).
    """
    points, at, ids = tree["points"], tree["at"], tree["ids"]
    size = max((float(np.abs(x).max(initial=0)) for x in (points, queries)), default=0.0)
    # Doubles where they are exact (they use BLAS), else 64-bit integers.
    kind = np.float64 if size * size * max(1, points.shape[1]) < _EXACT else np.int64
    points, queries = points.astype(kind), queries.astype(kind)
    low, high, least = tree["low"].astype(kind), tree["high"].astype(kind), tree["least_id"]
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    for q, own, floor, bound in zip(queries, query_ids.tolist(), floors.tolist(), bounds):
        order = np.lexsort((least, -bound))[:leaves]
        best_score, best_id = np.zeros(0, kind), np.zeros(0, np.int64)
        done, step = 0, 1
        while done < len(order):
            part = order[done: done + step]
            done, step = done + step, min(2 * step, 32)
            full = len(best_score) == k
            kth = max(floor, best_score[-1]) if full else floor
            open_ = bound[part] >= kth
            if not open_.any():
                break
            if full and best_score[-1] == kth:
                open_ &= (bound[part] > kth) | (least[part] < best_id[-1])
            if open_.any():
                part = part[open_]
                rows = np.concatenate([np.arange(at[i], at[i + 1]) for i in part])
                rows = rows[ids[rows] != own]
                best_score, best_id = _best(
                    np.concatenate((best_score, points[rows] @ q)), np.concatenate((best_id, ids[rows])), k)
        yield best_score.astype(np.int64), best_id


def exact_top_k(vectors: DataFrame, is_query, k: int = 5, scale: int = 256, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The k best other vectors of every query by integer inner product.

    vectors: vec_id and embedding (array of numbers); other columns are ignored. Null ids or vectors
    and vectors with a null, NaN or infinite component take no part. Vectors of another length than
    the query's are no candidates. Repeated rows are candidates each; a query id that is repeated
    asks once, with its smallest vector; no row of the query's own id is a candidate. With fewer than
    k candidates all are returned; a query without any has no row. Sums must fit 64 bits.
    is_query: a condition on vec_id. Returns query_id, rank (from 1), vec_id, score.
    """
    short_batches(vectors.sparkSession)
    rows = spill_to_table(quantized(vectors, scale).withColumn("dim", F.size("v")), "quantized")
    shards = max(1, math.ceil(rows.count() / shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)))

    def plant(group: pd.DataFrame) -> pd.DataFrame:
        tree = build_tree(group["vec_id"].to_numpy(np.int64), np.stack(group["v"].to_numpy()).astype(np.int64))
        return pd.DataFrame({
            "dim": [group["dim"].iloc[0]], "shard": [group["shard"].iloc[0]],
            **{name: [packed(array)] for name, array in tree.items()},
        })

    parts = ["ids", "points", "at", "least_id", "low", "high"]
    trees = spill_to_table(
        dealt.groupBy("dim", "shard").applyInPandas(plant, "dim int, shard long, " + ", ".join(f"{p} binary" for p in parts)), "trees")
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("q")).select("vec_id", "q.*")
    blocks = max(1, math.ceil(asked.count() / BLOCK_ROWS))

    def block(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "dim": [group["dim"].iloc[0]], "block": [group["block"].iloc[0]], "query_ids": [packed(group["vec_id"].to_numpy(np.int64))],
            "queries": [packed(np.stack(group["v"].to_numpy()).astype(np.int64))],
            "floors": [packed(np.full(len(group), _LEAST))],
        })

    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    block_schema = "dim int, block long, query_ids binary, queries binary, floors binary"
    queries = spill_to_table(asked.groupBy("dim", "block").applyInPandas(block, block_schema), "queries")

    def planted(row) -> dict[str, np.ndarray]:
        tree = {p: unpacked(getattr(row, p)) for p in parts}
        for p in ("points", "low", "high"):
            tree[p] = tree[p].reshape(-1, row.dim) if row.dim else np.zeros((len(tree["ids" if p == "points" else "least_id"]), 0), np.int64)
        return tree

    def visit(frames: Iterator[pd.DataFrame], leaves: int | None) -> Iterator[pd.DataFrame]:
        """Of each home its trees come first; they stay in their packed form."""
        home, held = None, []
        for frame in frames:
            for row in frame.itertuples(index=False):
                if home != (row.dim, row.home):
                    home, held = (row.dim, row.home), []
                if row.block < 0:
                    held.append(row)
                    continue
                ids, floors = unpacked(row.query_ids), unpacked(row.floors)
                asked_for = unpacked(row.queries).reshape(len(ids), row.dim)
                for tree in held:
                    found = list(search(planted(tree), asked_for, ids, floors, k, leaves))
                    # k rows of this tree reach its kth score, so the next trees needn't look below it.
                    floors = np.maximum(floors, [s[-1] if len(s) == k else _LEAST for s, _ in found])
                    if leaves is None:
                        yield pd.DataFrame({
                            "query_id": np.repeat(ids, [len(s) for s, _ in found]), "vec_id": np.concatenate([i for _, i in found]),
                            "score": np.concatenate([s for s, _ in found]),
                        })
                if leaves is not None:
                    yield pd.DataFrame({"dim": [row.dim], "block": [row.block], "query_ids": [row.query_ids], "queries": [row.queries],
                                        "floors": [packed(floors)]})

    def met(homed: DataFrame, sent: DataFrame, homes: int, leaves: int | None, schema: str) -> DataFrame:
        """What blocks find in the trees of the homes they are sent to."""
        rows = homed.withColumn("block", F.lit(-1).cast("long")).unionByName(sent, allowMissingColumns=True)
        return rows.repartition(homes, "dim", "home").sortWithinPartitions("dim", "home", "block").mapInPandas(lambda it: visit(it, leaves), schema)

    def numbers(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    # First floors: a few leaves of the first shard of each dimension, of which there is a copy for every few blocks.
    copies = math.ceil(blocks / PILOT_BLOCKS)
    first = trees.groupBy("dim").agg(F.min("shard").alias("shard"))
    pilot = trees.join(first.hint("shuffle_merge"), ["dim", "shard"]).drop("shard").withColumn("home", numbers(copies))
    sent = queries.withColumn("home", F.pmod("block", F.lit(copies)))
    floored = spill_to_table(met(pilot, sent, copies, 4, block_schema), "floors")
    # Every block of queries meets every shard.
    share = min(HOME_SHARDS, math.ceil(shards / HOMES))
    homes = math.ceil(shards / share)
    homed = trees.withColumn("home", F.floor(F.col("shard") / share).cast("long")).drop("shard")
    found = met(homed, floored.withColumn("home", numbers(homes)), homes, None, "query_id long, vec_id long, score long")
    found = found.withColumn("rank", F.expr("row_number() over (partition by query_id order by score desc, vec_id)"))
    return found.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
