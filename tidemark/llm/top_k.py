"""Exact top-k inner products by block-at-a-time pruning.

Vectors are made integers. Within a task they are put in an order that brings similar ones together, and ranges of
that order become blocks: a forward index (the vectors themselves) and, per term (dimension), the largest and the
least value. For a query the sum over terms of the largest product that the block allows bounds every score in it.
A query takes its blocks by falling bound, scores a block through its forward index, and ends where the next bound is
below its kth score.

Queries and blocks are laid out as a grid of tiles of bounded size; a task holds one tile, and the best k of each tile
are merged by window. Only blocks are replicated over the grid, never pairs of rows.

Defined results: vectors that are null, or hold a null, NaN or infinite component, and rows with a null identifier
take no part. A shorter vector counts as zero beyond its end. A query's own identifier is never its candidate, also
where several rows have it; each row of a repeated query is one query, numbered apart inside and equal in the result.
Components are 64-bit integers, held within 2 ** 56 either way, as their products would not fit in a long anyway; all
scores are ordered exactly, and one beyond 64 bits is returned as the nearest bound. An empty table gives an empty
result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Vectors of a block.
BLOCK_ROWS = 256
#: Vectors that a task orders together before it cuts blocks.
ORDER_ROWS = 16_384
#: Blocks of candidates and of queries in a tile, at most.
TILE_BLOCKS = 256
TILE_QUERY_BLOCKS = 16

_BLOCK = "tile long, ids binary, vectors binary"
#: Bound of a component, and bits of a score's lower part.
_MOST = 1 << 56
_LOW = 62
_HIT = "query_id long, query_row long, vec_id long, high long, low long"


def integer_vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and floor(scale * x) of every component, for the rows that take part."""
    x = F.col("x")
    ok = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    held = F.transform(x, lambda v: F.floor(F.least(F.greatest(v * float(scale), F.lit(-float(_MOST))), F.lit(float(_MOST)))).cast("long"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    return rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & ok).select("vec_id", held.alias("x"))


def _similar_order(x: np.ndarray) -> np.ndarray:
    """An order of the rows in which similar ones follow each other: by nearest of evenly spaced rows, then by closeness."""
    pivots = x[:: max(1, len(x) // 64)].astype(np.float64)
    pivots /= np.maximum(np.linalg.norm(pivots, axis=1, keepdims=True), 1)
    near = x.astype(np.float64) @ pivots.T
    best = near.argmax(axis=1)
    return np.lexsort([near[np.arange(len(x)), best], best])


def _blocks(rows: DataFrame, dim: int, tiles: int, ordered: bool) -> DataFrame:
    """Rows as blocks, each with a tile number in [0, tiles)."""

    def cut(ids: np.ndarray, x: np.ndarray, start: int):
        if ordered:
            order = _similar_order(x)
            ids, x = ids[order], x[order]
        names, tile = {"tile": [], "ids": [], "vectors": []}, start
        for k in range(0, len(ids), BLOCK_ROWS):
            for name, value in (("tile", tile % tiles), ("ids", ids[k : k + BLOCK_ROWS].tobytes()), ("vectors", x[k : k + BLOCK_ROWS].tobytes())):
                names[name].append(value)
            tile += 1
        return pa.RecordBatch.from_pydict(names, pa.schema([("tile", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())])), tile

    def run(batches):
        ids, xs, tile = [], [], TaskContext.get().partitionId() * 7919
        for batch in batches:
            lists = batch["x"]
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            x = np.zeros((batch.num_rows, dim), np.int64)
            x[np.arange(dim) < sizes[:, None]] = flat
            ids.append(batch["vec_id"].to_numpy())
            xs.append(x)
            if sum(map(len, ids)) >= ORDER_ROWS:
                found, tile = cut(np.concatenate(ids), np.concatenate(xs), tile)
                yield found
                ids, xs = [], []
        if ids:
            yield cut(np.concatenate(ids), np.concatenate(xs), tile)[0]

    return rows.mapInArrow(run, _BLOCK)


def _product(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products as integers: through floating point where that is exact, and of any length where 64 bits don't hold them."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2**52:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return q @ x.T
    return q.astype(object) @ x.astype(object).T


def _halves(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores as two numbers of 64 bits that order them."""
    return (scores >> _LOW).astype(np.int64), (scores & ((1 << _LOW) - 1)).astype(np.int64)


class BlockIndex:
    """Blocks of one tile: forward indexes, and least and largest value per term."""

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray]]):
        self.blocks = blocks
        self.high = np.array([x.max(axis=0) for _, x in blocks]).astype(np.float64)
        self.low = np.array([x.min(axis=0) for _, x in blocks]).astype(np.float64)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """For each query and block, a number that no score in the block is above."""
        q = q.astype(np.float64)
        found = np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T
        # what rounding can take from sums beyond exact floating point
        return found + np.abs(q) @ np.maximum(np.abs(self.high), np.abs(self.low)).T * ((q.shape[1] + 4) * 2.0**-52)

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """Best (scores, ids) of each query, ties to the smaller id; and how many blocks were scored, over all queries."""
        bounds = self.bounds(q)
        order = np.argsort(-bounds, axis=1, kind="stable")
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(q)
        kth = np.full(len(q), -np.inf)
        live, scored = np.arange(len(q)), 0
        for step in range(len(self.blocks)):
            at = order[live, step]
            go = bounds[live, at] >= kth[live]  # an equal score can win by its identifier
            live, at = live[go], at[go]
            if not len(live):
                break
            scored += len(live)
            for b in np.unique(at):
                rows = live[at == b]
                ids, x = self.blocks[b]
                scores = _product(q[rows], x)
                for r, s in zip(rows.tolist(), scores, strict=True):
                    pick = (s >= kth[r]).astype(bool) & (ids != query_ids[r])
                    s, i = np.concatenate([best[r][0], s[pick]]) if len(best[r][0]) else s[pick], np.concatenate([best[r][1], ids[pick]])
                    top = np.lexsort([i, *(~part for part in _halves(s)[::-1])])[:k]  # falling scores, then rising identifiers
                    best[r] = s[top], i[top]
                    if len(top) == k:
                        kth[r] = math.nextafter(float(s[top[-1]]), -math.inf)  # not above the exact score
        return best, scored


def top_k(vectors: DataFrame, k: int, scale: int, query: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row where `query` (a condition on vec_id) holds, the k best other rows: query_id, rank, vec_id, score."""
    rows = written(integer_vectors(vectors, scale, id_col, vector_col), "vectors")
    count, queries, dim = rows.agg(F.count("*"), F.count_if(query), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    dim = max(dim, 1)
    tiles = max(1, -(-count // (BLOCK_ROWS * TILE_BLOCKS)), min(8, count // (4 * BLOCK_ROWS)))
    query_tiles = max(1, -(-queries // (BLOCK_ROWS * TILE_QUERY_BLOCKS)))
    each = lambda n, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)
    asked = _blocks(rows.filter(query), dim, query_tiles, False).select(F.col("tile").alias("q_tile"), each(tiles, "d_tile"), "ids", "vectors")
    given = _blocks(rows, dim, tiles, True).select(each(query_tiles, "q_tile"), F.col("tile").alias("d_tile"), "ids", "vectors")

    def unpack(table: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(np.frombuffer(i, np.int64), np.frombuffer(x, np.int64).reshape(-1, dim)) for i, x in zip(table["ids"], table["vectors"], strict=True)]

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out, index = [], BlockIndex(unpack(right)) if len(right) else None
        for ids, q in unpack(left) if index else []:
            same = pd.Series(ids).groupby(ids).cumcount().to_numpy()
            found, _ = index.search(ids, q, k)
            mark = pd.util.hash_array(np.array([x.tobytes() for x in q], object)).astype(np.int64) if (same > 0).any() else np.zeros(len(q), np.int64)
            for i, n, m, (s, v) in zip(ids.tolist(), same.tolist(), mark.tolist(), found, strict=True):
                high, low = _halves(s)
                out.append(pd.DataFrame({"query_id": i, "query_row": m + n, "vec_id": v, "high": high, "low": low}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "query_row": [], "vec_id": [], "high": [], "low": []}, dtype=np.int64)

    hits = asked.groupBy("q_tile", "d_tile").cogroup(given.groupBy("q_tile", "d_tile")).applyInPandas(search, _HIT)
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("high"), F.desc("low"), "vec_id")
    score = F.when(F.col("high") > 1, F.lit(2**63 - 1)).when(F.col("high") < -2, F.lit(-(2**63))).otherwise(F.shiftleft("high", _LOW) + F.col("low"))
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", score.alias("score"))
