"""Nearest neighbours by inner product: a block matrix join over int8 tiles with error bounds."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from lorebase.llm.common import stored, tasks_for

# Vectors in a tile, at most.
TILE = 1024
# Queries that a task holds at a time.
QUERIES = 64 * TILE

TILE_FIELDS = "tile string, dims int, ids binary, vectors binary, small binary, scales binary, norms binary, errors binary"


def _tiles(vectors: DataFrame, name: str) -> DataFrame:
    """Pack (id, vector) into tiles: the vectors, and 8-bit copies with scale, length and length of the error.

    Vectors that are null, zero or hold a null or non-finite component are left out.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, list[float]]]] = {}
        part, made = TaskContext.get().partitionId(), 0

        def tile(dims: int) -> pa.RecordBatch:
            nonlocal made
            rows = waiting.pop(dims)
            exact = np.array([r[1] for r in rows], np.float64).reshape(-1, dims)
            scales = np.abs(exact).max(axis=1) / 127
            small = np.rint(exact / scales[:, None]).astype(np.int8)
            errors = np.linalg.norm(exact - small * scales[:, None], axis=1)
            single = exact.astype(np.float32)
            kept = single if (single == exact).all() else exact
            made += 1
            row = {
                "tile": f"{part}-{made}",
                "dims": dims,
                "ids": np.array([r[0] for r in rows], np.int64).tobytes(),
                "vectors": kept.tobytes(),
                "small": small.tobytes(),
                "scales": scales.tobytes(),
                "norms": np.linalg.norm(exact, axis=1).tobytes(),
                "errors": errors.tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        types = {"tile": pa.string(), "dims": pa.int32()}
        schema = pa.schema([(f.split()[0], types.get(f.split()[0], pa.binary())) for f in TILE_FIELDS.split(", ")])
        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = waiting.setdefault(len(vector), [])
                rows.append((vec_id, vector))
                if len(rows) == TILE:
                    yield tile(len(vector))
        for dims in list(waiting):
            yield tile(dims)

    return stored(vectors.select("id", "vector").mapInArrow(pack, TILE_FIELDS), name)


def _usable(vector: Column) -> Column:
    """Not null, all components finite numbers, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class _Tile(NamedTuple):
    """A tile as arrays."""

    ids: np.ndarray
    vectors: np.ndarray
    small: np.ndarray
    scales: np.ndarray
    norms: np.ndarray
    errors: np.ndarray


def _open(row: dict) -> _Tile:
    ids = np.frombuffer(row["ids"], np.int64)
    n, dims = len(ids), row["dims"]
    wide = len(row["vectors"]) == 8 * n * dims
    vectors = np.frombuffer(row["vectors"], np.float64 if wide else np.float32).reshape(n, dims)
    small = np.frombuffer(row["small"], np.int8).reshape(n, dims).astype(np.float32)
    return _Tile(ids, vectors, small, *(np.frombuffer(row[k]) for k in ("scales", "norms", "errors")))


def _regroup(tiles: list[_Tile]) -> Iterator[_Tile]:
    """The same vectors in full tiles."""
    whole = [np.concatenate(parts) for parts in zip(*tiles)]
    for at in range(0, len(whole[0]), TILE):
        yield _Tile(*(part[at : at + TILE] for part in whole))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, added from the first component to the last, so that equal
    vectors have equal products wherever they stand."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d].astype(np.float64) * b[:, d]
    return total


class _Best:
    """The k best candidates of each query of a tile so far, as heaps of (score, -id)."""

    def __init__(self, queries: _Tile, k: int):
        self.queries, self.k = queries, k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
        self.floor = np.full(len(queries.ids), -np.inf)

    def add(self, tile: _Tile) -> None:
        """Products of 8-bit numbers bound the true ones; only pairs that may be among the k best are computed.

        |x.y - x'.y'| <= |x| e(y) + |y'| e(x), where x' and y' are the 8-bit copies, e(x) and e(y) the lengths of what
        they miss, and |y'| <= |y| + e(y). Sums of up to 2 ** 24 / 127 ** 2 = 1040 such products are exact in single precision;
        longer vectors get the rounding as a margin.
        """
        q, k = self.queries, self.k
        dims = tile.small.shape[1]
        about = (q.small @ tile.small.T).astype(np.float64)
        margin = 1e-9 + (0 if dims <= 1040 else dims * 127**2 * dims * 6e-8)
        about *= q.scales[:, None] * tile.scales
        miss = (q.norms[:, None] * tile.errors + q.errors[:, None] * (tile.norms + tile.errors)) * (1 + 1e-9)
        miss += margin * (q.scales[:, None] * tile.scales if dims > 1040 else q.norms[:, None] * tile.norms)
        own = q.ids[:, None] == tile.ids
        floor = self.floor
        if np.isinf(floor).any() and len(tile.ids) > k:
            low = np.where(own, -np.inf, about - miss)
            floor = np.maximum(floor, np.partition(low, len(tile.ids) - k, axis=1)[:, -k])
        rows, columns = np.nonzero((about + miss >= floor[:, None]) & ~own)
        step = 1 << 20
        for at in range(0, len(rows), step):
            r, c = rows[at : at + step], columns[at : at + step]
            scores = _products(q.vectors[r], tile.vectors[c])
            for row, score, candidate in zip(r.tolist(), scores.tolist(), tile.ids[c].tolist()):
                heap = self.heaps[row]
                item = (score, -candidate)
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
        for row, heap in enumerate(self.heaps):
            if len(heap) == k:
                self.floor[row] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, list[float], list[int]]]:
        for query, heap in zip(self.queries.ids.tolist(), self.heaps):
            if heap:
                best = sorted(heap, reverse=True)
                yield query, [s for s, _ in best], [-i for _, i in best]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_name: str = "vec_id", name: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k other vectors with the largest inner product.

    Queries are the rows of `vectors` (id, vector, ...) that `is_query` holds for; candidates are all rows but
    the query's own id. Scores are in double precision; ties go to the smaller id. The result is exact.

    Method: vectors are packed into tiles of up to 1024. Queries are put in groups of about 65,536, which is what a
    task holds at a time; each group is copied to a number of shares that follows the number of tasks, and each
    candidate tile goes to one share of each group, so every pair of tiles meets in one task. There the product of the
    8-bit tiles and its error bound rule out nearly all pairs; the others are computed from the original vectors and
    kept in one heap of k per query. The heaps of all shares are merged per query.

    Null vectors, zero vectors and those with null or non-finite components take no part, nor do rows with a null id.
    Vectors of different length are not compared. With fewer than k candidates all are returned. Repeated rows count as
    candidates each, and once as queries. No rows: no rows. Other columns are ignored.
    """
    given = vectors.select(vectors[id_name].cast("long").alias("id"), vectors[name].alias("vector"), is_query.alias("asks"))
    given = given.filter(F.col("id").isNotNull() & _usable(F.col("vector")))
    candidates = _tiles(given, "tiles")
    queries = _tiles(given.filter("asks").dropDuplicates(["id", "vector"]), "query-tiles")
    asking = queries.agg(F.coalesce(F.sum(F.length("ids") / 8), F.lit(0))).first()[0]
    groups = max(1, -(-int(asking) // QUERIES))
    shares = max(1, -(-tasks_for(vectors.sparkSession) // groups))

    def spread(n: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("tile", F.lit(seed)), F.lit(n)).cast("int")

    asked = queries.select(
        F.lit(True).alias("asks"), spread(groups, 1).alias("group"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
        *[F.col(c) for c in queries.columns],
    )
    offered = candidates.select(
        F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), spread(shares, 2).alias("share"),
        *[F.col(c) for c in candidates.columns],
    )
    cells = asked.union(offered).withColumn("cell", F.col("group") * shares + F.col("share"))
    dealt = cells.repartitionById(groups * shares, F.col("cell")).sortWithinPartitions("cell", F.desc("asks"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[_Tile]] = {}
        held: list[tuple[int, _Best]] = []
        cell = None

        def found() -> pa.RecordBatch:
            rows = [r for _, best in held for r in best.rows()]
            held.clear(), waiting.clear()
            ids, scores, near = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(scores, pa.list_(pa.float64())), pa.array(near, pa.list_(pa.int64()))],
                names=["query_id", "scores", "ids"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if row["cell"] != cell:
                    yield found()
                    cell = row["cell"]
                if row["asks"]:
                    waiting.setdefault(row["dims"], []).append(_open(row))
                    continue
                for dims, tiles in waiting.items():
                    held += [(dims, _Best(t, k)) for t in _regroup(tiles)]
                waiting.clear()
                tile = _open(row)
                for dims, best in held:
                    if dims == row["dims"]:
                        best.add(tile)
        yield found()

    lists = dealt.mapInArrow(search, "query_id long, scores array<double>, ids array<long>")
    best = F.struct((-F.col("score")).alias("down"), F.col("vec_id"))
    pairs = lists.select("query_id", F.explode(F.arrays_zip("scores", "ids")).alias("p"))
    pairs = pairs.select("query_id", F.col("p.scores").alias("score"), F.col("p.ids").alias("vec_id"))
    merged = pairs.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(best)), 1, k).alias("best"))
    ranked = merged.select("query_id", F.posexplode("best").alias("at", "b"))
    return ranked.select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.down")).alias("score")
    )
