"""Exact top-k search by no-random-access aggregation over sorted component lists.

The candidates are dealt by a hash of their id to parts of at most ``PART_ROWS`` rows, and every query visits every
part. A task cuts its part into blocks and keeps for each block one sorted list a component. A query reads
the lists from the end where its own component gains most, all to the same depth, which doubles; it never fetches a
candidate's other components on the way. What was read gives every candidate a lower bound (what is unread counts
as the worst end of its list) and an upper bound (as the value last read there). Reading stops once all but a few
candidates, those never met included, have an upper bound below the k-th best lower bound; the scores of those
left are then resolved. The best of earlier blocks raise the bound for later ones. The parts' best are merged by rank.

The search compares every query with every part by nature; memory is one part and one batch of queries a task.

Defined results: rows with a null id or a vector that is null or holds a null or non-finite component take no part;
rows of one id count as one, that with the least vector; shorter vectors count as ended by zeros; scores are exact,
but for those beyond a long, which count as its end; equal scores go to the smaller id; a query
with fewer candidates than k gets all; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covisit_spark.llm.common import small_batches, stage

SCALE = 1024
K = 10
EVERY = 100
PART_ROWS = 65536
BLOCK_ROWS = 4096
FIRST_DEPTH = 64
# Candidates left undecided that are resolved rather than read on for.
FEW = 64
# Integers below this are exact in doubles.
EXACT = float(2**53)
LONG = np.iinfo(np.int64)


class Block:
    """Some candidates and, for each component, the list of them in descending order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(-vectors, axis=0, kind="stable").T.astype(np.int32)
        self.values = np.take_along_axis(vectors.T, self.order, axis=1)
        self.largest = np.abs(vectors.astype(np.float64)).max(initial=0)

    def scores(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.vectors[rows] @ query


def search(block: Block, query: np.ndarray, query_id: int, best: list[tuple], k: int) -> list[tuple]:
    """``best``, as (-score, id) in order, with the candidates of ``block`` that are among the k best."""
    n, width = block.vectors.shape
    if not n:
        return best
    q = query.astype(np.float64)
    if block.largest * np.abs(q).max(initial=0) * max(width, 1) >= EXACT:
        # beyond doubles: the bounds would not be exact
        exact = block.vectors.astype(object) @ query.astype(object)
        found = [(-min(max(int(s), LONG.min), LONG.max), int(i)) for s, i in zip(exact, block.ids, strict=True) if i != query_id]
        return sorted(best + found)[:k]
    down = q >= 0
    # a list is read from its end of the largest products
    order = np.where(down[:, None], block.order, block.order[:, ::-1])
    gain = np.where(down[:, None], block.values, block.values[:, ::-1]) * q[:, None]
    worst = gain[:, -1]
    low = np.full(n, worst.sum())
    known = np.zeros(n)
    floor = -best[k - 1][0] if len(best) >= k else -np.inf
    own = block.ids == query_id
    depth, before = min(FIRST_DEPTH, n), 0
    while True:
        ids, got = order[:, before:depth].ravel(), gain[:, before:depth]
        known += np.bincount(ids, got.ravel(), n)
        low += np.bincount(ids, (got - worst[:, None]).ravel(), n)
        low[own] = -np.inf
        if depth == n:
            left = np.flatnonzero((known >= floor) & ~own)
            break
        last = gain[:, depth - 1]
        # what a candidate has been met with in a list replaces the list's last value; met nowhere, all of them stand
        met = np.bincount(order[:, :depth].ravel(), np.repeat(last, depth), n)
        high = known + (last.sum() - met)
        bound = floor
        if n > k:
            bound = max(bound, np.partition(low, n - k)[n - k])
        left = np.flatnonzero((high >= bound) & ~own)
        if len(left) <= FEW:
            break
        before, depth = depth, min(2 * depth, n)
    found = [(-int(s), int(i)) for s, i in zip(block.scores(query, left), block.ids[left], strict=True)]
    return sorted(best + found)[:k]


def _padded(column, width: int) -> np.ndarray:
    rows = column.to_pylist()
    out = np.zeros((len(rows), max([width, *(len(r) for r in rows)])), np.int64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return out


def _to_width(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, max(0, width - a.shape[1]))))


class Part:
    """The candidates of one part, read before its queries."""

    def __init__(self):
        self.ids, self.vectors, self.blocks = [], [], None

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids.append(ids)
        self.vectors.append(vectors)

    def ready(self, width: int) -> int:
        """Build the lists, of ``width`` components at least; their width."""
        if self.blocks is None or self.width < width:
            width = max([width, *(v.shape[1] for v in self.vectors)])
            ids = np.concatenate(self.ids) if self.ids else np.zeros(0, np.int64)
            all_ = np.concatenate([_to_width(v, width) for v in self.vectors]) if self.vectors else np.zeros((0, width), np.int64)
            self.blocks = [Block(ids[i : i + BLOCK_ROWS], all_[i : i + BLOCK_ROWS]) for i in range(0, len(ids), BLOCK_ROWS)]
            self.width = width
        return self.width


def _answer(k: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        part, now = Part(), None
        for b in batches:
            parts, kinds, ids = (b.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            vectors = _padded(b.column(3), 0)
            out = []
            cuts = np.flatnonzero((parts[1:] != parts[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for rows in np.split(np.arange(len(parts)), cuts):
                if not len(rows):
                    continue
                if parts[rows[0]] != now:
                    part, now = Part(), parts[rows[0]]
                if kinds[rows[0]] == 0:
                    part.add(ids[rows], vectors[rows])
                    continue
                width = part.ready(vectors.shape[1])
                asked = _to_width(vectors[rows], width)
                for query, i in zip(asked, ids[rows], strict=True):
                    best: list[tuple] = []
                    for block in part.blocks:
                        best = search(block, query, i, best, k)
                    out += [(int(i), v, -s) for s, v in best]
            cols = list(zip(*out, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    return run


def integer_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): one row an id, its vector in whole steps of 1 / ``scale``."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    usable = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
    v = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def top_k(table: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all others for each row whose id is divisible by ``every``."""
    spark = table.sparkSession
    small_batches(spark)
    vectors = stage(integer_vectors(table, scale), "vectors")
    n = vectors.count()
    parts = max(spark.sparkContext.defaultParallelism, -(-n // PART_ROWS))
    mine = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    candidates = vectors.select(mine.alias("part"), F.lit(0).alias("kind"), "vec_id", "v")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    queries = vectors.where(F.col("vec_id") % every == 0).select(everywhere, F.lit(1).alias("kind"), "vec_id", "v")
    met = candidates.unionByName(queries).repartitionByRange(parts, "part").sortWithinPartitions("part", "kind")
    found = stage(met.mapInArrow(_answer(k), "query_id long, vec_id long, score long"), "found")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
