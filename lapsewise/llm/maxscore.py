"""Exact top-k search by inner product with MaxScore over sharded postings.

A vector is a bag of terms: its dimensions. So that every contribution counts upwards, a query reads
a dimension from its lower end if it weighs it positively (impact: value - least value) and from its
upper end otherwise (impact: greatest value - value); the difference is one constant per query.
Zero impacts have no posting.

In a shard a query's terms are ordered by their score bound (weight x greatest impact). Terms are
essential until the bounds of the rest sum to less than the k-th best score so far: whoever misses
all essential terms cannot enter. Essential postings are traversed; the others are probed, one after
another, only for vectors that are still competitive. Shards are merged at the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.llm.common import arrow_schema

#: Terms traversed between two looks at the threshold.
STEP = 8


class Postings:
    """The postings of a shard of integer vectors (one row each)."""

    def __init__(self, vectors: np.ndarray):
        self.n, self.terms = vectors.shape
        columns = np.ascontiguousarray(vectors.T)
        self.low, self.high = (columns.min(axis=1), columns.max(axis=1)) if self.n else (np.zeros(self.terms, np.int64),) * 2
        self.columns = columns
        self.lists: dict[tuple[int, bool], tuple[np.ndarray | None, np.ndarray]] = {}

    def impacts(self, term: int, upwards: bool) -> tuple[np.ndarray | None, np.ndarray]:
        """(places, impacts); places None: a dense list that names every vector."""
        if (term, upwards) not in self.lists:
            column = self.columns[term]
            impact = (column - self.low[term] if upwards else self.high[term] - column).astype(np.float64)
            places = np.flatnonzero(impact)
            self.lists[term, upwards] = (None, impact) if 4 * len(places) > self.n else (places, impact[places])
        return self.lists[term, upwards]

    def _probed(self, term: int, upwards: bool, places: np.ndarray) -> np.ndarray:
        column = self.columns[term][places]
        return column - self.low[term] if upwards else self.high[term] - column

    def top(self, query: np.ndarray, k: int, names: np.ndarray, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the k best vectors, ties to the smaller name; ``own`` takes no part."""
        weight = np.abs(query).astype(np.float64)
        constant = int(np.where(query > 0, query * self.low, query * self.high).sum())
        bound = weight * (self.high - self.low)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        rest = np.r_[np.cumsum(bound[order][::-1])[::-1], 0.0]
        score = np.zeros(self.n)
        if own is not None:
            score[own] = -np.inf
        want = min(k, self.n - (own is not None))
        if want <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        done, threshold, look, scratch = 0, 0.0, rest[0] * 0.6, np.empty(self.n)
        alive = None
        while done < len(order):
            essential = rest[done] >= threshold
            for term in order[done : done + STEP]:
                places, impact = self.impacts(term, query[term] > 0)
                if alive is not None:  # probe the survivors
                    partial += weight[term] * (impact[alive] if places is None else self._probed(term, query[term] > 0, alive))
                elif places is None:
                    np.multiply(impact, weight[term], out=scratch)
                    score += scratch
                else:
                    score[places] += weight[term] * impact
            done = min(done + STEP, len(order))
            if alive is not None:
                threshold = max(threshold, np.partition(partial, len(partial) - want)[len(partial) - want])
                keep = partial + rest[done] >= threshold
                alive, partial = alive[keep], partial[keep]
            elif rest[done] < look or not essential:
                # looked at again only once the rest has shrunk: the k-th best rises slowly
                threshold, look = np.partition(score, self.n - want)[self.n - want], rest[done] * 0.6
                if rest[done] < threshold:
                    competitive = np.flatnonzero(score + rest[done] >= threshold)
                    if 4 * len(competitive) < self.n or done == len(order):
                        alive, partial = competitive, score[competitive]
        if alive is None:
            alive = np.flatnonzero(score >= (np.partition(score, self.n - want)[self.n - want]))
            partial = score[alive]
        alive, partial = alive[partial > -np.inf], partial[partial > -np.inf]
        best = np.lexsort((names[alive], -partial))[:want]
        return alive[best], partial[best].astype(np.int64) + constant


def integer_vectors(table: DataFrame, scale: int = 64) -> DataFrame:
    """(row, vec_id, terms): floor(scale * x) of every component, x as double. Vectors that are null,
    or hold a null or a component that is not finite, take no part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.filter(F.col("embedding").isNotNull() & finite).select(
        "row", "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("terms")
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as a matrix; shorter rows lack their last terms, which are zero."""
    array = column.combine_chunks()
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    sizes = array.value_lengths().to_numpy()
    matrix = np.zeros((len(sizes), width), np.int64)
    matrix[np.arange(width) < sizes[:, None]] = array.flatten().to_numpy()
    return matrix


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = 16_384, block_rows: int = 512) -> DataFrame:
    """(query_row, query_id, rank, vec_id, score): the ``k`` best rows of ``vectors`` for each of ``queries``.

    Both are (row, vec_id, terms); a query's own row takes no part. Vectors are dealt into shards and
    queries into blocks; every block meets every shard, by an equi-join on (shard, block), in a task of
    bounded size. Ties go to the smaller vec_id (null last), then the earlier row.
    """
    n_vectors, n_queries = vectors.count(), queries.count()
    shards, groups = -(-n_vectors // shard_rows) or 1, -(-n_queries // block_rows) or 1
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>"))
    )
    asked = queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(groups))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>"))
    )
    schema = "query_row long, query_id long, row long, vec_id long, score long"
    out = arrow_schema(schema)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        width = max(max(t.column("terms").combine_chunks().value_lengths().to_numpy().max() for t in (left, right)), 1)
        rows = left.column("row").to_numpy()
        by_row = np.argsort(rows)
        left, rows = left.take(pa.array(by_row)), rows[by_row]
        null_last = np.iinfo(np.int64).max
        names = left.column("vec_id").fill_null(null_last).to_numpy()
        postings = Postings(_matrix(left.column("terms"), width))
        asked_rows = right.column("row").to_numpy()
        found, scores, sizes = [], [], []
        for row, query in zip(asked_rows, _matrix(right.column("terms"), width)):
            at = np.searchsorted(rows, row)
            places, score = postings.top(query, k, names, int(at) if at < len(rows) and rows[at] == row else None)
            found.append(places)
            scores.append(score)
            sizes.append(len(places))
        places = np.concatenate(found)
        asked_at = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        return pa.Table.from_arrays(
            [
                right.column("row").take(asked_at), right.column("vec_id").take(asked_at),
                left.column("row").take(pa.array(places)), left.column("vec_id").take(pa.array(places)), pa.array(np.concatenate(scores)),
            ],
            schema=out,
        )

    best = dealt.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(search, schema)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_row", "query_id", "rank", "vec_id", "score")
    )
