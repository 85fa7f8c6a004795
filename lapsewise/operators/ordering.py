"""Running totals in a global order, without one task holding the whole order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_SAMPLES_PER_SLICE = 4
_STRIDE = 32  # of the landmarks that narrow the search among the splitters


def default_slices(df: DataFrame) -> int:
    return max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _key(columns: Sequence[str]) -> Column:
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def slice_bounds(
    df: DataFrame, columns: Sequence[str], slices: int | None = None, samples: int = _SAMPLES_PER_SLICE
) -> Column:
    """Splitters that cut the order of ``columns`` into even slices, as one value.

    They are taken from a fixed-size sample: the rows with the smallest key
    hashes, so every evaluation picks the same ones. More ``samples`` a slice
    make the slices more even.
    """
    slices = slices or default_slices(df)

    def every(array: str, n: int) -> Column:
        return F.filter(array, lambda _, i: i % n == n - 1)

    return (
        df.select(_key(columns).alias("k"))
        .orderBy(F.xxhash64("k"), "k")
        .limit(samples * slices)
        .agg(F.sort_array(F.collect_list("k")).alias("sample"))
        .select(every("sample", samples).alias("splitters"))
        .select(F.struct("splitters", every("splitters", _STRIDE).alias("landmarks")))
        .scalar()
    )


def with_slices(df: DataFrame, columns: Sequence[str], bounds: Column) -> DataFrame:
    """Add ``_slice``, the number of splitters in ``bounds`` below each row's key."""
    key = _key(columns)

    def below_key(array: Column) -> Column:
        return F.coalesce(F.size(F.filter(array, lambda s: s < key)), F.lit(0))

    return (
        df.withColumn("_s", bounds)
        .withColumn("_passed", below_key(F.col("_s.landmarks")) * _STRIDE)
        .withColumn(
            "_slice",
            F.col("_passed")
            + below_key(F.slice("_s.splitters", F.col("_passed") + 1, F.lit(_STRIDE))),
        )
        .drop("_s", "_passed")
    )


def running_totals(
    df: DataFrame,
    order_by: Sequence[str],
    totals: Sequence[str],
    within: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """Add ``<total>_before``: the sum of ``total`` over all earlier rows.

    Rows are ordered by ``order_by`` inside each ``within`` group; the two
    together must be unique. The order is cut into even slices. Slices are
    summed first; only those few sums are accumulated in one place, and rows are
    accumulated inside their slice. A group of any size therefore spreads over slices.
    """
    sliced = with_slices(df, [*within, *order_by], slice_bounds(df, [*within, *order_by], slices))

    def summed(window: W, total: str) -> Column:
        return F.coalesce(F.sum(total).over(window), F.lit(0))

    earlier_slices = W.partitionBy(*within).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    per_slice = sliced.groupBy(*within, "_slice").agg(*[F.sum(t).alias(t) for t in totals])
    offsets = per_slice.select(
        *within, "_slice", *[summed(earlier_slices, t).alias(f"_{t}_offset") for t in totals]
    )
    # At most slices + 1 rows when there are no groups, so the size is known.
    offsets = offsets if within else F.broadcast(offsets)

    earlier_rows = (
        W.partitionBy(*within, "_slice").orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1)
    )
    joined = sliced.join(offsets, [*within, "_slice"])
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(f"_{t}_offset") + summed(earlier_rows, t)).alias(f"{t}_before") for t in totals],
    )
