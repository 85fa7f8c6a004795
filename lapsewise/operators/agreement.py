"""How far two groupings of the same policies agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.functions.scalars import pairs
from lapsewise.workspace import durable


def matched_with_profile(segmented: DataFrame, profile: DataFrame) -> DataFrame:
    return segmented.join(profile.select("policy_num", "hidden_profile"), "policy_num")


def profile_coverage(segmented: DataFrame, profile: DataFrame) -> DataFrame:
    """How many policies the profile covers, out of how many."""
    known = profile.select("policy_num", F.lit(1).alias("known")).distinct()
    return segmented.select("policy_num").join(known, "policy_num", "left").agg(
        F.count("known").alias("matched"), F.count("*").alias("total")
    )


def counted_cells(df: DataFrame, row: str, column: str) -> DataFrame:
    """The long form of a crosstab: ``(row, column, n)`` of each pair of known values that occurs."""
    known = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    return known.groupBy(row, column).agg(F.count("*").alias("n"))


def wide(cells: DataFrame, row: str, column: str) -> DataFrame:
    """Counted cells ``(row, column, n)`` as one column per value of ``column`` that occurs.

    The cells are stored first: they are few, and their values, however many, name the columns.
    """
    cells = durable(cells, "crosstab-cells")
    names = sorted(found[0] for found in cells.select(column).where(F.col(column).isNotNull()).distinct().collect())
    return cells.groupBy(row).pivot(column, names).agg(F.sum("n")).na.fill(0)


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts per ``row`` value, one column per ``column`` value that occurs; empty cells are 0."""
    return wide(counted_cells(df, row, column), row, column).orderBy(row)


def adjusted_rand_index(df: DataFrame, left: str, right: str) -> DataFrame:
    """One row ``adjusted_rand``: 1 for equal groupings, about 0 for unrelated ones.

    The data is counted once; the margins come from a cube over the counted
    cells. Two trivial groupings agree perfectly.
    """
    cells = df.groupBy(left, right).agg(F.count("*").alias("n"))
    margins = cells.cube(left, right).agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))

    def pairs_at(level: int):
        return F.sum(F.when(F.col("level") == level, pairs(F.col("n"))).otherwise(0.0))

    sums = margins.agg(
        pairs_at(0).alias("both"),
        pairs_at(1).alias("left_pairs"),
        pairs_at(2).alias("right_pairs"),
        pairs_at(3).alias("all_pairs"),
    )
    expected = F.when(
        F.col("all_pairs") > 0, F.col("left_pairs") * F.col("right_pairs") / F.col("all_pairs")
    ).otherwise(0.0)
    most = (F.col("left_pairs") + F.col("right_pairs")) / 2
    return sums.select(
        F.when(most == expected, F.lit(1.0))
        .otherwise((F.col("both") - expected) / (most - expected))
        .alias("adjusted_rand")
    )
