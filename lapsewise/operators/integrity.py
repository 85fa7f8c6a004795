"""Cleaning, referential checks and the choice of rows that are new to a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Calendar dates in ``columns``; blanks and NaN become NULL everywhere."""

    def cleaned(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            value = F.when(value != "", value)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        if field.name in columns:
            value = F.to_date(value)
        return value.alias(field.name)

    return df.select([cleaned(f) for f in df.schema.fields])


def orphan_keys(child: DataFrame, parent: DataFrame, foreign_key: str, parent_key: str) -> DataFrame:
    """Foreign keys without a parent row, with the number of child rows behind each.

    Child rows are counted per key first, so a key that many rows share is a
    single row by the time it is joined. A NULL key refers to nothing and passes.
    """
    counted = (
        child.where(F.col(foreign_key).isNotNull())
        .groupBy(F.col(foreign_key).alias("orphan_key"))
        .agg(F.count("*").alias("child_rows"))
    )
    known = parent.select(F.col(parent_key).alias("orphan_key"))
    return counted.join(known, "orphan_key", "left_anti")


def one_row_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keep one row per key: the smallest by its other columns, so reruns agree.

    An aggregate rather than a window: copies of one key combine before the
    shuffle, however many there are. A missing key fails the job, as a primary
    key constraint would.
    """
    rest = [c for c in df.columns if c not in key]
    checked = _checked(df, key).select(*key, *rest)
    if not rest:
        return checked.distinct()
    kept = checked.groupBy(*key).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*key, "kept.*").select(df.columns)


def _checked(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.withColumns({k: F.coalesce(F.col(k), F.raise_error(F.lit(f"{k} is NULL"))) for k in key})


_HASH = "_key_hash"
#: Hashes of repeated keys that every task is sent; with more, all rows are grouped.
HASHES_SENT = 100_000


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Hashes of the keys that several rows have (and, by chance, of some other keys).

    Only the hashes are grouped, so neither the rows nor their keys are sent around.
    """
    hashes = df.select(F.xxhash64(*key).alias(_HASH))
    return hashes.groupBy(_HASH).agg(F.count("*").alias("n")).where("n > 1").select(_HASH)


def keep_one_of_repeated(
    df: DataFrame, key: Sequence[str], repeated: DataFrame, hashes_sent: int = HASHES_SENT
) -> DataFrame:
    """``one_row_per_key`` that leaves the rows of all other keys where they are.

    ``repeated`` are the ``repeated_keys`` of these rows, or of more rows.
    """
    hashes = repeated.limit(hashes_sent + 1).toArrow()
    if hashes.num_rows > hashes_sent:
        return one_row_per_key(df, key)
    if hashes.num_rows == 0:
        return _checked(df, key)
    sent, hashed = F.broadcast(df.sparkSession.createDataFrame(hashes)), df.withColumn(_HASH, F.xxhash64(*key))
    once, again = (hashed.join(sent, _HASH, how).select(df.columns) for how in ("left_anti", "left_semi"))
    return _checked(once, key).unionByName(one_row_per_key(again, key))


def unknown_rows(incoming: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing``; of that only the key columns are read."""
    # a missing key is in no table, so it passes on to the check
    return incoming.join(existing.select(*key), list(key), "left_anti").select(incoming.columns)


def new_rows(incoming: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing`` yet, one per key.

    Existing rows are never touched; only their key columns are read. Known
    keys go first, so a repeated load sorts and groups next to nothing.
    """
    return one_row_per_key(unknown_rows(incoming, existing, key), key)
