"""Loading new files into the stored tables, again and again."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise import schemas as S
from lapsewise.operators.integrity import new_rows, orphan_keys
from lapsewise.operators.profiling import table_counts
from lapsewise.sources.store import append_new, quarantine, read_table
from lapsewise.sources.tables import read_csv_table
from lapsewise.workspace import durable


def orphan_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orphaned keys of every table whose parent is present too."""
    found = None
    for child, (column, parent) in S.FOREIGN_KEYS.items():
        if child not in tables or parent not in tables:
            continue
        orphans = orphan_keys(
            tables[child], tables[parent], column, S.PRIMARY_KEYS[parent][0]
        ).select(F.lit(child).alias("child_table"), F.lit(column).alias("foreign_key"), "*")
        found = orphans if found is None else found.unionByName(orphans)
    return found


def seed_counts(incoming: Mapping[str, DataFrame], stored: Mapping[str, DataFrame]) -> DataFrame:
    """Per table in load order: rows that would be new, and rows in the file."""
    fresh = {
        t: new_rows(incoming[t], stored[t], S.PRIMARY_KEYS[t]).select(*S.PRIMARY_KEYS[t])
        for t in incoming
    }
    new = table_counts(fresh).withColumnRenamed("n_rows", "new_rows")
    whole = table_counts(incoming).withColumnRenamed("n_rows", "file_rows")
    return new.join(whole, "table_name")


_KNOWN, _ORPHAN = "_parent_is_stored", "_is_orphan"


def merge_file(
    spark: SparkSession, store: str, table: str, rows: DataFrame, on_orphan: str = "fail"
) -> tuple[int, int, int]:
    """Append the new rows of one table; return how many were new, went to quarantine, and came.

    A row whose parent is not stored fails the load, as a foreign key would, or
    is kept in the quarantine of its table, from where its file can be loaded
    again once the parent is there. The rows meet the parents' keys on their way
    from the source and are stored once, marked: the check and the merge then read
    columns, and the rows that are to be kept back and to be loaded are not joined again.
    """
    if on_orphan not in ("fail", "quarantine"):
        raise ValueError(f"on_orphan is 'fail' or 'quarantine', not {on_orphan!r}")
    is_orphan = F.lit(False)
    if table in S.FOREIGN_KEYS:
        column, parent = S.FOREIGN_KEYS[table]
        known = read_table(spark, store, parent).select(F.col(S.PRIMARY_KEYS[parent][0]).alias(column)).distinct()
        rows = rows.join(known.withColumn(_KNOWN, F.lit(True)), column, "left")
        is_orphan = F.col(column).isNotNull() & F.col(_KNOWN).isNull()
    came = durable(rows.select(*S.SCHEMAS[table].names, is_orphan.alias(_ORPHAN)), f"file-{table}")
    orphans, with_parent = (came.where(c).drop(_ORPHAN) for c in (F.col(_ORPHAN), ~F.col(_ORPHAN)))
    kept_back, example = 0, orphans.head()
    if example is not None:
        if on_orphan == "fail":
            raise ValueError(f"{table}.{column} {example[column]!r} has no row in {parent}")
        kept_back = quarantine(spark, store, table, orphans)
    return append_new(spark, store, table, with_parent), kept_back, came.count()


def seed_all(spark: SparkSession, csv_folder: str, store: str, on_orphan: str = "fail") -> DataFrame:
    """Load every CSV table, parents first."""
    counts = [
        (table, *merge_file(spark, store, table, read_csv_table(spark, csv_folder, table), on_orphan))
        for table in S.LOAD_ORDER
    ]
    return spark.createDataFrame(
        counts, "table_name string, new_rows bigint, quarantined_rows bigint, file_rows bigint"
    )
