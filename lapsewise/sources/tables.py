"""Reading raw tables. Every reader is lazy and typed; nothing is inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lapsewise import schemas as S
from lapsewise.operators.integrity import normalize_dates


# Shared by the batch and the streaming reader: columns must come under the names
# and in the order of the schema, and a value that does not parse fails the job.
CSV_OPTIONS = {"header": True, "enforceSchema": False, "dateFormat": "yyyy-MM-dd", "mode": "FAILFAST"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV scan with a header; blanks are NULL."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def read_csv_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """``<source name>.csv``, or a file under the plain name of the table."""
    schema = S.SCHEMAS[table]
    try:
        rows = read_csv(spark, f"{folder}/{S.SOURCE_NAMES[table]}.csv", schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = read_csv(spark, f"{folder}/{table}.csv", schema)
    return normalize_dates(rows, S.date_columns(table))


def read_hidden_profile(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, S.HIDDEN_PROFILE_SCHEMA)


def load_tables(
    spark: SparkSession, folder: str, tables: Iterable[str] = S.LOAD_ORDER
) -> dict[str, DataFrame]:
    """The stored tables, one Parquet folder each, without the columns of their layout."""
    return {t: spark.read.schema(S.SCHEMAS[t]).parquet(f"{folder}/{t}").select(*S.SCHEMAS[t].names) for t in tables}


def load_jdbc_tables(
    spark: SparkSession,
    options: dict[str, str],
    bounds: dict[str, list[str]],
    tables: Iterable[str] = S.LOAD_ORDER,
) -> dict[str, DataFrame]:
    """The tables of a database, under their source names, each read by one task per
    predicate in ``bounds``.

    The predicates of a table must not overlap and must cover it.
    """
    url = options["url"]
    properties = {k: v for k, v in options.items() if k != "url"}
    return {
        t: spark.read.jdbc(url, S.SOURCE_NAMES[t], predicates=bounds[t], properties=properties)
        for t in tables
    }
