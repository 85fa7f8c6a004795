"""Table folders: append what is new, keep score history, write report files.

A stored table lies in ``key_bucket=<n>/write_id=<id>`` folders, its files sorted by key. An append
reads of the stored keys only the buckets and the key range of the incoming rows, writes the new rows
once, and counts them from the footers of what it wrote. Score history lies in
``scored_date=<day>/write_id=<id>`` folders and is committed by the batch log: rows of a write that the
log does not name are never read, so a failure between the two leaves the history as it was.

One writer per table is assumed; appending again adds nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewise import schemas as S
from lapsewise.operators.integrity import keep_one_of_repeated, new_rows, repeated_keys, unknown_rows
from lapsewise.workspace import n_tasks

PARTITION = "scored_date"
BUCKET, WRITE = "key_bucket", "write_id"
#: Folders by key hash; an append of few keys reads few of them.
BUCKETS = 32


def _read(spark: SparkSession, path: str, schema: T.StructType, *layout: T.StructField) -> DataFrame:
    """A stored folder with the columns of its ``layout``, or an empty table."""
    whole = T.StructType([*schema.fields, *layout])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


_BUCKET = T.StructField(BUCKET, T.IntegerType())
_WRITE = T.StructField(WRITE, T.StringType())
_DAY = T.StructField(PARTITION, T.DateType())


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A stored table, or an empty one if nothing is stored yet; of score history, with its partition
    column, the committed writes."""
    if table == S.RISK_SCORE:
        committed = read_batch_log(spark, folder).select(PARTITION, WRITE).distinct()
        history = _read(spark, f"{folder}/{table}", S.SCHEMAS[table], _DAY, _WRITE)
        return history.join(committed, [PARTITION, WRITE], "left_semi").select(*S.SCHEMAS[table].names, PARTITION)
    return _keyed(spark, folder, table).select(*S.SCHEMAS[table].names)


def _keyed(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return _read(spark, f"{folder}/{table}", S.SCHEMAS[table], _BUCKET, _WRITE)


def key_bucket(table: str) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in S.PRIMARY_KEYS[table]]), F.lit(BUCKETS)).cast("int")


def _new_write() -> str:
    return f"w-{uuid.uuid4().hex}"  # never taken for a number


def stored_keys(spark: SparkSession, folder: str, table: str, incoming: DataFrame) -> DataFrame:
    """The stored rows that can have a key of ``incoming``: those of its buckets and its range of keys."""
    key = S.PRIMARY_KEYS[table][0]
    if not _keyed(spark, folder, table).inputFiles():
        return _keyed(spark, folder, table).limit(0)
    # one row a bucket
    touched = incoming.groupBy(key_bucket(table).alias(BUCKET)).agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
    buckets = [row[BUCKET] for row in touched]
    known = [row for row in touched if row["low"] is not None]
    stored = _keyed(spark, folder, table).where(F.col(BUCKET).isin(buckets))
    if not known:
        return stored.limit(0)
    return stored.where(F.col(key).between(F.lit(min(r["low"] for r in known)), F.lit(max(r["high"] for r in known))))


def append_new(spark: SparkSession, folder: str, table: str, incoming: DataFrame) -> int:
    """Append the rows whose key is not stored yet; return how many there were.

    The stored files are listed before the append starts, so reading the keys
    of the folder that is added to is safe. (An observed write would count the rows
    for free, but a session that has used one can no longer run a fitted forest.)

    ``incoming`` is read several times and should be stored. Its rows are shuffled once, to
    their buckets; which keys it repeats is found from their hashes alone.
    """
    key = S.PRIMARY_KEYS[table]
    unknown = unknown_rows(incoming, stored_keys(spark, folder, table, incoming), key)
    fresh = keep_one_of_repeated(unknown, key, repeated_keys(incoming, key))
    write_id = _new_write()
    # every task writes into one bucket, however many tasks there are
    share = F.pmod(F.hash(*key), F.lit(-(-n_tasks(spark) // BUCKETS)))
    laid = fresh.repartition(n_tasks(spark), key_bucket(table), share)
    laid = laid.withColumns({BUCKET: key_bucket(table), WRITE: F.lit(write_id)})
    laid.sortWithinPartitions(BUCKET, *key).write.mode("append").partitionBy(BUCKET, WRITE).parquet(f"{folder}/{table}")
    return _keyed(spark, folder, table).where(F.col(WRITE) == write_id).count()


def write_risk_scores(spark: SparkSession, folder: str, scores: DataFrame) -> int:
    """Add batches to the history; batches already there stay.

    The history is partitioned by day, and only the days of ``scores`` are read
    to find what is stored already. The batch log gets a row for each batch of the
    write; that row, one small file, is what commits it.
    """
    dated = scores.withColumn(PARTITION, F.to_date("scored_at"))
    # as many as there are days of scoring
    days = sorted(row[0] for row in dated.select(PARTITION).distinct().collect())
    stored = read_table(spark, folder, S.RISK_SCORE).where(F.col(PARTITION).isin(days))
    write_id = _new_write()
    fresh = new_rows(dated, stored, [*S.PRIMARY_KEYS[S.RISK_SCORE], PARTITION])
    fresh.withColumn(WRITE, F.lit(write_id)).write.mode("append").partitionBy(PARTITION, WRITE).parquet(f"{folder}/{S.RISK_SCORE}")
    written = _read(spark, f"{folder}/{S.RISK_SCORE}", S.SCHEMAS[S.RISK_SCORE], _DAY, _WRITE).where(F.col(WRITE) == write_id)
    batches = written.groupBy("scored_at", PARTITION).agg(F.count("*").alias("n_rows")).withColumn(WRITE, F.lit(write_id)).collect()
    if batches:
        _commit(spark, folder, spark.createDataFrame(batches, S.BATCH_LOG_SCHEMA))
    return sum(row["n_rows"] for row in batches)


def _commit(spark: SparkSession, folder: str, batches: DataFrame) -> None:
    batches.coalesce(1).write.mode("append").parquet(f"{folder}/{S.BATCH_LOG}")


def drop_uncommitted(spark: SparkSession, folder: str) -> list[str]:
    """Delete the score rows of writes that were never committed; no write may be running."""
    path = f"{folder}/{S.RISK_SCORE}"
    found = _read(spark, path, S.SCHEMAS[S.RISK_SCORE], _DAY, _WRITE).select(PARTITION, WRITE).distinct()
    left = found.join(read_batch_log(spark, folder), [PARTITION, WRITE], "left_anti").collect()
    for row in left:
        gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{PARTITION}={row[PARTITION]}/{WRITE}={row[WRITE]}")
        gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
    return sorted(row[WRITE] for row in left)


def read_batch_log(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, f"{folder}/{S.BATCH_LOG}", S.BATCH_LOG_SCHEMA)


def quarantine(spark: SparkSession, folder: str, table: str, rows: DataFrame) -> int:
    """Keep rows that may not be loaded, one per key, beside the stored tables."""
    return append_new(spark, f"{folder}/quarantine", table, rows)


def write_small_csv(table: DataFrame, path: str) -> str:
    """One CSV file with a header, for tables of at most a few hundred rows."""
    table.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def save_evaluation(evaluation: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Scalar metrics as JSON, sweep and calibration as CSV; returns the paths."""
    report = f"{folder}/evaluation_report"
    evaluation["report"].coalesce(1).write.mode("overwrite").json(report)
    return {
        "report": report,
        "threshold_sweep": write_small_csv(evaluation["threshold_sweep"], f"{folder}/threshold_sweep"),
        "calibration": write_small_csv(evaluation["calibration"], f"{folder}/calibration"),
    }


def save_feature_importance(importance: DataFrame, folder: str) -> str:
    return write_small_csv(importance, f"{folder}/feature_importance")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
