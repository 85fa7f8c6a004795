"""Continuous loading: new CSV files are merged as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lapsewise import schemas as S
from lapsewise.operators.integrity import normalize_dates
from lapsewise.plans.seeding import merge_file
from lapsewise.sources.tables import CSV_OPTIONS


def stream_table(
    spark: SparkSession, csv_folder: str, store: str, table: str, checkpoint: str, on_orphan: str = "fail"
) -> StreamingQuery:
    """Merge the files of ``csv_folder`` into a stored table, then stop.

    Uniqueness is against the whole stored table rather than a watermark, so
    each micro-batch goes through the same merge as a batch load; a batch that
    is retried after a failure adds nothing twice. Rows that arrive before
    their parent stop the stream, which takes them up again when it is
    restarted, or go to the quarantine of their table.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        merge_file(batch.sparkSession, store, table, batch, on_orphan)

    files = spark.readStream.schema(S.SCHEMAS[table]).options(**CSV_OPTIONS).csv(csv_folder)
    return (
        normalize_dates(files, S.date_columns(table))
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_all(
    spark: SparkSession,
    csv_folder: str,
    store: str,
    checkpoint: str,
    on_orphan: str = "fail",
    tables: Sequence[str] = S.LOAD_ORDER,
) -> None:
    """Merge the new files of each table's folder, parents first, then stop."""
    for table in tables:
        stream_table(
            spark, f"{csv_folder}/{table}", store, table, f"{checkpoint}/{table}", on_orphan
        ).awaitTermination()
