"""The risk report: tables over the latest batch, with no model work."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from lapsewise import schemas as S
from lapsewise.operators import reporting as R
from lapsewise.operators.scores import latest_scores
from lapsewise.sources.store import read_batch_log, read_table, write_small_csv
from lapsewise.workspace import durable


def report_name(day: date | None = None) -> str:
    """One report per day: a later day does not overwrite an earlier one."""
    return f"risk_report_{day or date.today():%Y%m%d}"


def report_tables(scores: DataFrame) -> dict[str, DataFrame]:
    return {
        "policy_detail": R.policy_detail(scores),
        "headline": R.summary_headline(scores),
        "segment_counts": R.segment_counts(scores),
        "action_counts": R.action_counts(scores),
    }


def build_report(scores: DataFrame, folder: str, day: date | None = None) -> str:
    """Write the report tables of a joined batch; an empty batch is refused."""
    if scores.isEmpty():
        raise ValueError("No scored policies to report on: run the batch scoring first.")
    scores = durable(scores, "report-scores")
    path = f"{folder}/{report_name(day)}"
    for name, table in report_tables(scores).items():
        if name == "policy_detail":
            table.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
        else:
            write_small_csv(table, f"{path}/{name}")
    return path


def run_report(spark: SparkSession, store: str, folder: str, day: date | None = None) -> str:
    return build_report(stored_latest_scores(spark, store), folder, day)


def stored_latest_scores(spark: SparkSession, store: str) -> DataFrame:
    """The latest stored batch; an empty one if nothing is scored yet."""
    history, log = read_table(spark, store, S.RISK_SCORE), read_batch_log(spark, store)
    return latest_scores(history, read_table(spark, store, S.POLICIES), log)
