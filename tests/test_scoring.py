import datetime

import pytest
from pyspark.sql import functions as F

from lapsewise import schemas as S
from lapsewise.fixed_values import ACTIONS
from lapsewise.operators import models, profiling, reporting
from lapsewise.operators.scores import latest_batch, latest_scores, risk_trend
from lapsewise.plans import report, scoring
from lapsewise.sources import store as store_module
from lapsewise.sources.store import (
    read_batch_log,
    read_table,
    save_evaluation,
    save_model,
    write_risk_scores,
)
from lapsewise.plans.training import evaluate_scores
from tests.fixtures import day, invoices, one_driver, payments, policies

AT = datetime.datetime(2026, 3, 1, 12, 0, 0)


@pytest.fixture(scope="module")
def table(spark):
    return one_driver(spark).cache()


@pytest.fixture(scope="module")
def forest(table):
    return models.fit_classifier(table, models.random_forest(n_trees=20, max_depth=4))


@pytest.fixture(scope="module")
def batch(table, forest):
    return scoring.score_policies(forest, table, scored_at=AT)


def test_batch_rows(batch):
    assert batch.scores.schema.simpleString() == S.SCHEMAS[S.RISK_SCORE].simpleString()
    rows = batch.scores.collect()
    assert len(rows) == 40 and {r.scored_at for r in rows} == {AT}
    for r in rows:
        assert 0 <= r.churn_probability <= 1
        assert len(r.top_factors) == 3
        sizes = [abs(f.value) for f in r.top_factors]
        assert sizes == sorted(sizes, reverse=True)
        assert r.segment_label in ("Low risk", "Medium risk", "High risk")
    risky = max(rows, key=lambda r: r.churn_probability)
    assert risky.top_factors[0].feature == "failed_invoice_ratio"
    assert risky.recommended_action == ACTIONS["failed_invoice_ratio"]


def test_batch_importance_covers_every_feature(batch, forest):
    rows = batch.importance.collect()
    assert len(rows) == len(models.feature_names(forest))
    assert rows[0].feature == "failed_invoice_ratio"


def test_nothing_to_score_is_an_empty_batch(table, forest):
    empty = scoring.score_policies(forest, table.limit(0))
    assert empty.scores.count() == 0


def test_history_keeps_batches_and_ignores_a_repeated_one(spark, batch, tmp_path):
    store = str(tmp_path)
    later = batch.scores.withColumn("scored_at", F.expr("scored_at + INTERVAL 1 DAY"))
    assert write_risk_scores(spark, store, batch.scores) == 40
    assert write_risk_scores(spark, store, batch.scores) == 0
    assert write_risk_scores(spark, store, later) == 40
    history = read_table(spark, store, S.RISK_SCORE)
    assert history.count() == 80
    log = read_batch_log(spark, store)
    assert sorted(r.n_rows for r in log.collect()) == [40, 40]
    newest = latest_batch(history, log)
    assert newest.count() == 40
    assert {r.scored_at for r in newest.collect()} == {AT + datetime.timedelta(days=1)}
    assert latest_batch(history).count() == 40
    plan = newest._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "churn_probability" in line]
    assert scans and all("PartitionFilters: []" not in line for line in scans)
    changes = risk_trend(history).where("previous_probability IS NOT NULL").collect()
    assert len(changes) == 40 and all(r.probability_change == 0 for r in changes)


def test_a_failed_commit_leaves_the_old_batch(spark, batch, tmp_path, monkeypatch):
    """The rows of a batch are there, but its log row is not: no reader sees them, and a retry counts them once."""
    store = str(tmp_path)
    later = batch.scores.withColumn("scored_at", F.expr("scored_at + INTERVAL 1 DAY"))
    assert write_risk_scores(spark, store, batch.scores) == 40

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store_module, "_commit", fails)
        with pytest.raises(OSError, match="lost"):
            write_risk_scores(spark, store, later)
    history, log = read_table(spark, store, S.RISK_SCORE), read_batch_log(spark, store)
    assert history.count() == 40 == latest_batch(history, log).count()
    assert {r.scored_at for r in latest_batch(history, log).collect()} == {AT}
    assert latest_batch(history).agg(F.max("scored_at")).head()[0] == AT
    assert len(store_module.drop_uncommitted(spark, store)) == 1 and store_module.drop_uncommitted(spark, store) == []
    assert write_risk_scores(spark, store, later) == 40
    assert read_table(spark, store, S.RISK_SCORE).count() == 80


def test_end_to_end_batch(spark, forest, tmp_path):
    model_path = save_model(forest, str(tmp_path / "model"))
    pol = policies(
        spark,
        [(f"P{i}", "Active" if i else "Expired", "2024-01-01", "2025-01-01", None) for i in range(6)],
    )
    inv = invoices(spark, [(f"I{i}{n}", f"P{i}", n, "2024-01-01", 30) for i in range(6) for n in range(3)])
    pay = payments(spark, [(f"T{i}", f"I{i}0", "2024-01-09", "Failed" if i % 2 else "Paid") for i in range(6)])
    tables = {S.POLICIES: pol, S.INVOICE: inv, S.PAYHISTORY: pay}
    store = str(tmp_path / "store")
    added, scores = scoring.run_batch_scoring(spark, tables, model_path, store, AT)
    assert added == 5
    assert {r.policy_num for r in scores.collect()} == {f"P{i}" for i in range(1, 6)}
    importance = spark.read.option("header", True).csv(f"{store}/feature_importance")
    assert importance.columns == ["feature", "mean_abs_shap_value"]


FACTORS = [("failed_invoice_ratio", 0.3), ("tenure_days", 0.2)]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        ("P1", AT, 0.9, "High risk", FACTORS, ACTIONS["failed_invoice_ratio"], "Auto", "Monthly", "Active"),
        ("P2", AT, 0.5, "Medium risk", [], ACTIONS["max_days_late"], "Home", "Monthly", "Active"),
        ("P3", AT, 0.1, "Low risk", [], ACTIONS["max_days_late"], "Home", "Monthly", "Active"),
    ]
    return spark.createDataFrame(
        rows,
        "policy_num string, scored_at timestamp_ntz, churn_probability double, segment_label string, "
        f"top_factors {S.FACTORS.simpleString()}, recommended_action string, insurance_product string, "
        "payment_frequency string, policy_status string",
    )


def test_policy_detail(scored):
    detail = reporting.policy_detail(scored)
    assert detail.columns == [
        "Policy", "Churn Risk", "Segment", "Product", "Payment Frequency", "Status", "Suggested Action", "Why Flagged",
    ]
    why = {r["Policy"]: r["Why Flagged"] for r in detail.collect()}
    assert why == {"P1": "Repeated failed payment attempts", "P2": "-", "P3": "-"}


def test_summary_counts_only_policies_at_risk(scored):
    assert {tuple(r) for r in reporting.segment_counts(scored).collect()} == {
        ("High risk", 1), ("Medium risk", 1), ("Low risk", 1),
    }
    assert {tuple(r) for r in reporting.action_counts(scored).collect()} == {
        ("Prompt a payment-method update", 1), ("Escalate to a retention call", 1),
    }
    assert tuple(reporting.summary_headline(scored).collect()[0]) == (3, "2 (67%)")


def test_unknown_segment_is_at_risk_but_not_counted_as_a_segment(scored):
    unknown = scored.withColumn("segment_label", F.lit(None).cast("string"))
    assert tuple(reporting.summary_headline(unknown).collect()[0]) == (3, "3 (100%)")
    assert reporting.segment_counts(unknown).isEmpty()


def test_half_percent_rounds_to_even(scored):
    copies = F.explode(F.when(F.col("policy_num") == "P3", F.sequence(F.lit(1), F.lit(7))).otherwise(F.array(F.lit(1))))
    eight = scored.where("policy_num != 'P2'").withColumn("copy", copies)
    assert reporting.summary_headline(eight).collect()[0][1] == "1 (12%)"


def test_latest_scores_put_unknown_probability_first(spark):
    history = spark.createDataFrame(
        [("P1", AT, 0.2), ("P2", AT, None), ("P3", AT, 0.7), ("P1", AT - datetime.timedelta(days=1), 0.9), ("P9", AT, 0.5)],
        "policy_num string, scored_at timestamp_ntz, churn_probability double",
    ).selectExpr("*", "'Low risk' segment_label", f"cast(array() AS {S.FACTORS.simpleString()}) top_factors", "'x' recommended_action")
    pol = policies(spark, [(f"P{i}", "Active", "2024-01-01", "2025-01-01", None) for i in (1, 2, 3)])
    assert [r.policy_num for r in latest_scores(history, pol).collect()] == ["P2", "P3", "P1"]


def test_report_files(spark, scored, tmp_path):
    path = report.build_report(scored, str(tmp_path), day("2026-03-09"))
    assert path.endswith("risk_report_20260309")
    for name, rows in (("policy_detail", 3), ("headline", 1), ("segment_counts", 3), ("action_counts", 2)):
        assert spark.read.option("header", True).csv(f"{path}/{name}").count() == rows


def test_empty_report_is_refused(scored, tmp_path):
    with pytest.raises(ValueError, match="No scored policies"):
        report.build_report(scored.limit(0), str(tmp_path))


def test_saved_evaluation(spark, tmp_path):
    tables = evaluate_scores(spark.createDataFrame([(0, 0.1), (1, 0.9)], "y int, p double"))
    paths = save_evaluation(tables, str(tmp_path / "new" / "folder"))
    saved = spark.read.json(paths["report"]).collect()[0]
    assert saved.default_threshold_metrics.precision == 1.0
    assert spark.read.option("header", True).csv(paths["threshold_sweep"]).count() == 19
    assert spark.read.option("header", True).csv(paths["calibration"]).columns == [
        "mean_predicted_probability", "observed_churn_rate",
    ]


def test_profile_tables(spark):
    pol = policies(
        spark,
        [("P1", "Active", "2024-01-01", None, None), ("P2", "Active", "2024-01-01", None, None), ("P3", "Cancelled", "2024-01-01", None, None), ("P4", None, None, None, None)],
    )
    inv = invoices(spark, [("I1", "P1", 1, "2024-01-01", 30), ("I2", "P1", 2, "2024-01-01", 30), ("I3", "P3", 1, "2024-01-01", 30)])
    pay = payments(spark, [("T1", "I1", None, "Paid"), ("T2", "I1", None, "Failed"), ("T3", "I1", None, "Bounced"), ("T4", "I3", None, "Paid"), ("T5", "I9", None, "Paid"), ("T6", "I3", None, None)])
    balance = [tuple(r) for r in profiling.class_balance(pol).collect()]
    assert balance == [("Active", 2, 66.7), ("Cancelled", 1, 33.3)]
    shares = profiling.payment_status_share(pol, inv, pay)
    assert shares.columns == ["policy_status", "Bounced", "Failed", "Paid"]
    assert [tuple(r) for r in shares.collect()] == [("Active", 33.3, 33.3, 33.3), ("Cancelled", 0.0, 0.0, 100.0)]
    assert profiling.payment_status_share(pol, inv, pay.limit(0)).collect() == []
    missed = {r.policy_status: (r.total, r.paid, r.missed, r.missed_pct) for r in profiling.missed_by_status(pol, inv, pay).collect()}
    assert missed == {"Active": (2, 1, 1, 50.0), "Cancelled": (1, 1, 0, 0.0)}
    assert tuple(profiling.policies_per_customer(pol).collect()[0]) == (4.0, 4, 4)
