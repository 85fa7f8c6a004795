"""Every operator as a query over the given tables.

Results are shown in types that both engines print alike: dates and times as
text, doubles rounded to six places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise import schemas as S
from lapsewise.fixed_values import EXPIRED, PAID, SEGMENT_NAMES
from lapsewise.functions.advice import described, factors_from_json, factors_to_json, recommended_action
from lapsewise.operators import agreement, attribution, behaviour, integrity
from lapsewise.operators import metrics as M
from lapsewise.operators import models, payments, profiling, reporting, scores, segments, splitting
from lapsewise.plans import report, scoring, seeding, segmentation, training
from lapsewise.plans.explanation import explain_held_out
from lapsewise.plans.features import build_active_feature_table, build_feature_table
from lapsewise.plans.profile import profile_tables
from lapsewise.sources import store as store_tables
from lapsewise.sources.tables import read_csv_table, read_hidden_profile
from lapsewise.streaming.seeding import stream_all
from lapsewise.workspace import durable, scratch_path
from verification import model_checks as checks
from verification import stand_ins
from verification.order_history import billing_tables, hidden_profile

Query = Callable[[SparkSession, str], DataFrame]


def _r6(column: Column) -> Column:
    return F.round(column, 6) + F.lit(0.0)  # no negative zero


def shown(df: DataFrame, *columns: str) -> DataFrame:
    names = list(columns) or df.columns
    types = dict(df.dtypes)

    def show(name: str) -> Column:
        column = F.col(f"`{name}`")
        if types[name] in ("date", "timestamp", "timestamp_ntz"):
            column = column.cast("string")
        elif types[name].startswith("decimal"):
            column = column.cast("double")
        elif types[name] == "double":
            column = _r6(column)
        return column.alias(name)

    return df.select([show(n) for n in names])


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return build_feature_table(billing_tables(spark, folder))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return stand_ins.with_score(_features(spark, folder))


def _score_counts(spark: SparkSession, folder: str) -> DataFrame:
    return durable(M.score_counts(_scored(spark, folder)), "score-counts")


def _clustered(spark: SparkSession, folder: str) -> DataFrame:
    return stand_ins.with_cluster(_features(spark, folder))


def _explained(spark: SparkSession, folder: str) -> DataFrame:
    return stand_ins.with_linear_contributions(_features(spark, folder))


def _stored_history(spark: SparkSession, folder: str) -> str:
    """A store to which the stand-in batches were appended one after the other."""
    table = build_active_feature_table(billing_tables(spark, folder))
    batches, store = stand_ins.history(durable(table, "features")), scratch_path(spark, "store")
    for scored_at, _ in stand_ins.BATCHES:
        store_tables.write_risk_scores(spark, store, batches.where(F.col("scored_at") == F.lit(scored_at)))
    return store


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return store_tables.read_table(spark, _stored_history(spark, folder), S.RISK_SCORE)


def _latest(spark: SparkSession, folder: str) -> DataFrame:
    store = _stored_history(spark, folder)
    return scores.latest_scores(
        store_tables.read_table(spark, store, S.RISK_SCORE),
        billing_tables(spark, folder)[S.POLICIES],
        store_tables.read_batch_log(spark, store),
    )


def _settled_invoices(spark: SparkSession, folder: str) -> DataFrame:
    """Invoices of finished orders: what an earlier load would have stored."""
    finished = (
        spark.read.parquet(f"{folder}/orders.parquet")
        .where(F.col("o_orderstatus") == "F")
        .select(F.col("o_orderkey").cast("string").alias("invoice_num"))
    )
    return billing_tables(spark, folder)[S.INVOICE].join(finished, "invoice_num", "left_semi")


# --- loading and integrity -------------------------------------------------


def normalize_dates(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "ts", "event_type", "value")
    return shown(integrity.normalize_dates(events, ["ts"]))


def upsert_new_keys(spark, folder):
    invoices = billing_tables(spark, folder)[S.INVOICE]
    repeated = invoices.unionByName(
        invoices.withColumn("premium", (F.col("premium") + 1).cast("decimal(12,2)"))
    )
    return shown(integrity.new_rows(repeated, _settled_invoices(spark, folder), ["invoice_num"]))


def fk_orphans(spark, folder):
    tables = billing_tables(spark, folder)
    return seeding.orphan_report({**tables, S.INVOICE: _settled_invoices(spark, folder)})


def seed_counts(spark, folder):
    incoming = billing_tables(spark, folder)
    stored = {
        S.CUSTOMER: incoming[S.CUSTOMER].join(
            _settled_invoices(spark, folder).select("policy_num").distinct().join(
                incoming[S.POLICIES].select("policy_num", "customer_id"), "policy_num"
            ),
            "customer_id",
            "left_semi",
        ),
        S.POLICIES: incoming[S.POLICIES].where(F.col("policy_status") == EXPIRED),
        S.INVOICE: _settled_invoices(spark, folder),
        S.PAYHISTORY: incoming[S.PAYHISTORY].where(F.col("pay_transaction_status") == PAID),
    }
    return seeding.seed_counts(incoming, stored)


# --- behaviour ---------------------------------------------------------------


def payment_days_late(spark, folder):
    tables = billing_tables(spark, folder)
    late = payments.payment_lateness(tables[S.PAYHISTORY], tables[S.INVOICE])
    return shown(late, "transaction_id", "invoice_num", "pay_transaction_date", "pay_transaction_status", "days_late")


def invoice_summary(spark, folder):
    tables = billing_tables(spark, folder)
    return payments.invoice_summary(tables[S.INVOICE], tables[S.PAYHISTORY])


def missed_invoices(spark, folder):
    tables = billing_tables(spark, folder)
    return payments.missed_invoices(tables[S.INVOICE], tables[S.PAYHISTORY]).select("invoice_num", "policy_num")


def _policy_features(spark, folder):
    tables = billing_tables(spark, folder)
    summary = payments.invoice_summary(tables[S.INVOICE], tables[S.PAYHISTORY])
    return behaviour.policy_features(summary)


def policy_features(spark, folder):
    return shown(_policy_features(spark, folder))


def trend_delta(spark, folder):
    return shown(
        _policy_features(spark, folder), "policy_num", "trend_failed_rate_delta", "trend_late_rate_delta"
    )


def policy_static(spark, folder):
    return behaviour.policy_static(billing_tables(spark, folder)[S.POLICIES])


def feature_table(spark, folder):
    return shown(_features(spark, folder))


def active_policies(spark, folder):
    return shown(build_active_feature_table(billing_tables(spark, folder)))


# --- descriptive tables --------------------------------------------------------


def _profile(name: str) -> Query:
    return lambda spark, folder: shown(profile_tables(billing_tables(spark, folder))[name])


def eda_payment_status_all(spark, folder):
    """Order priorities as payment statuses: values that no list in the code names."""
    tables = billing_tables(spark, folder)
    priorities = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("invoice_num"),
        F.col("o_orderpriority").alias("pay_transaction_status"),
    )
    payments = tables[S.PAYHISTORY].drop("pay_transaction_status").join(priorities, "invoice_num")
    return shown(profiling.payment_status_share(tables[S.POLICIES], tables[S.INVOICE], payments))


# --- metrics on the stand-in score ----------------------------------------------


def confusion(spark, folder):
    return M.confusion_counts(_score_counts(spark, folder), 0.5)


def metrics(spark, folder):
    return shown(M.compute_metrics(_score_counts(spark, folder), 0.5))


def roc_auc(spark, folder):
    return shown(M.ranking_quality(_score_counts(spark, folder)), "roc_auc")


def pr_auc(spark, folder):
    return shown(M.ranking_quality(_score_counts(spark, folder)), "pr_auc")


def calibration(spark, folder):
    return shown(M.calibration_table(_score_counts(spark, folder)))


def threshold_sweep(spark, folder):
    return shown(M.with_expected_cost(M.threshold_sweep(_score_counts(spark, folder))))


def cost_threshold(spark, folder):
    return shown(M.cheapest_threshold(M.with_expected_cost(M.threshold_sweep(_score_counts(spark, folder)))))


def class_weights(spark, folder):
    return shown(splitting.class_weight_table(_features(spark, folder)))


def stratified_split(spark, folder):
    marked = splitting.mark_test_rows(durable(_features(spark, folder), "features"))
    return marked.select("policy_num", "is_churned", "is_test")


# --- segments --------------------------------------------------------------------


def label_clusters(spark, folder):
    return shown(segments.cluster_severity(_clustered(spark, folder)))


def segment_vs_profile(spark, folder):
    labelled = segments.label_segments(_clustered(spark, folder))
    matched = agreement.matched_with_profile(labelled, hidden_profile(spark, folder))
    return agreement.crosstab(matched, "segment_label", "hidden_profile")


def segment_profile_all(spark, folder):
    """The customers' market segments as profile: values that no list in the code names."""
    customers = spark.read.parquet(f"{folder}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_mktsegment").alias("hidden_profile")
    )
    policies = billing_tables(spark, folder)[S.POLICIES].select("policy_num", "customer_id")
    labelled = segments.label_segments(_clustered(spark, folder))
    comparison = segmentation.compare_to_profile(labelled, policies.join(customers, "customer_id"))
    return comparison["crosstab"]


def profile_coverage(spark, folder):
    """The profile knows only policies that are still open or were cancelled."""
    open_or_cancelled = billing_tables(spark, folder)[S.POLICIES].where(F.col("policy_status") != EXPIRED)
    known = hidden_profile(spark, folder).join(open_or_cancelled, "policy_num", "left_semi")
    return agreement.profile_coverage(_clustered(spark, folder), known)


def adjusted_rand(spark, folder):
    matched = agreement.matched_with_profile(_clustered(spark, folder), hidden_profile(spark, folder))
    return shown(agreement.adjusted_rand_index(matched, "cluster", "hidden_profile"))


# --- factors and advice -------------------------------------------------------------


def top_factors(spark, folder):
    values = F.array(*[F.col(c).cast("double") for c in S.BEHAVIOUR_FEATURES])
    return shown(attribution.ranked_factors(_explained(spark, folder), S.BEHAVIOUR_FEATURES, 5, values))


def feature_importance(spark, folder):
    return shown(attribution.feature_importance(_explained(spark, folder), S.BEHAVIOUR_FEATURES))


def riskiest_policy(spark, folder):
    return shown(attribution.riskiest_policy(_scored(spark, folder), "p"), "policy_num", "p")


def recommend_action(spark, folder):
    explained = _explained(spark, folder)
    return explained.select("policy_num", recommended_action(stand_ins.factors()).alias("recommended_action"))


def describe_factors(spark, folder):
    explained = _explained(spark, folder)
    texts = described(stand_ins.factors(8), 3)
    return explained.select(
        "policy_num", F.size(texts).alias("n_descriptions"), F.array_join(texts, " | ").alias("descriptions")
    )


# --- score batches and reports ----------------------------------------------------------


def risk_history(spark, folder):
    lead = F.col("top_factors")[0]
    rows = _history(spark, folder).select(
        "policy_num",
        "scored_at",
        "churn_probability",
        "segment_label",
        F.size("top_factors").alias("n_factors"),
        lead["feature"].alias("lead_feature"),
        lead["value"].alias("lead_value"),
        "recommended_action",
    )
    return shown(rows)


def risk_trend(spark, folder):
    return shown(scores.risk_trend(_history(spark, folder)))


def latest_scores(spark, folder):
    return shown(_latest(spark, folder).drop("top_factors"))


def policy_detail(spark, folder):
    return shown(reporting.policy_detail(_latest(spark, folder)))


def segment_counts(spark, folder):
    return reporting.segment_counts(_latest(spark, folder))


def action_counts(spark, folder):
    return reporting.action_counts(_latest(spark, folder))


def summary_headline(spark, folder):
    return reporting.summary_headline(_latest(spark, folder))


# --- models: each row states the properties that must hold for it ---------------------------


def standardize(spark, folder):
    return shown(models.standardized(_features(spark, folder)), "policy_num", *S.BEHAVIOUR_FEATURES)


def one_hot(spark, folder):
    """The whole transformed matrix: scaled numbers and 0/1 category columns."""
    table = durable(_features(spark, folder), "features")
    model = models.fit_classifier(table)
    wide = models.transform_features(model, table).withColumn("x", vector_to_array("features"))
    names = models.feature_names(model)
    return wide.select("policy_num", *[_r6(F.col("x")[i]).alias(n) for i, n in enumerate(names)])


def _held_out(scored: DataFrame) -> DataFrame:
    return scored.select(
        "policy_num",
        "y",
        F.col("p").between(0, 1).alias("in_range"),
        ((F.col("p") > 0.5) == (F.col("prediction") == 1)).alias("class_follows_p"),
    )


def lr_scores(spark, folder):
    return _held_out(training.held_out_scores(training.train(_features(spark, folder))))


def lr_optimum(spark, folder):
    """The gradient of the balanced, penalised loss at the fitted coefficients, per training row."""
    rows, _ = training.split_stored(_features(spark, folder))
    model = models.fit_classifier(rows)
    names, fitted = models.feature_names(model), model.stages[-1]
    n_rows, weights = rows.count(), splitting.class_weights(splitting.class_counts(rows))
    weight = F.when(F.col(S.LABEL) == 1, weights[1]).otherwise(weights[0])
    residual = weight * (F.col("churn_probability") - F.col(S.LABEL))
    scored = models.predict(model, rows).select(residual.alias("r"), vector_to_array("features").alias("x"))
    parts = [F.sum(F.col("r") * F.col("x")[i]) + float(b) for i, b in enumerate(fitted.coefficients)]
    gradient = scored.agg(F.array(*parts, F.sum("r")).alias("g")).select(F.posexplode("g").alias("i", "g"))
    labels = F.array(*[F.lit(n) for n in [*names, "intercept"]])
    return gradient.select(
        F.get(labels, F.col("i")).alias("feature"), (F.round(F.col("g") / n_rows, 4) + 0.0).alias("gradient")
    )


def rf_scores(spark, folder):
    """Held-out scores; the probability must be what the saved nodes say, and better than chance."""
    trained = training.train(_features(spark, folder), models.random_forest())
    scored = training.held_out_scores(trained)
    walked = checks.walked_probability(models.predict(trained.model, trained.test), trained.model)
    beats = (checks.plain_auc(scored) > checks.LEAST_AUC).alias("beats_chance")
    same = scored.select("policy_num", "p").join(walked, "policy_num").select(
        "policy_num", (F.abs(F.col("p") - F.col("walked_p")) < 1e-9).alias("p_is_walked")
    )
    return _held_out(scored).join(same, "policy_num").select("*", beats)


def _trained_forest(spark, folder):
    trained = training.train(_features(spark, folder), models.random_forest())
    return trained, explain_held_out(trained)


def shap_additivity(spark, folder):
    trained, explained = _trained_forest(spark, folder)
    return checks.contribution_checks(explained["contributions"], trained.model)


def forest_importance(spark, folder):
    """Every input of the model, categories included, has one importance."""
    trained, explained = _trained_forest(spark, folder)
    return checks.importance_checks(
        explained["contributions"], explained["importance"], models.feature_names(trained.model)
    )


def riskiest_factors(spark, folder):
    """Five factors of the policy of the highest score, each rank once, strongest first, none of them zero."""
    _, explained = _trained_forest(spark, folder)
    highest = explained["contributions"].agg(F.max("churn_probability")).scalar()
    risky = explained["contributions"].where(F.col("churn_probability") == highest).agg(F.min("policy_num")).scalar()
    return explained["riskiest"].agg(
        F.count("*").alias("n_factors"),
        (F.min("policy_num") == risky).alias("is_riskiest"),
        F.count_distinct("feature").alias("n_features"),
        (F.max_by(F.abs("shap_value"), "rank") <= F.min_by(F.abs("shap_value"), "rank")).alias("strongest_first"),
        (F.min(F.abs("shap_value")) > 0).alias("all_matter"),
    )


def _segmented(spark, folder):
    stored = durable(_features(spark, folder), "features", key="policy_num")
    model = segments.fit_segments(stored)
    labelled = durable(segments.label_segments(segments.assign_segments(model, stored)), "segments")
    return labelled, model


def segments_of_book(spark, folder):
    """Every policy has a name and is at its nearest centre."""
    labelled, model = _segmented(spark, folder)
    named = labelled.select("policy_num", F.col("segment_label").isin(*SEGMENT_NAMES).alias("is_named"))
    return named.join(checks.cluster_checks(labelled, model).select("policy_num", "at_nearest"), "policy_num")


def segment_centres(spark, folder):
    """Centres are the means of their members and explain a part of the spread."""
    labelled, model = _segmented(spark, folder)
    return checks.centre_checks(checks.cluster_checks(labelled, model), model)


def score_batch(spark, folder):
    """The stored batch against its own sources, derived once more per policy."""
    tables = billing_tables(spark, folder)
    trained = training.train(build_feature_table(tables), models.random_forest())
    active = durable(build_active_feature_table(tables), "to-score", key="policy_num")
    batch = scoring.score_policies(trained.model, active, scored_at=stand_ins.BATCHES[0][0])
    explained = attribution.with_contributions(models.predict(trained.model, active), trained.model)
    labelled = segments.label_segments(segments.assign_segments(segments.fit_segments(active), active))
    return shown(
        checks.batch_checks(
            batch.scores,
            explained.select("policy_num", "churn_probability", "contributions"),
            labelled,
            models.feature_names(trained.model),
        )
    )


def evaluation_bundle(spark, folder):
    """Every metric of the sweep, recounted from the held-out scores."""
    result = training.full_evaluation(_features(spark, folder))
    return shown(checks.sweep_checks(result.tables["threshold_sweep"], result.scores))


# --- what the jobs write, read back ------------------------------------------------------------


def _store(spark: SparkSession) -> str:
    return scratch_path(spark, "store")


def csv_round_trip(spark, folder):
    """The four tables written as CSV files and read by the typed reader."""
    files, found = scratch_path(spark, "csv"), None
    for name, table in billing_tables(spark, folder).items():
        table.write.option("header", True).csv(f"{files}/{S.SOURCE_NAMES[name]}.csv")
        back = read_csv_table(spark, files, name)
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in back.columns]
        rows = back.select(
            F.lit(name).alias("table_name"), F.col(S.PRIMARY_KEYS[name][0]).alias("key"), F.concat_ws("|", *texts).alias("row")
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def seed_quarantine(spark, folder):
    """Payments of invoices that are not loaded yet are kept apart, the others are loaded."""
    store = _store(spark)
    tables = {**billing_tables(spark, folder), S.INVOICE: _settled_invoices(spark, folder)}
    for name in S.LOAD_ORDER:
        seeding.merge_file(spark, store, name, tables[name], "quarantine")
    loaded = store_tables.read_table(spark, store, S.PAYHISTORY).select("transaction_id", F.lit(False).alias("is_quarantined"))
    kept = store_tables.read_table(spark, f"{store}/quarantine", S.PAYHISTORY)
    return loaded.unionByName(kept.select("transaction_id", F.lit(True).alias("is_quarantined")))


def saved_evaluation(spark, folder):
    """The saved sweep of the stand-in score, read back from its file."""
    scored = _scored(spark, folder).select("policy_num", "y", "p")
    paths = store_tables.save_evaluation(training.evaluate_scores(scored), _store(spark))
    schema = "threshold double, precision double, recall double, f1 double, roc_auc double, pr_auc double"
    cells = ", ".join(f"{c} bigint" for c in M.CELLS)
    back = spark.read.schema(f"{schema}, {cells}, expected_cost double").option("header", True).option("enforceSchema", False)
    return shown(back.csv(paths["threshold_sweep"]))


def saved_calibration(spark, folder):
    """The saved calibration of the stand-in score, read back from its file."""
    scored = _scored(spark, folder).select("policy_num", "y", "p")
    paths = store_tables.save_evaluation(training.evaluate_scores(scored), _store(spark))
    schema = "mean_predicted_probability double, observed_churn_rate double"
    return shown(spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(paths["calibration"]))


def saved_report(spark, folder):
    """The JSON report of the stand-in score: the metrics at 0.5 and at the cheapest threshold."""
    scored = _scored(spark, folder).select("policy_num", "y", "p")
    paths = store_tables.save_evaluation(training.evaluate_scores(scored), _store(spark))
    back = spark.read.json(paths["report"])
    names = ["threshold", "precision", "recall", "f1", "roc_auc", "pr_auc", *M.CELLS]
    found = None
    for kind in ("default_threshold", "cost_weighted"):
        row = back.select(F.lit(kind).alias("kind"), "cost_weighted_threshold", *[F.col(f"{kind}_metrics.{n}") for n in names])
        found = row if found is None else found.unionByName(row)
    return shown(found)


def profile_csv(spark, folder):
    """The hidden profile written as CSV and read by its reader."""
    path = f"{scratch_path(spark, 'profile')}.csv"
    hidden_profile(spark, folder).write.option("header", True).csv(path)
    return read_hidden_profile(spark, path)


def stream_seed(spark, folder):
    """Customers and policies that arrive as files of a stream, which runs twice with one checkpoint.

    First come half of the customers and all policies, so the other policies are kept back; then
    come all customers, half of them again, and all policies again, which load what was kept back."""
    base = scratch_path(spark, "stream")
    files, store, checkpoint = (f"{base}/{part}" for part in ("files", "store", "checkpoint"))
    billing = billing_tables(spark, folder)
    early = F.pmod(F.col("customer_id").cast("bigint"), F.lit(2)) == 0
    for customers in (billing[S.CUSTOMER].where(early), billing[S.CUSTOMER]):
        for name, rows in ((S.CUSTOMER, customers), (S.POLICIES, billing[S.POLICIES])):
            rows.write.mode("append").option("header", True).csv(f"{files}/{name}")
        stream_all(spark, files, store, checkpoint, "quarantine", tables=(S.CUSTOMER, S.POLICIES))
    found = None
    for label, where, name in (("customer", store, S.CUSTOMER), ("policies", store, S.POLICIES), ("quarantine", f"{store}/quarantine", S.POLICIES)):
        back = store_tables.read_table(spark, where, name)
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in back.columns]
        rows = back.select(F.lit(label).alias("table_name"), F.col(S.PRIMARY_KEYS[name][0]).alias("key"), F.concat_ws("|", *texts).alias("row"))
        found = rows if found is None else found.unionByName(rows)
    return found


def saved_importance(spark, folder):
    importance = attribution.feature_importance(_explained(spark, folder), S.BEHAVIOUR_FEATURES)
    path = store_tables.save_feature_importance(importance, _store(spark))
    return shown(spark.read.schema("feature string, mean_abs_shap_value double").option("header", True).csv(path))


def batch_importance(spark, folder):
    """The importance that a scoring run saves has every input of the model, the strongest first."""
    tables, store = billing_tables(spark, folder), _store(spark)
    trained = training.train(build_feature_table(tables), models.random_forest(n_trees=20))
    model_path = store_tables.save_model(trained.model, f"{store}/model")
    added, _ = scoring.run_batch_scoring(spark, tables, model_path, store, stand_ins.BATCHES[0][0])
    back = spark.read.schema("feature string, mean_abs_shap_value double").option("header", True).csv(f"{store}/feature_importance")
    some = back.agg(F.max("mean_abs_shap_value") > 0).scalar()
    return back.select("feature", F.col("mean_abs_shap_value").between(0, 1).alias("in_range"), some.alias("some_matter"), F.lit(added).alias("n_scored"))


def report_files(spark, folder):
    """The report's detail table, read back from its file."""
    path = report.build_report(_latest(spark, folder), _store(spark))
    back = spark.read.option("header", True).csv(f"{path}/policy_detail")
    return shown(back.withColumn("Churn Risk", F.col("`Churn Risk`").cast("double")))


def report_summaries(spark, folder):
    """The report's three small tables, read back from the files of the report of one day."""
    path = report.build_report(_latest(spark, folder), _store(spark), stand_ins.BATCHES[-1][0].date())
    found = None
    for name in ("headline", "segment_counts", "action_counts"):
        back = spark.read.option("header", True).csv(f"{path}/{name}")
        label, value = back.columns
        rows = back.select(
            F.lit(path.rsplit("/", 1)[1]).alias("report"), F.lit(name).alias("table_name"), F.col(f"`{label}`").alias("label"), F.col(f"`{value}`").alias("value")
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def factors_json(spark, folder):
    """The factor lists of the latest batch as JSON text and back."""
    texts = _latest(spark, folder).select("policy_num", factors_to_json(F.col("top_factors")).alias("j"))
    lists = texts.select("policy_num", factors_from_json(F.col("j")).alias("f"))
    return shown(lists.select("policy_num", F.size("f").alias("n_factors"), F.col("f")[0]["feature"].alias("lead_feature"), F.col("f")[0]["value"].alias("lead_value")))


QUERIES: dict[str, Query] = {
    "normalize_dates": normalize_dates,
    "upsert_new_keys": upsert_new_keys,
    "fk_orphans": fk_orphans,
    "seed_counts": seed_counts,
    "payment_days_late": payment_days_late,
    "invoice_summary": invoice_summary,
    "missed_invoices": missed_invoices,
    "policy_features": policy_features,
    "trend_delta": trend_delta,
    "policy_static": policy_static,
    "feature_table": feature_table,
    "active_policies": active_policies,
    "eda_table_counts": _profile("table_counts"),
    "eda_class_balance": _profile("class_balance"),
    "eda_payment_status": _profile("payment_status"),
    "eda_payment_status_all": eda_payment_status_all,
    "eda_missed_by_status": _profile("missed_by_status"),
    "eda_policies_per_customer": _profile("policies_per_customer"),
    "eda_products": _profile("products"),
    "eda_frequencies": _profile("frequencies"),
    "confusion": confusion,
    "metrics": metrics,
    "roc_auc": roc_auc,
    "pr_auc": pr_auc,
    "calibration": calibration,
    "threshold_sweep": threshold_sweep,
    "cost_threshold": cost_threshold,
    "class_weights": class_weights,
    "stratified_split": stratified_split,
    "label_clusters": label_clusters,
    "segment_vs_profile": segment_vs_profile,
    "segment_profile_all": segment_profile_all,
    "profile_coverage": profile_coverage,
    "adjusted_rand": adjusted_rand,
    "top_factors": top_factors,
    "feature_importance": feature_importance,
    "riskiest_policy": riskiest_policy,
    "recommend_action": recommend_action,
    "describe_factors": describe_factors,
    "risk_history": risk_history,
    "risk_trend": risk_trend,
    "latest_scores": latest_scores,
    "policy_detail": policy_detail,
    "segment_counts": segment_counts,
    "action_counts": action_counts,
    "summary_headline": summary_headline,
    "standardize": standardize,
    "one_hot": one_hot,
    "lr_scores": lr_scores,
    "lr_optimum": lr_optimum,
    "rf_scores": rf_scores,
    "shap_additivity": shap_additivity,
    "forest_importance": forest_importance,
    "riskiest_factors": riskiest_factors,
    "segments": segments_of_book,
    "segment_centres": segment_centres,
    "score_batch": score_batch,
    "evaluation_bundle": evaluation_bundle,
    "csv_round_trip": csv_round_trip,
    "seed_quarantine": seed_quarantine,
    "stream_seed": stream_seed,
    "profile_csv": profile_csv,
    "saved_evaluation": saved_evaluation,
    "saved_calibration": saved_calibration,
    "saved_report": saved_report,
    "saved_importance": saved_importance,
    "batch_importance": batch_importance,
    "report_files": report_files,
    "report_summaries": report_summaries,
    "factors_json": factors_json,
}
