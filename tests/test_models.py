import itertools
import math
import os
import subprocess
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lapsewise import schemas as S
from lapsewise.operators import attribution, models, segments
from lapsewise.operators.splitting import class_weight_table, class_weights, mark_test_rows, held_out_quota
from lapsewise.plans import training
from lapsewise.plans.explanation import explain_held_out
from lapsewise.sources.store import load_model, save_model
from tests.fixtures import one_driver
from verification.model_checks import WalkedNodes, walked_probability, walked_values

SMALL_FOREST = dict(n_trees=20, max_depth=4)


@pytest.fixture(scope="module")
def table(spark):
    return one_driver(spark).cache()


@pytest.fixture(scope="module")
def forest(table):
    return models.fit_classifier(table, models.random_forest(**SMALL_FOREST))


# --- split and weights


@pytest.mark.parametrize("sizes", [(80, 20), (7, 5), (33, 34), (6, 4)])
def test_split_keeps_class_shares(spark, sizes):
    rows = [(f"P{c}{i}", c) for c, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "policy_num string, is_churned int")
    first = mark_test_rows(df, 0.2, 42).collect()
    assert sorted(first) == sorted(mark_test_rows(df.orderBy(F.rand(1)), 0.2, 42).collect())
    held = [sum(r.is_test for r in first if r.is_churned == c) for c in (0, 1)]
    assert sum(held) == math.ceil(sum(sizes) * 0.2)
    assert all(abs(h - n * sum(held) / sum(sizes)) < 1 for h, n in zip(held, sizes))


def test_another_seed_is_another_split(spark):
    df = spark.createDataFrame([(f"P{i}", i % 2) for i in range(60)], "policy_num string, is_churned int")
    chosen = lambda seed: {r.policy_num for r in mark_test_rows(df, 0.2, seed).where("is_test").collect()}
    assert chosen(1) != chosen(2)


def test_split_needs_enough_rows():
    with pytest.raises(ValueError):
        held_out_quota({0: 10, 1: 1}, 0.2)


def test_balanced_weights(spark):
    assert class_weights({0: 3, 1: 1}) == {0: 4 / 6, 1: 2.0}
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "is_churned int")
    assert [(r[0], r[2]) for r in class_weight_table(df).collect()] == [(0, 4 / 6), (1, 2.0)]


# --- preprocessing


def matrix(model, df):
    rows = models.transform_features(model, df).select(vector_to_array("features")).collect()
    return np.array([r[0] for r in rows])


def test_numbers_have_population_deviation_one(table, forest):
    x = matrix(forest, table)[:, : len(S.BEHAVIOUR_FEATURES)]
    assert np.allclose(x.mean(axis=0), 0) and np.allclose(x.std(axis=0), 1)


def test_names_follow_the_vector(table, forest):
    names = models.feature_names(forest)
    assert names[8:] == [
        "insurance_product_Auto", "insurance_product_Home", "payment_frequency_Monthly", "payment_frequency_Quarterly",
    ]
    rows = models.transform_features(forest, table).collect()
    for r in rows:
        x = dict(zip(names, r.features.toArray()))
        assert x[f"insurance_product_{r.insurance_product}"] == 1.0
        assert sum(x[n] for n in names if n.startswith("insurance_product_")) == 1.0


def test_unknown_category_is_all_zeros(table, forest):
    odd = table.limit(1).withColumn("insurance_product", F.lit("Boat")).withColumn(
        "payment_frequency", F.lit(None).cast("string")
    )
    assert matrix(forest, odd)[0, 8:].tolist() == [0, 0, 0, 0]
    assert models.predict(forest, odd).collect()[0].churn_probability >= 0


def test_unknown_tenure_fails_loudly(table, forest):
    with pytest.raises(Exception, match="(?i)null"):
        models.predict(forest, table.withColumn("tenure_days", F.lit(None).cast("double"))).collect()


def test_a_column_of_mostly_distinct_values_is_no_category(spark):
    df = spark.range(20_000).selectExpr("cast(id AS string) insurance_product", "'Monthly' payment_frequency")
    with pytest.raises(ValueError, match="insurance_product has 20000 values"):
        models.check_categories(df, most=19_999)
    models.check_categories(df, most=20_000)


def test_fifty_thousand_categories_are_encoded(spark):
    numbers = ", ".join(f"cast(id % {7 + i} AS double) AS {c}" for i, c in enumerate(S.BEHAVIOUR_FEATURES))
    df = spark.range(50_000).selectExpr("cast(id AS string) insurance_product", "'Monthly' payment_frequency", *numbers.split(", "))
    models.check_categories(df)
    fitted = Pipeline(stages=models.preprocessing(50_000)).fit(df)
    got = fitted.transform(df).select("insurance_product", "features").where("insurance_product = '777'").head()["features"]
    assert got.size == len(S.BEHAVIOUR_FEATURES) + 50_001
    flags = [i for i, v in zip(got.indices, got.values) if i >= len(S.BEHAVIOUR_FEATURES) and v == 1.0]
    assert len(flags) == 2


def test_newton_steps_settle_in_few_passes(spark, table, monkeypatch):
    passes = []
    whole = models.derivatives
    monkeypatch.setattr(models, "derivatives", lambda *args: passes.append(1) or whole(*args))
    model = models.fit_classifier(table)
    assert 2 < len(passes) < 12
    assert abs(model.stages[-1].intercept) < 1e3


def test_all_starts_move_in_the_same_pass(spark, monkeypatch):
    """Three separate groups: every start finds them, each pass is one job for all starts."""
    df = behaviour_rows(spark, [(30, 0.0), (30, 5.0), (30, 9.0)])
    steps = []
    whole = segments.move_centres
    monkeypatch.setattr(segments, "move_centres", lambda vectors, centres: steps.append(len(centres)) or whole(vectors, centres))
    got = segments.assign_segments(segments.fit_segments(df, 3), df).collect()
    groups = {g: {r.cluster for r in got if r.policy_num.startswith(f"P{g}")} for g in "012"}
    assert all(len(c) == 1 for c in groups.values()) and len(set.union(*groups.values())) == 3
    assert steps[0] == 10 and len(steps) < 30


def test_a_step_of_several_sets_equals_plain_lloyd(spark):
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(200, 3))
    centres = rng.normal(size=(4, 3, 3))
    df = spark.createDataFrame([(r.tolist(),) for r in rows], "z array<double>").repartition(3)
    moved, costs = segments.move_centres(df, centres)
    for i in range(4):
        apart = ((rows[:, None] - centres[i]) ** 2).sum(axis=2)
        near = apart.argmin(axis=1)
        assert np.isclose(costs[i], apart.min(axis=1).sum())
        for c in range(3):
            wanted = rows[near == c].mean(axis=0) if (near == c).any() else centres[i][c]
            assert np.allclose(moved[i][c], wanted)


def test_standardized_matches_numpy(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 4.0, 5.0), ("c", 7.0, 5.0)], "policy_num string, x double, y double")
    got = models.standardized(df, ["x", "y"]).orderBy("policy_num").collect()
    x = np.array([1.0, 4.0, 7.0])
    assert np.allclose([r.x for r in got], (x - x.mean()) / x.std())
    assert [r.y for r in got] == [0, 0, 0]


# --- classifiers


def test_logistic_regression_minimises_the_balanced_penalised_loss(table):
    """Newton's method on 1/2 |w|^2 + sum of weighted losses, intercept unpenalised."""
    sample = table.where("policy_num < 'P030'")  # unbalanced classes: 20 and 10
    model = models.fit_classifier(sample)
    x = matrix(model, sample)
    y = np.array([r.is_churned for r in sample.collect()], dtype=float)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    design = np.hstack([x, np.ones((len(y), 1))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (weight * (p - y)) + penalty @ beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + penalty
        beta -= np.linalg.solve(hessian, gradient)
    fitted = model.stages[-1]
    assert np.allclose([*fitted.coefficients, fitted.intercept], beta, atol=1e-4)


def test_baseline_separates_separable_rows(table):
    _, metrics = training.train_baseline(table)
    got = metrics.collect()[0]
    assert (got.precision, got.roc_auc) == (1.0, 1.0) and 0 < got.recall <= 1


def test_full_evaluation_of_a_forest(table):
    result = training.full_evaluation(table, models.random_forest(**SMALL_FOREST))
    report = result.tables["report"].collect()[0]
    assert report.default_threshold_metrics.roc_auc == 1.0
    assert 0.05 <= report.cost_weighted_threshold <= 0.95
    assert result.scores.count() == 8
    assert result.tables["calibration"].columns == ["mean_predicted_probability", "observed_churn_rate"]


def test_saved_model_predicts_the_same(table, forest, tmp_path):
    again = load_model(save_model(forest, str(tmp_path / "model")))
    read = lambda m: [r.churn_probability for r in models.predict(m, table).orderBy("policy_num").collect()]
    assert read(again) == read(forest)


def test_rows_are_walked_down_every_tree_where_they_lie(table, forest, capsys):
    scored = models.predict(forest, table.unionByName(table.limit(3)))
    walked = walked_probability(scored, forest)
    walked.explain()
    assert "Join" not in capsys.readouterr().out
    expected = {r.policy_num: r.churn_probability for r in scored.collect()}
    found = {r.policy_num: r.walked_p for r in walked.collect()}
    assert len(expected) == 40 and found == pytest.approx(expected, abs=1e-12)


def test_the_walk_follows_splits_by_category():
    nodes = WalkedNodes(
        roots=np.array([0, 3]), feature=np.array([0, 0, 0, 1, 0, 0]), threshold=np.array([1.0, np.nan, np.nan, 0.5, np.nan, np.nan]),
        left=np.array([1, 1, 2, 4, 4, 5]), right=np.array([2, 1, 2, 5, 4, 5]), value=np.array([0, 0.2, 0.6, 0, 0.4, 0.8]),
        category_row=np.array([0, -1, -1, -1, -1, -1]), goes_left=np.array([[False, True, False, True, False]]),
    )
    x = np.array([[1.0, 0.5], [3.0, 0.6], [0.0, 0.0], [2.0, 9.0], [9.0, 0.0]])
    assert walked_values(x, nodes, 1) == pytest.approx([0.3, 0.5, 0.5, 0.7, 0.5])


# --- attribution


def test_contributions_add_up_to_the_probability(table, forest):
    explained = attribution.with_contributions(models.predict(forest, table), forest).collect()
    assert len(explained) == 40
    for r in explained:
        assert r.base_value + sum(r.contributions) == pytest.approx(r.churn_probability, abs=1e-12)


def test_contributions_of_many_rows_are_looked_up_by_their_outcomes(table, forest, spark, monkeypatch):
    """Leaves are worked out once per outcome of their tests, with the bits that each row alone gets."""
    leaves = [tuple(g) for group in attribution.forest_leaves(forest, spark) for g in group]
    x = np.random.default_rng(3).normal(size=(300, len(models.feature_names(forest))))
    alone = np.concatenate([attribution.contributions_of(x[i : i + 1], leaves) for i in range(len(x))])
    widths, plain = [], attribution._slot_values
    monkeypatch.setattr(attribution, "_slot_values", lambda met, *rest: widths.append(met[0].shape[-1]) or plain(met, *rest))
    assert np.array_equal(attribution.contributions_of(x, leaves), alone)
    assert max(widths) <= 2**4 and np.abs(alone).max() > 0


def test_a_forest_is_read_one_tree_at_a_time(spark, table, forest):
    """Nodes as objects take some 2 kB each: only those of one tree may be there at once."""
    rows = table.crossJoin(spark.range(40)).withColumn(S.LABEL, (F.rand(99) < 0.5).cast("int"))
    rows = rows.select("policy_num", S.LABEL, *[(F.rand(i) * 9).alias(c) for i, c in enumerate(S.BEHAVIOUR_FEATURES)], *S.CATEGORICAL_FEATURES)
    fitted = models.fit_classifier(rows, models.random_forest(n_trees=40))
    n_nodes = sum(tree.numNodes for tree in fitted.stages[-1].trees)
    list(attribution.forest_leaves(forest, spark))  # so that only the forest counts
    tracemalloc.start()
    try:
        leaves = [g for group in attribution.forest_leaves(fitted, spark) for g in group]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(len(g.value) for g in leaves) == (n_nodes + 40) // 2 and n_nodes > 4000
    assert most < 1000 * n_nodes


def expected_output(nodes, row, known, at=0):
    """Mean leaf value when only the ``known`` features are followed."""
    node = nodes[at]
    if node["leftChild"] < 0:
        return node["impurityStats"][1] / sum(node["impurityStats"])
    feature, split = node["split"]["featureIndex"], node["split"]
    left, right = node["leftChild"], node["rightChild"]
    if feature in known:
        if split["numCategories"] == -1:
            goes_left = row[feature] <= split["leftCategoriesOrThreshold"][0]
        else:
            goes_left = row[feature] in split["leftCategoriesOrThreshold"]
        return expected_output(nodes, row, known, left if goes_left else right)
    weights = [sum(nodes[c]["impurityStats"]) for c in (left, right)]
    values = [expected_output(nodes, row, known, c) for c in (left, right)]
    return np.dot(weights, values) / sum(weights)


def test_contributions_are_shapley_values(spark, table, tmp_path):
    """Against the definition: every subset of the features that the trees use."""
    noisy = table.withColumn("is_churned", (F.hash("policy_num") % 2 == 0).cast("int"))
    model = models.fit_classifier(noisy, models.random_forest(n_trees=3, max_depth=4))
    path = str(tmp_path / "forest")
    model.stages[-1].write().save(path)
    trees = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        trees.setdefault(r.treeID, {})[r.nodeData.id] = r.nodeData.asDict(recursive=True)
    explained = attribution.with_contributions(models.predict(model, noisy), model)
    categorical = False
    for r in explained.limit(6).collect():
        x = r.features.toArray()
        wanted = np.zeros(len(x))
        for nodes in trees.values():
            used = sorted({n["split"]["featureIndex"] for n in nodes.values() if n["leftChild"] >= 0})
            categorical |= any(f >= len(S.BEHAVIOUR_FEATURES) for f in used)
            for j in used:
                others = [f for f in used if f != j]
                for size in range(len(others) + 1):
                    share = math.factorial(size) * math.factorial(len(used) - size - 1) / math.factorial(len(used))
                    for subset in itertools.combinations(others, size):
                        gain = expected_output(nodes, x, {*subset, j}) - expected_output(nodes, x, set(subset))
                        wanted[j] += share * gain / len(trees)
        assert np.allclose(r.contributions, wanted, atol=1e-12)
    assert categorical, "the trees should also split on a category"


def test_the_real_driver_ranks_first(table, forest):
    names = models.feature_names(forest)
    explained = attribution.with_contributions(models.predict(forest, table), forest).cache()
    importance = attribution.feature_importance(explained, names).collect()
    assert importance[0].feature == "failed_invoice_ratio"
    assert len(importance) == len(names)
    assert [r[1] for r in importance] == sorted((r[1] for r in importance), reverse=True)
    riskiest = attribution.riskiest_policy(explained)
    ranked = attribution.ranked_factors(explained.join(riskiest.select("policy_num"), "policy_num"), names, 5)
    first = ranked.orderBy("rank").collect()
    assert [r.rank for r in first] == [1, 2, 3, 4, 5]
    assert (first[0].feature, first[0].shap_value > 0) == ("failed_invoice_ratio", True)


def test_held_out_explanation(table):
    trained = training.train(table, models.random_forest(**SMALL_FOREST))
    explained = explain_held_out(trained)
    assert explained["contributions"].count() == trained.test.count() == 8
    assert explained["importance"].collect()[0].feature == "failed_invoice_ratio"
    riskiest = explained["riskiest"].collect()
    best = explained["contributions"].orderBy(F.desc("churn_probability"), "policy_num").head().policy_num
    assert [(r.policy_num, r.rank) for r in riskiest] == [(best, i) for i in range(1, 6)]


def test_importance_is_the_mean_magnitude(spark):
    df = spark.createDataFrame([([5.0, 1.0],), ([-5.0, 1.0],)], "contributions array<double>")
    assert [tuple(r) for r in attribution.feature_importance(df, ["a", "b"]).collect()] == [("a", 5.0), ("b", 1.0)]


# --- segments


def behaviour_rows(spark, groups):
    rows = []
    for g, (n, level) in enumerate(groups):
        rows += [(f"P{g}{i}", *[level + i / 1000] * 8) for i in range(n)]
    return spark.createDataFrame(rows, "policy_num string, " + ", ".join(f"{c} double" for c in S.BEHAVIOUR_FEATURES))


def test_clean_and_risky_policies_form_pure_clusters(spark):
    df = behaviour_rows(spark, [(4, 0.0), (4, 0.9)])
    got = segments.assign_segments(segments.fit_segments(df, 2), df).collect()
    clusters = {g: {r.cluster for r in got if r.policy_num.startswith(f"P{g}")} for g in "01"}
    assert len(clusters["0"]) == len(clusters["1"]) == 1 and clusters["0"] != clusters["1"]


def even_behaviours(spark, n_rows):
    columns = [((F.col("id") * p % 9973) / 9973 + F.col("id") % 7).alias(c) for p, c in zip((31, 37, 41, 43, 47, 53, 59, 61), S.BEHAVIOUR_FEATURES)]
    return spark.range(n_rows).select(F.col("id").cast("string").alias("policy_num"), *columns)


@pytest.mark.parametrize("repeated", [0, 900, 3000])
def test_the_rows_of_the_smallest_hashes_are_drawn(spark, repeated):
    numbers = F.when(F.col("id") < repeated, 0).otherwise(F.col("id")).cast("double")
    rows = spark.range(3000).select(F.array(numbers, numbers * 2).alias("z")).withColumn("hash", F.xxhash64("z")).repartition(5)
    plain = sorted((r["hash"], r["z"]) for r in rows.collect())[:100]
    assert segments.drawn_rows(rows, 3000, 100).tolist() == [z for _, z in plain]
    assert segments.drawn_rows(rows, 3000, 5000).shape == (3000, 2)


def test_the_same_rows_are_drawn_however_they_lie(spark, monkeypatch):
    """The scaler's sums differ in their last digits with the parts they come from; the draw may not."""
    samples, parts, whole = [], [], segments.best_centres

    def kept(vectors, sample, *rest):
        samples.append(sample)
        parts.append(vectors.rdd.getNumPartitions())
        return whole(vectors, sample, *rest)

    monkeypatch.setattr(segments, "best_centres", kept)
    for n in (2, 9, 23):
        segments.fit_segments(even_behaviours(spark, 2000).repartition(n, "policy_num"), most_steps=1, starts=1)
    assert all(np.allclose(s, samples[0], rtol=0, atol=1e-9) for s in samples)
    # a pass has no more tasks than the cores are worth
    assert max(parts) <= spark.sparkContext.defaultParallelism


_SMALL_RESULTS = """
from pyspark.sql import SparkSession
from lapsewise.operators import segments
from tests.test_models import even_behaviours

conf = {"spark.master": "local[2]", "spark.ui.enabled": "false", "spark.driver.maxResultSize": "2m", "spark.sql.shuffle.partitions": "2"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
segments.fit_segments(even_behaviours(spark, 40_000).repartition(16), most_steps=1, starts=1)
"""


def test_the_driver_gets_the_drawn_rows_only(tmp_path):
    """40,000 rows in 16 parts: each part's smallest hashes together would be 4 MB."""
    env = {**os.environ, "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    run = subprocess.run([sys.executable, "-c", _SMALL_RESULTS], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]


def test_clusters_are_named_by_severity(spark):
    rows = [(0, 0.9), (0, 0.8), (1, 0.0), (1, 0.1), (2, 0.4)]
    df = spark.createDataFrame(rows, "cluster int, failed_invoice_ratio double")
    named = {r.cluster: r.segment_label for r in segments.label_segments(df).collect()}
    assert named == {1: "Low risk", 2: "Medium risk", 0: "High risk"}


def test_two_and_five_clusters(spark):
    df = spark.createDataFrame([(c, c / 10) for c in range(5)], "cluster int, failed_invoice_ratio double")
    names = lambda d: [r.segment_label for r in segments.label_segments(d).orderBy("cluster").collect()]
    assert names(df) == ["Low risk", "Medium risk", "High risk", "Risk tier 3", "Risk tier 4"]
    assert names(df.where("cluster < 2")) == ["Low risk", "Medium risk"]


def test_too_few_policies_for_the_segments(spark):
    with pytest.raises(ValueError, match="2 policies"):
        segments.fit_segments(behaviour_rows(spark, [(2, 0.1)]), 3)
