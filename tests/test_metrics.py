import random

import numpy as np
import pytest

from lapsewise.operators import agreement as A
from lapsewise.operators import metrics as M
from lapsewise.plans.training import evaluate_scores


def counts(spark, y, p):
    return M.score_counts(spark.createDataFrame(list(zip(y, map(float, p))), "y int, p double"))


def row(df):
    return df.collect()[0].asDict()


def test_perfect_scores(spark):
    got = row(M.compute_metrics(counts(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])))
    assert got == {"threshold": 0.5, "precision": 1, "recall": 1, "f1": 1, "roc_auc": 1, "pr_auc": 1}


def test_confusion_has_all_cells(spark):
    c = counts(spark, [0, 1, 0, 1], [0.6, 0.2, 0.3, 0.9])
    assert set(row(M.confusion_counts(c, 0.5)).values()) == {1}
    assert row(M.confusion_counts(c, 2.0)) == {
        "true_negative": 2, "false_positive": 0, "false_negative": 2, "true_positive": 0,
    }


def test_threshold_is_inclusive(spark):
    assert row(M.confusion_counts(counts(spark, [1], [0.5]), 0.5))["true_positive"] == 1


def test_higher_threshold_never_raises_recall(spark):
    rng = random.Random(1)
    c = counts(spark, [rng.randrange(2) for _ in range(200)], [rng.random() for _ in range(200)])
    recalls = [r.recall for r in M.threshold_sweep(c).collect()]
    assert len(recalls) == 19 and recalls == sorted(recalls, reverse=True)


def pairwise_auc(y, p):
    pos = [s for t, s in zip(y, p) if t]
    neg = [s for t, s in zip(y, p) if not t]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def step_precision(y, p):
    total, area, tp, seen = sum(y), 0.0, 0, 0
    for s in sorted(set(p), reverse=True):
        here = [t for t, q in zip(y, p) if q == s]
        tp, seen = tp + sum(here), seen + len(here)
        area += sum(here) / total * tp / seen
    return area


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_ranking_quality_against_all_pairs(spark, digits):
    rng = random.Random(digits)
    p = [round(rng.random() ** 3, digits) for _ in range(400)]
    y = [int(rng.random() < 0.2 + 0.5 * s) for s in p]
    got = row(M.ranking_quality(counts(spark, y, p)))
    assert got["roc_auc"] == pytest.approx(pairwise_auc(y, p), abs=1e-12)
    assert got["pr_auc"] == pytest.approx(step_precision(y, p), abs=1e-12)


def test_ranking_quality_with_one_class(spark):
    assert row(M.ranking_quality(counts(spark, [0, 0], [0.1, 0.2]))) == {"roc_auc": None, "pr_auc": 0.0}


@pytest.mark.parametrize("digits, n_bins", [(1, 10), (2, 5), (9, 10)])
def test_calibration_against_numpy(spark, digits, n_bins):
    rng = np.random.default_rng(digits)
    p = np.round(rng.random(300) ** 2, digits)
    y = (rng.random(300) < p).astype(int)
    edges = np.percentile(p, np.linspace(0, 1, n_bins + 1) * 100)
    bins = np.searchsorted(edges[1:-1], p)
    got = M.calibration_table(counts(spark, y.tolist(), p.tolist()), n_bins).collect()
    assert [r.bin for r in got] == sorted(set(bins.tolist()))
    for r in got:
        assert r.n_rows == (bins == r.bin).sum()
        assert r.mean_predicted_probability == pytest.approx(p[bins == r.bin].mean())
        assert r.observed_churn_rate == pytest.approx(y[bins == r.bin].mean())


def test_calibration_of_one_score(spark):
    assert len(M.calibration_table(counts(spark, [0, 1], [0.5, 0.5])).collect()) == 1


@pytest.mark.parametrize("costs, chosen", [((1, 20), 0.4), ((20, 1), 0.6)])
def test_costs_move_the_threshold(spark, costs, chosen):
    c = counts(spark, [0, 0, 1, 1], [0.3, 0.55, 0.45, 0.9])
    sweep = M.with_expected_cost(M.threshold_sweep(c, [0.4, 0.5, 0.6]), *costs)
    assert row(M.cheapest_threshold(sweep))["threshold"] == chosen


def test_tied_costs_take_the_first_listed(spark):
    c = counts(spark, [0, 1], [0.1, 0.9])
    sweep = M.with_expected_cost(M.threshold_sweep(c, [0.6, 0.2, 0.4]))
    assert [r.threshold for r in sweep.orderBy("position").collect()] == [0.6, 0.2, 0.4]
    assert row(M.cheapest_threshold(sweep))["threshold"] == 0.6


def test_evaluation_report_holds_both_operating_points(spark):
    scored = spark.createDataFrame([(0, 0.1), (0, 0.3), (1, 0.35), (1, 0.9)], "y int, p double")
    tables = evaluate_scores(scored)
    report = tables["report"].collect()[0]
    assert report.cost_weighted_threshold == pytest.approx(0.35)
    assert report.cost_weighted_metrics.recall == 1.0
    assert report.default_threshold_metrics.recall == 0.5
    assert tables["threshold_sweep"].count() == 19


def rand_index(left, right):
    from math import comb

    cells = {}
    for pair in zip(left, right):
        cells[pair] = cells.get(pair, 0) + 1
    both = sum(comb(n, 2) for n in cells.values())
    a = sum(comb(left.count(v), 2) for v in set(left))
    b = sum(comb(right.count(v), 2) for v in set(right))
    expected = a * b / comb(len(left), 2)
    return 1.0 if (a + b) / 2 == expected else (both - expected) / ((a + b) / 2 - expected)


@pytest.mark.parametrize("left, right", [
    ([0, 0, 1, 1], ["a", "a", "b", "b"]),
    ([0, 1, 0, 1], ["a", "a", "b", "b"]),
    ([0, 0, 0], ["a", "a", "a"]),
    ([0, 1, 2], ["a", "b", "c"]),
    ([0, 0, 1, 2, 2, 1, 0], ["a", "b", "b", "c", "c", "a", "a"]),
])
def test_adjusted_rand(spark, left, right):
    df = spark.createDataFrame(list(zip(left, right)), "l int, r string")
    got = A.adjusted_rand_index(df, "l", "r").collect()[0][0]
    assert got == pytest.approx(rand_index(left, right))
