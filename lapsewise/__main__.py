"""The jobs, for spark-submit or ``python -m lapsewise``:

    seed      merge new CSV files into the stored tables
    stream    the same from one folder per table, taking up only files not seen before
    profile   show the descriptive tables
    segments  show the risk segments of the whole book beside a known profile
    baseline  train the logistic regression, show its held-out precision, recall and ROC-AUC
    evaluate  train on all policies, save the model and its evaluation
    explain   train on all policies, show what drives the held-out scores
    score     score the active policies, add the batch to the history
    report    write the report tables of the latest batch

A job deletes its scratch tables when it ends.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from lapsewise import workspace
from lapsewise.operators import models
from lapsewise.plans import profile, report, scoring, seeding, segmentation, training
from lapsewise.plans.explanation import explain_held_out
from lapsewise.plans.features import build_feature_table
from lapsewise.sources.store import save_evaluation, save_model
from lapsewise.sources.tables import load_tables, read_hidden_profile
from lapsewise.streaming.seeding import stream_all


def seed(spark: SparkSession, args: argparse.Namespace) -> None:
    seeding.seed_all(spark, args.csv, args.store, args.on_orphan).show(truncate=False)


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    stream_all(spark, args.csv, args.store, args.checkpoint, args.on_orphan)


def show_profile(spark: SparkSession, args: argparse.Namespace) -> None:
    for name, table in profile.profile_tables(load_tables(spark, args.store)).items():
        print(name)
        table.show(truncate=False)


def show_segments(spark: SparkSession, args: argparse.Namespace) -> None:
    segmented = workspace.durable(segmentation.build_segments(load_tables(spark, args.store), args.k), "segments")
    known = read_hidden_profile(spark, args.profile)
    for name, table in segmentation.compare_to_profile(segmented, known).items():
        print(name)
        table.show(truncate=False)


def baseline(spark: SparkSession, args: argparse.Namespace) -> None:
    model, metrics = training.train_baseline(build_feature_table(load_tables(spark, args.store)))
    metrics.show(truncate=False)
    if args.model:
        save_model(model, args.model)


def evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    classifier = None if args.baseline else models.random_forest(args.trees, args.depth)
    table = build_feature_table(load_tables(spark, args.store))
    result = training.full_evaluation(table, classifier, args.cost_fp, args.cost_fn)
    save_model(result.model, args.model)
    for name, path in save_evaluation(result.tables, args.output).items():
        print(name, path)


def explain(spark: SparkSession, args: argparse.Namespace) -> None:
    table = build_feature_table(load_tables(spark, args.store))
    explained = explain_held_out(training.train(table, models.random_forest(args.trees, args.depth)))
    explained["importance"].show(truncate=False)
    explained["riskiest"].show(truncate=False)


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    added, _ = scoring.run_batch_scoring(
        spark, load_tables(spark, args.store), args.model, args.store
    )
    print(f"{added} policies scored")


def write_report(spark: SparkSession, args: argparse.Namespace) -> None:
    print(report.run_report(spark, args.store, args.output))


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser("lapsewise")
    jobs = root.add_subparsers(required=True)

    def job(name: str, run, *paths: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    for loading in (job("seed", seed, "csv", "store"), job("stream", stream, "csv", "store", "checkpoint")):
        loading.add_argument("--on-orphan", choices=("fail", "quarantine"), default="fail")
    job("profile", show_profile, "store")
    job("segments", show_segments, "store", "profile").add_argument("--k", type=int, default=3)
    job("baseline", baseline, "store").add_argument("--model", help="where to save the model")
    fit = job("evaluate", evaluate, "store", "model", "output")
    fit.add_argument("--baseline", action="store_true", help="logistic regression")
    why = job("explain", explain, "store")
    for sub in (fit, why):
        sub.add_argument("--trees", type=int, default=200)
        sub.add_argument("--depth", type=int, default=8, help="MLlib allows up to 30")
    fit.add_argument("--cost-fp", type=float, default=1.0)
    fit.add_argument("--cost-fn", type=float, default=5.0)
    job("score", score, "store", "model")
    job("report", write_report, "store", "output")
    return root


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("lapsewise").getOrCreate()
    with workspace.job(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
