"""Command line: `python -m skyledger.jobs <job> ...`, or the same through spark-submit.

Addresses of stores and brokers come from the arguments; `@NAME` in the value of an
`--option` is replaced by the environment variable of that name, so that a password need not be
on the command line.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from skyledger.operators import graph, landing, ml
from skyledger.plans import timing
from skyledger.session import build_session, discard_application_folder
from skyledger.sources import files, kafka, sinks
from skyledger.streaming import scorer


def parse_options(pairs: Sequence[str]) -> dict[str, str]:
    out = {}
    for pair in pairs:
        key, _, value = pair.partition("=")
        out[key] = os.environ[value[1:]] if value.startswith("@") else value
    return out


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    if not sinks.land_raw(spark, args.source, args.target):
        raise SystemExit(f"no such file: {args.source}")


def reports(spark: SparkSession, args: argparse.Namespace) -> None:
    options = parse_options(args.option)

    def target(name: str) -> dict[str, str]:
        return {**options, "path": f"{args.output}/{name}"} if args.output else options

    done = timing.run_reports(files.read_flights_csv(spark, args.input), target, args.format)
    failed = {name: rows for name, rows in done.items() if isinstance(rows, Exception)}
    for name, rows in done.items():
        print(f"{name}: {rows if name not in failed else 'failed'}")
    if failed:
        raise SystemExit(f"failed: {', '.join(failed)}")


def time(spark: SparkSession, args: argparse.Namespace) -> None:
    settings = [c for c in timing.CONFIGURATIONS if not args.config or c.name in args.config]
    sinks.show_top(timing.time_reports(
        spark, lambda: files.read_flights_csv(spark, args.input), settings), 100)


def rank(spark: SparkSession, args: argparse.Namespace) -> None:
    flights = files.read_flights_csv(spark, args.input)
    sinks.show_top(graph.graph_counts(flights))
    ranks = graph.pagerank(graph.flight_edges(flights))
    sinks.show_top(graph.top_airports_by_rank(ranks, args.top), args.top)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    flights = files.read_training_csv(spark, args.input, header=args.header)
    sinks.show_top(ml.class_distribution(ml.preprocess(flights, with_label=True)))
    ml.save_run(ml.train(flights, args.kind), args.run)
    run = ml.load_run(spark, args.run)
    scored = run.model.transform(run.test)
    metrics = ml.classification_metrics(scored)
    sinks.show_top(metrics)
    sinks.show_top(ml.confusion_matrix(scored))
    if args.kind == "forest":
        sinks.show_top(ml.feature_importance(run.model))
    ml.write_metadata(ml.model_metadata(run.model, metrics), f"{args.run}/metadata")


def _stored(spark: SparkSession, path: str) -> ml.Trained:
    run = ml.load_run(spark, path)
    if run is None:
        raise SystemExit(f"no trained run under {path}")
    return run


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    flights = files.read_training_csv(spark, args.input, header=args.header)
    model = _stored(spark, args.run).model
    scored = ml.score(flights, model, [*ml.RESULT_COLUMNS, "DepDelay"])
    if args.output:
        scored.write.mode("overwrite").parquet(args.output)
    else:
        sinks.show_top(scored)
        sinks.show_top(ml.class_probabilities(flights, model))


def _payloads(spark: SparkSession, path: str, with_delay: bool) -> tuple[DataFrame, DataFrame]:
    return landing.normalize_flights(files.read_flight_json(spark, path), with_delay)


def export(spark: SparkSession, args: argparse.Namespace) -> None:
    flights, rejected = _payloads(spark, args.input, with_delay=True)
    if args.rejects:
        rejected.write.mode("overwrite").json(args.rejects)
    print("exported" if sinks.export_csv(flights, args.output) else "no data to export")


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    flights, _ = _payloads(spark, args.input, with_delay=False)
    kafka.kafka_sink(
        kafka.to_kafka_json(flights), args.servers, args.topic,
        options=parse_options(args.option)).save()


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    model = _stored(spark, args.run).model
    if args.folder:
        values = scorer.json_stream(spark, args.folder)
    else:
        values = kafka.kafka_source(spark, args.servers, args.topic, parse_options(args.option))
    scored = scorer.score_stream(values, model)
    trigger = None if args.once else args.trigger
    if args.output:
        writer = scorer.file_sink(scored, args.output, args.checkpoint, trigger)
    else:
        writer = scorer.console_sink(scored, args.checkpoint, trigger)
    scorer.run_query(writer)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skyledger", description="flight analytics jobs")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(function, summary: str, *names: str) -> argparse.ArgumentParser:
        one = jobs.add_parser(function.__name__, help=summary)
        one.set_defaults(run_job=function)
        for name in names:
            one.add_argument(name)
        return one

    job(land, "copy a CSV file into the lake", "source", "target")
    one = job(reports, "write all eight reports", "input")
    one.add_argument("--output", help="folder of the reports")
    one.add_argument("--format", default="parquet")
    one.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    one = job(time, "time the reports under several settings", "input")
    one.add_argument("--config", action="append")
    one = job(rank, "count the airport graph and rank its airports", "input")
    one.add_argument("--top", type=int, default=10)
    one = job(train, "train, evaluate and store a classifier", "input", "run")
    one.add_argument("--kind", choices=["logistic", "forest"], default="forest")
    one.add_argument("--header", action="store_true", help="the files start with column names")
    one = job(score, "score flights with a stored classifier", "input", "run")
    one.add_argument("--output")
    one.add_argument("--header", action="store_true", help="the files start with column names")
    one = job(export, "turn landed payloads into a CSV table", "input", "output")
    one.add_argument("--rejects", help="folder of the records that cannot be used")
    one = job(publish, "send landed payloads to a Kafka topic as flights", "input")
    one.add_argument("--servers", required=True)
    one.add_argument("--topic", default="flights")
    one.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    one = job(stream, "score a Kafka topic or a folder of JSON lines", "run", "checkpoint")
    source = one.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers")
    source.add_argument("--folder")
    one.add_argument("--topic", default="flights")
    one.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    one.add_argument("--output", help="folder of the scores; printed when left out")
    one.add_argument("--trigger", default=scorer.TRIGGER)
    one.add_argument("--once", action="store_true", help="stop when the input is used up")
    return top


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    session = spark or build_session(f"skyledger {args.job}")
    try:
        args.run_job(session, args)
    finally:
        if spark is None:
            discard_application_folder(session)
            session.stop()


if __name__ == "__main__":
    main()
