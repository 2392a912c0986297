"""Command line of the jobs: ``spark-submit`` this package, or ``python -m tarmac``."""

from __future__ import annotations

import argparse
import sys
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tarmac.contract import FLIGHTS
from tarmac.operators.clean import project_cast
from tarmac.operators.vocabulary import MAX_SMALL_LABELS
from tarmac.operators.words import count_directory
from tarmac.plans import replay, training
from tarmac.plans.store import ModelStore, OneModel
from tarmac.session import build_session, delete_written
from tarmac.sources import files, streams
from tarmac.streaming import commits, scoring

ESTIMATORS = {
    "forest": lambda args: partial(training.forest, max_bins=args.max_bins),
    "logistic": lambda args: training.logistic,
}


def _train(spark: SparkSession, args: argparse.Namespace) -> None:
    records = files.read_csv(spark, args.data, max_columns=args.max_columns)
    typed = project_cast(records, keep=(args.key,) if args.key else ())
    trained = training.train(
        typed,
        ESTIMATORS[args.estimator](args),
        sample=args.sample,
        split=args.split,
        key=args.key,
        seed=args.seed,
        vocabulary_from=args.vocabulary_from,
        max_labels=args.max_labels,
        statistics_above=args.statistics_above,
    )
    if args.model:
        training.save_pipeline(trained.pipeline, args.model)
    if args.store:
        print(f"model version {ModelStore(spark, args.store).add(trained.pipeline)}")
    if args.vocabularies:
        training.save_vocabularies(
            trained.vocabulary, args.vocabularies, statistics=trained.statistics, max_labels=args.max_labels
        )
    if args.classifier:
        training.save_model(trained.model, args.classifier)
    if args.preview:
        encoded = trained.pipeline.transform(trained.train.limit(args.preview))
        encoded = encoded.select(*trained.train.columns, *FLIGHTS.indexes, FLIGHTS.vector)
        encoded.printSchema()
        encoded.show(args.preview, truncate=False)
    print(f"accuracy {trained.metrics['accuracy']} on {trained.metrics['n']} held-out rows")


def _topic(args: argparse.Namespace, name: str) -> streams.Topic:
    return streams.Topic(args.servers, name, tuple(tuple(o.split("=", 1)) for o in args.kafka_option))


def _open_lines(spark: SparkSession, args: argparse.Namespace):
    if args.servers:
        return streams.stream_topic(
            spark,
            _topic(args, args.topic),
            starting=args.starting,
            max_records=args.max_records,
            min_partitions=args.min_partitions,
            group_prefix=args.group_prefix,
        )
    return streams.stream_text(spark, args.lines, args.max_files)


def _score(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.store:
        models = ModelStore(spark, args.store)
    elif args.model:
        models = OneModel(training.load_pipeline(args.model), args.model)
    else:
        models = OneModel(training.pipeline_of(args.vocabularies, args.classifier), args.classifier)
    routed = scoring.route(_open_lines(spark, args), FLIGHTS, args.require_label)
    publish = partial(streams.publish, topic=_topic(args, args.to_topic)) if args.to_topic else None
    seconds = None if args.once else args.seconds
    if not args.dead:
        after = partial(_after_commit, show=args.show, publish=publish)
        commits.score_committed(routed, models, args.out, args.checkpoint, seconds, after).awaitTermination()
        return
    model = models.load(models.current())
    handle = scoring.score_routed(
        model, scoring.write_batch(args.out), scoring.write_batch(args.dead), args.show, publish=publish
    )
    scoring.each_batch(routed, handle, args.checkpoint, seconds).awaitTermination()


def _after_commit(rows: DataFrame, commit: dict, show: int, publish) -> None:
    good = rows.where("route = 'good'").drop("route", "missing", "value")
    if publish:
        publish(scoring.to_records(good))
    if show:
        good.show(show)
    print(f"batch {commit['batch']}: {commit['good']} scored by {commit['version']}, {commit['dead']} dead")


def _replay(spark: SparkSession, args: argparse.Namespace) -> None:
    seconds = None if args.once else args.seconds
    if args.index:  # in order, so a batch goes to the sink as one partition
        lines = replay.replay_in_order(spark, args.data, args.index, args.lines_per_interval)
        lines, seconds = lines.coalesce(1).select("value"), seconds or 0
    elif args.staged:
        stored = files.scan_lines(spark, args.data)
        lines = replay.replay(stored, args.staged, args.lines_per_file, args.files_per_interval)
    else:
        lines = files.stream_lines(spark, args.data, args.files_per_interval)
    if args.servers:
        query = streams.to_topic(lines, _topic(args, args.topic), args.checkpoint, seconds)
    else:
        query = streams.to_files(lines, args.out, args.checkpoint, seconds, fmt="text")
    if args.index:
        streams.drain(query)
    else:
        query.awaitTermination()


def _words(spark: SparkSession, args: argparse.Namespace) -> None:
    count_directory(spark, args.source, args.target)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tarmac")
    top.add_argument("--master", help="left to spark-submit by default")
    jobs = top.add_subparsers(dest="job", required=True)

    train = jobs.add_parser("train", help="train on a headered CSV and save the pipeline")
    train.add_argument("--data", required=True)
    train.add_argument("--model", help="save the pipeline here")
    train.add_argument("--store", help="add the pipeline to this folder of versions and put it in use")
    train.add_argument("--vocabularies", help="also save one indexer per categorical column here")
    train.add_argument("--estimator", choices=sorted(ESTIMATORS), default="forest")
    train.add_argument("--sample", type=float, default=0.3)
    train.add_argument("--split", type=float, default=0.7)
    train.add_argument("--key", help="column that decides sample and split; default is a random draw")
    train.add_argument("--seed", type=int, default=42)
    train.add_argument("--vocabulary-from", choices=("all", "train"), default="all")
    train.add_argument("--preview", type=int, default=0, help="print the schema and this many encoded training rows")
    train.add_argument("--classifier", help="also save the classifier alone here, for use with --vocabularies")
    train.add_argument("--max-bins", type=int, default=training.MAX_BINS, help="forest bins, raised to the vocabulary")
    train.add_argument(
        "--statistics-above", type=int, default=training.STATISTICS_ABOVE,
        help="a column with more labels becomes the mean of its label's rows, an ordered feature",
    )
    train.add_argument("--max-labels", type=int, default=MAX_SMALL_LABELS, help="labels of a column that the driver may hold")
    train.add_argument("--max-columns", type=int, default=files.MAX_COLUMNS, help="most fields of a CSV line")
    train.set_defaults(run=_train)

    score = jobs.add_parser("score", help="score a stream of CSV lines with a saved pipeline")
    saved = score.add_mutually_exclusive_group(required=True)
    saved.add_argument("--model", help="a saved pipeline")
    saved.add_argument("--store", help="a folder of versions; each batch takes the one in use when it begins")
    saved.add_argument("--vocabularies", help="separately saved vocabularies, with --classifier")
    score.add_argument("--classifier", help="a classifier saved alone")
    score.add_argument("--to-topic", help="also publish each prediction as JSON to this topic of --servers")
    score.add_argument("--min-partitions", type=int, help="least read tasks per micro-batch of a topic")
    score.add_argument("--group-prefix", help="prefix of the consumer group ids")
    score.add_argument("--out", required=True, help="folder for the predictions")
    score.add_argument(
        "--dead", help="folder for lines that cannot be scored; without it both outputs of a batch are committed to --out at once"
    )
    score.add_argument("--checkpoint", required=True)
    source = score.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--lines", help="folder of text files, instead of a topic")
    score.add_argument("--topic", default="planes")
    score.add_argument("--starting", default="latest")
    # a micro-batch is held while it is scored, so a backlog is taken in portions; nothing is left out
    score.add_argument("--max-records", type=int, default=10_000_000, help="records per micro-batch of a topic")
    score.add_argument("--max-files", type=int, default=1000, help="files per micro-batch of a folder")
    score.add_argument("--seconds", type=float, default=30, help="micro-batch interval")
    score.add_argument("--once", action="store_true", help="score what there is and stop")
    score.add_argument("--require-label", action="store_true", help="reject lines without a label")
    score.add_argument("--show", type=int, default=0, help="print this many rows and predictions of every micro-batch")
    score.set_defaults(run=_score)

    again = jobs.add_parser("replay", help="publish a stored CSV as a paced stream of lines")
    again.add_argument("--data", required=True)
    again.add_argument("--index", help="folder for an index of the lines: replay them in their order, by lines")
    again.add_argument("--lines-per-interval", type=int, default=1, help="lines per interval with --index")
    again.add_argument("--staged", help="folder for lines cut to --lines-per-file; default is to read the CSV as it is")
    again.add_argument("--checkpoint", required=True)
    target = again.add_mutually_exclusive_group(required=True)
    target.add_argument("--servers", help="Kafka bootstrap servers")
    target.add_argument("--out", help="folder of text files, instead of a topic")
    again.add_argument("--topic", default="planes")
    again.add_argument("--seconds", type=float, default=5, help="publishing interval")
    again.add_argument("--lines-per-file", type=int, default=1_000_000)
    again.add_argument("--files-per-interval", type=int, default=1)
    again.add_argument("--once", action="store_true", help="publish everything without pauses and stop")
    again.set_defaults(run=_replay)

    for job in (score, again):
        job.add_argument("--kafka-option", action="append", default=[], help="client setting as key=value, repeatable")

    words = jobs.add_parser("words", help="count the words of a folder of text files")
    words.add_argument("source")
    words.add_argument("target")
    words.set_defaults(run=_words)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(f"tarmac {args.job}", args.master)
    try:
        args.run(spark, args)
    finally:
        delete_written(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
