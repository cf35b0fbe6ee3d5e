"""Jobs for spark-submit: ``spark-submit -m cartlake <job> ...`` or, locally,
``python -m cartlake <job> ...``."""

import argparse

from pyspark.sql import SparkSession

from cartlake.operators import learning, serving
from cartlake.operators.silver import silver_events
from cartlake.plans import campaign, medallion
from cartlake.session import remove_staged, stage, use_utc
from cartlake.sources import files, sinks, topics
from cartlake.sources.jdbc import Database
from cartlake.sources.log import BUCKETS
from cartlake.streaming import clock, jobs
from cartlake.streaming.views import LiveGold


def run_medallion(spark, args, lake):
    medallion.medallion(spark, args.csv, lake, normalize=args.normalize, dedup=args.dedup)


def run_campaign(spark, args, lake):
    report = campaign.run_campaign(spark, lake, args.model)
    for name in ("uniques", "carts", "journey", "models", "coupons", "gmv"):
        getattr(report, name).show(truncate=False)


def run_serving(spark, args, lake):
    database = Database(args.jdbc, dict(o.split("=", 1) for o in args.option)) if args.jdbc else None
    medallion.populate_serving(spark, lake, args.batch, args.model, database)


def run_listing(spark, args, lake):
    """Show the newest prescriptions, from the database if one is named."""
    if args.jdbc:
        database = Database(args.jdbc, dict(o.split("=", 1) for o in args.option))
        features, prescriptions = (database.read(spark, name, "user_id") for name in medallion.SERVING_TABLES)
    else:
        features, prescriptions = (sinks.read_latest(spark, f"{lake.serving}/{name}", "session_id") for name in medallion.SERVING_TABLES)
    newest = serving.latest_prescriptions(prescriptions, features, args.rows)
    serving.formatted_prescriptions(newest).orderBy("position").show(args.rows, truncate=False)


def run_dashboard(spark, args, lake):
    medallion.publish_dashboard(spark, lake, args.out)


def run_train(spark, args, lake):
    """The two forests of the one-hour decision, fitted on the training table."""
    training = stage(files.read_training_table(spark, args.table, args.format), "training")
    learning.fit_forests(training).save(f"{lake.root}/models")


def run_stream(spark, args, lake):
    """Land raw events in bronze, gold and silver, load the serving tables and the list of recent
    carts with the carts that changed, and raise the reminders from the landed silver, so that a
    decision finds all events its trigger has seen. With ``--models`` the forests decide."""
    if args.servers:
        raw = topics.read_topic(spark, args.servers, args.topic)
    else:
        raw = topics.read_event_files(spark, args.folder)
    every = None if args.once else args.every
    live = f"{lake.root}/silver/live_stream"
    files.ensure_folder(spark, live)
    views = LiveGold(spark, f"{lake.root}/gold/live", silver_events(raw).schema, args.buckets)
    land = jobs.live_writer(
        f"{lake.root}/bronze/live_stream",
        live,
        views,
        jobs.scored(jobs.serving_writer(lake.serving)),
        jobs.scored(jobs.recent_writer(f"{lake.root}/recent")),
        ledger=f"{lake.root}/state/ledger",
    )
    landing = jobs.start(raw, land, f"{lake.root}/state/landing", every=every)
    if args.once:
        jobs.drain(landing)
    silver = spark.readStream.schema(silver_events(raw).schema).parquet(live)
    forests = learning.Forests.load(f"{lake.root}/models") if args.models else None
    actions = jobs.action_writer(live, f"{lake.root}/fired", f"{lake.root}/actions", views, forests)
    fired = jobs.start(clock.fired_triggers(silver), actions, f"{lake.root}/state/triggers", every=every)
    if args.once:
        jobs.drain(fired)
    else:
        spark.streams.awaitAnyTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cartlake")
    add = top.add_subparsers(dest="job", required=True)

    def job(name, run):
        sub = add.add_parser(name)
        sub.add_argument("--lake", required=True, help="root path of the layers")
        sub.set_defaults(run=run)
        return sub

    sub = job("medallion", run_medallion)
    sub.add_argument("--csv", required=True, help="path or glob of the event logs")
    sub.add_argument("--normalize", action="store_true")
    sub.add_argument("--dedup", action="store_true")
    sub = job("campaign", run_campaign)
    sub.add_argument("--model", help="where to save the best model")
    sub = job("serving", run_serving)
    sub.add_argument("--batch", type=int, default=0)
    sub.add_argument("--model", help="a saved model; the heuristic without it")
    sub.add_argument("--jdbc", help="URL of a database whose serving tables take the batch as well")
    sub.add_argument("--option", action="append", default=[], help="name=value for the database driver")
    sub = job("listing", run_listing)
    sub.add_argument("--rows", type=int, default=50)
    sub.add_argument("--jdbc", help="URL of a database to read the serving tables from")
    sub.add_argument("--option", action="append", default=[], help="name=value for the database driver")
    sub = job("dashboard", run_dashboard)
    sub.add_argument("--out", required=True)
    sub = job("train", run_train)
    sub.add_argument("--table", required=True, help="path of the training table")
    sub.add_argument("--format", choices=["csv", "parquet"], default="csv")
    sub = job("stream", run_stream)
    source = sub.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--folder", help="folder of JSON-lines files")
    sub.add_argument("--topic", default=topics.EVENT_TOPIC)
    sub.add_argument("--every", default="2 seconds")
    sub.add_argument("--once", action="store_true", help="take what is there and stop")
    sub.add_argument("--models", action="store_true", help="decide with the forests that the train job saved")
    sub.add_argument("--buckets", type=int, default=BUCKETS, help="folders by key of the live tables")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = use_utc(SparkSession.builder.appName(f"cartlake {args.job}").getOrCreate())
    try:
        args.run(spark, args, medallion.Lake(args.lake.rstrip("/")))
    finally:
        remove_staged(spark)


if __name__ == "__main__":
    main()
