"""The jobs of the platform, for spark-submit: ``python -m tidemark.plans.jobs <job> --help``.

Paths, formats and broker options are arguments, so one job runs against files here and a broker there.
"""

from __future__ import annotations

import argparse
import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import features
from tidemark.plans import registry
from tidemark.session import configure
from tidemark.sources import lake, topics
from tidemark.streaming import intake
from tidemark.streaming.changes import FollowedTable
from tidemark.streaming.counts import WindowedCounts
from tidemark.streaming.landing import land, land_table


def materialize(events: DataFrame, directory: str, end: datetime) -> dict[str, str]:
    """Rewrite both feature sources from the events, then bring the online tables up to date from the sources.

    The online tables read the written sources, so the sweep over the events runs once.
    """
    spark = events.sparkSession
    folders = dict(zip(features.SOURCE_FILES, features.write_feature_sources(events, f"{directory}/sources")))
    registry.save_definitions(spark, f"{directory}/registry", [registry.RANKING])
    store = registry.FeatureRegistry()
    for view in registry.load_definitions(spark, f"{directory}/registry")[registry.RANKING.name].views:
        store.apply(view, registry.stored_source(spark, view, folders[view.entity.name]))
    return store.materialize(f"{directory}/online", F.lit(end))


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _checkpoint(given: str | None, job: str, output: str) -> str:
    """The argument, the job's folder in the environment's durable directory, or a folder beside the output."""
    durable = os.environ.get("CHECKPOINTS_DIRECTORY")
    return given or (f"{durable.rstrip('/')}/{job}" if durable else f"{output}/checkpoint")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("counts", "land", "accept", "changes"):
        job = jobs.add_parser(name)
        job.add_argument("--format", default="kafka")
        job.add_argument("--option", action="append", default=[], help="source or sink option, name=value")
        job.add_argument("--path", help="folder of the topic, for file formats")
        job.add_argument("--output", required=True)
        job.add_argument("--checkpoint")
        job.add_argument("--table", help="land into this catalog table, made below the output folder where missing")
        job.add_argument("--table-format", default="parquet")
        job.add_argument("--bodies", help="folder of request bodies to accept, one document per line")
        job.add_argument("--once", action="store_true", help="take what is there now and stop")
    job = jobs.add_parser("features")
    job.add_argument("--lake", help="folder of the event table; the registered table if absent")
    job.add_argument("--namespace", default=lake.NAMESPACE)
    job.add_argument("--output", required=True)
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName(f"tidemark-{args.job}").getOrCreate())
    if args.job == "features":
        events = lake.scan(spark, args.lake) if args.lake else lake.current_events(spark, args.namespace)
        materialize(events, args.output, datetime.now(timezone.utc))
        return
    options = _options(args.option)
    if args.job == "accept":
        bodies = topics.stream(spark, "text", {}, args.bodies)
        state = _checkpoint(args.checkpoint, args.job, args.output)
        queries = [
            intake.accept(bodies, f"{state}/accepted", options, args.format, args.path, once=args.once),
            intake.refuse(bodies, f"{state}/refused", f"{args.output}/refused", once=args.once),
        ]
        for query in queries:
            query.awaitTermination()
        return
    wire = topics.stream(spark, args.format, options, args.path)
    checkpoint = _checkpoint(args.checkpoint, args.job, args.output)
    if args.job == "changes":
        query = FollowedTable(spark, args.output, checkpoint).start(wire, args.once)
    elif args.job == "counts":
        counted = WindowedCounts(spark, args.output, checkpoint=checkpoint)
        query = counted.start(wire, args.once)
    elif args.table:
        namespace, _, table = args.table.rpartition(".")
        name = lake.ensure_table(spark, args.output, namespace or lake.NAMESPACE, table, args.table_format)
        query = land_table(wire, name, checkpoint, once=args.once, fmt=args.table_format)
    else:
        query = land(wire, args.output, checkpoint, once=args.once)
    query.awaitTermination()


if __name__ == "__main__":
    main()
