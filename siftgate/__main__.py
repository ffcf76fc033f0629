"""Loads a directory: ``python -m siftgate DIRECTORY WAREHOUSE [--feeds MODULE:REGISTRY] [--watch]``."""

from __future__ import annotations

import argparse
from importlib import import_module

from pyspark.sql import SparkSession

from siftgate.operators import logs
from siftgate.plans.load import load_directory, notifications
from siftgate.sources.tables import BUCKETS, Warehouse
from siftgate.streaming.directory import watch


def main() -> None:
    parser = argparse.ArgumentParser(prog="siftgate", description=__doc__)
    parser.add_argument("directory", help="folder with the files to load")
    parser.add_argument("warehouse", help="shared folder of the tables")
    parser.add_argument("--feeds", default="siftgate.plans.feeds:MASTER", help="MODULE:NAME of a registry")
    parser.add_argument("--buckets", type=int, default=BUCKETS, help="parts of a target that are written by themselves")
    parser.add_argument("--watch", action="store_true", help="keep loading new files as they arrive")
    parser.add_argument("--move-to", help="with --watch: folder that loaded files are moved below")
    options = parser.parse_args()

    module, name = options.feeds.split(":")
    registry = getattr(import_module(module), name)
    spark = SparkSession.builder.appName("siftgate").getOrCreate()
    warehouse = Warehouse(spark, options.warehouse.rstrip("/"), options.buckets)
    if options.watch:
        checkpoint = f"{warehouse.root}/stream"
        watch(spark, registry, options.directory, warehouse, checkpoint, available_now=False, move_to=options.move_to).awaitTermination()
        return
    results = load_directory(spark, registry, options.directory, warehouse)
    logs.batch_totals(results).show(truncate=False)
    logs.failure_summary(results).show(truncate=False)
    logs.code_failures(results).show(truncate=False)
    notifications(results, registry).show(truncate=False)


if __name__ == "__main__":
    main()
