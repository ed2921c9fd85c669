"""``python -m streamsync (file|hdfs) <config.json> [once]``: run one sync job."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from streamsync.config import load
from streamsync.streaming.jobs import run_sync


def main(arguments: list[str]) -> None:
    """Run the job for ever, or with ``once`` through what is there."""
    once = arguments[2:] == ["once"]
    if len(arguments) != 2 and not once:
        raise SystemExit("need two arguments: file or hdfs, and the path of the configuration")
    spark = (
        SparkSession.builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
        .enableHiveSupport()
        .getOrCreate()
    )
    config = load(spark, *arguments[:2])
    if config.file.metastore:
        # the catalog is opened at its first use, which is after this
        spark.conf.set("spark.hadoop.hive.metastore.uris", config.file.metastore)
        spark._jsc.hadoopConfiguration().set("hive.metastore.uris", config.file.metastore)
    run_sync(spark, config, once).awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
