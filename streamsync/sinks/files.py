"""K1-K3: file, console and memory sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

FORMATS = ("csv", "json", "orc", "parquet")


def check_file_sink(fmt: str, mode: str) -> None:
    """A file sink takes these formats and append mode only."""
    if fmt.lower() not in FORMATS:
        raise ValueError(f"file format must be one of {FORMATS}, not {fmt!r}")
    if mode.lower() != "append":
        raise ValueError("a file sink can only append")


def check_checkpoint(checkpoint: str) -> None:
    """T5: a query without a checkpoint would start anew each time."""
    if not checkpoint:
        raise ValueError("a streaming query needs a checkpoint folder")


def file_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: Sequence[str] = (),
    output_files: int | None = None,
    **options: object,
) -> DataStreamWriter:
    """K1, K2: a stream of files, each batch exactly once.

    Each task writes its own file; ``output_files`` merges tasks without a shuffle
    where fewer files per batch are wanted.
    """
    check_file_sink(fmt, mode)
    check_checkpoint(checkpoint)
    if output_files is not None:
        rows = rows.coalesce(output_files)
    writer = rows.writeStream.format(fmt.lower()).outputMode("append").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("path", path).option("checkpointLocation", checkpoint)


def console_stream(
    rows: DataFrame, checkpoint: str, mode: str = "append", truncate: bool = False
) -> DataStreamWriter:
    """K3: print each batch."""
    check_checkpoint(checkpoint)
    return (
        rows.writeStream.format("console")
        .outputMode(mode)
        .option("truncate", truncate)
        .option("checkpointLocation", checkpoint)
    )
