"""The rows that come after their window has closed, set aside instead of lost."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from streamsync.scratch import file_system
from streamsync.streaming.jobs import for_each_batch


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark a query's batch runs with, in milliseconds, as its checkpoint has it."""
    fs, place = file_system(spark, f"{checkpoint.rstrip('/')}/offsets/{batch_id}")
    reader = fs.open(place)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(reader, "UTF-8")
    reader.close()
    for line in text.split("\n"):
        if line.startswith("{") and "batchWatermarkMs" in line:
            return int(json.loads(line)["batchWatermarkMs"])
    return 0


def late_rows(
    rows: DataFrame, time: str, watermark: str, size: str, path: str, checkpoint: str, slide: str | None = None
) -> DataStreamWriter:
    """A stream's rows all of whose windows had closed when they came, as Parquet by batch.

    ``rows`` is what an aggregate with this watermark reads, so the two together have every
    row once: the query here keeps the same watermark over the same input, and each of its
    batches is split by the watermark that its own checkpoint has for it.  A repeated batch
    replaces its own folder.  Rows without a time are in no window and late in none.
    """
    marked = rows.withWatermark(time, watermark)

    # of the windows that hold a row, the last one to close begins at its last slide
    closes = F.window(time, slide or size)["start"] + F.expr(f"interval {size}")

    def keep(batch: DataFrame, batch_id: int) -> None:
        mark = batch_watermark(batch.sparkSession, checkpoint, batch_id)
        late = batch.where(F.unix_millis(closes) <= mark)
        late.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return for_each_batch(marked, keep, checkpoint)
