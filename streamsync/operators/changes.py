"""Change rows to the last state of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_per_key(
    changes: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    one_partition_per_key: bool = True,
) -> DataFrame:
    """The last change of each key, by log position; all columns, or those named.

    Each task first keeps its own last row per key (the optimizer's group limit
    below the shuffle), so a key with a third of all changes crosses the shuffle
    as one row per task, and only the named columns do.  Where a key may appear
    in several log partitions, pass ``one_partition_per_key=False`` to order by
    record time first.  On a stream the last row per key is kept as state.
    """
    wanted = list(columns or changes.columns)
    position = [F.col("partition").cast("int"), F.col("offset").cast("bigint")]
    order = [position[1]] if one_partition_per_key else [F.col("ts").cast("timestamp"), *position]
    names = [f"`{c}`" for c in wanted]
    if changes.isStreaming:
        image = F.struct(*(F.col(n) for n in names if n != f"`{key}`"))
        last = changes.groupBy(F.col(f"`{key}`").alias(key)).agg(
            F.max_by(image, F.struct(*order)).alias("_last")
        )
        return last.select(*(n if n == f"`{key}`" else f"_last.{n}" for n in names))
    newest = Window.partitionBy(f"`{key}`").orderBy(*(o.desc() for o in order))
    ranked = changes.withColumn("_rank", F.row_number().over(newest))
    return ranked.where("_rank = 1").select(*names)


def current_rows(changes: DataFrame, key: str, columns: Sequence[str], **order: bool) -> DataFrame:
    """The table the changes lead to: keys whose last change is not a delete."""
    last = last_per_key(changes, key, ["op", *columns], **order)
    return last.where("op <> 'd'").drop("op")


def delete_where(rows: DataFrame, condition: str) -> DataFrame:
    """K12 for file tables: the rows that stay; a row whose condition is null stays too."""
    return rows.where(~F.coalesce(F.expr(condition), F.lit(False)))
