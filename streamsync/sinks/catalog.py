"""K4: append to a catalog table, creating it on the first write."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append(
    rows: DataFrame, table: str, provider: str = "parquet", path: str | None = None
) -> None:
    """Append; a repeated batch is appended again."""
    writer = rows.write.mode("append").format(provider)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def _text(value: str) -> str:
    """A text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_batch(
    rows: DataFrame,
    table: str,
    batch_id: int,
    provider: str = "parquet",
    path: str | None = None,
    query_id: str | None = None,
) -> None:
    """Write one micro-batch as the table's partition ``batch_id``.

    A repeated batch replaces its own partition, so each row is there once.  Batches
    are counted anew with every checkpoint: with ``query_id`` the partition is that of
    the query's batch, and no other query's batch is replaced.
    """
    spark = rows.sparkSession
    own = ["batch_id"] if query_id is None else ["query_id", "batch_id"]
    types = {"batch_id": "BIGINT", "query_id": "STRING"}
    if not spark.catalog.tableExists(table):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        place = "" if path is None else f" LOCATION {_text(path)}"
        spark.sql(
            f"CREATE TABLE {table} ({fields}, {', '.join(f'{c} {types[c]}' for c in own)}) "
            f"USING {provider} PARTITIONED BY ({', '.join(own)}){place}"
        )
    columns = ", ".join(f"`{c}`" for c in spark.table(table).columns if c not in own)
    values = {"batch_id": int(batch_id), "query_id": f"'{query_id}'"}
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({', '.join(f'{c} = {values[c]}' for c in own)}) "
        f"SELECT {columns} FROM {{rows}}",
        rows=rows,
    )
