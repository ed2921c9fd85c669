"""JDBC tables.

Rows reach the database in parallel through Spark's JDBC writer, into a staging
table.  The target is then changed on the database side by a few set statements
in one transaction; no row passes through the driver and no value is put into
SQL text.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from streamsync.operators.casting import cast_columns
from streamsync.operators.changes import last_per_key

STAGING_ATTEMPTS = 3
# Fixed value: how many connections a write may hold, unless the options say otherwise.
MAX_CONNECTIONS = 200
# How databases say that a key or another constraint was violated: SQL states 23xxx, or words.
REFUSED = re.compile(r"\b23[0-9]{3}\b|duplicate|(unique|constraint|integrity).{0,80}violat", re.I)


@dataclass(frozen=True)
class JdbcTarget:
    """Where a JDBC table is; ``options`` go to Spark's JDBC source and writer.

    Text keys, and the names in the ledger of batches, have ``key_length`` characters.
    """

    url: str
    table: str
    schema: str | None = None
    user: str = ""
    password: str = ""
    driver: str = ""
    options: Mapping[str, str] = field(default_factory=dict)
    key_length: int = 255

    def properties(self) -> dict[str, str]:
        login = {"user": self.user, "password": self.password, "driver": self.driver}
        given = {k: v for k, v in login.items() if v}
        return {"numPartitions": str(MAX_CONNECTIONS), **given, **self.options}

    def sibling(self, suffix: str) -> JdbcTarget:
        """A helper table next to this one."""
        return replace(self, table=self.table + suffix)


def _dialect(spark: SparkSession, target: JdbcTarget) -> JavaObject:
    return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(target.url)


def quoted(spark: SparkSession, target: JdbcTarget, name: str) -> str:
    """A column or table name in the database's own quotes."""
    return _dialect(spark, target).quoteIdentifier(name)


def table_name(spark: SparkSession, target: JdbcTarget) -> str:
    """The quoted, schema-qualified table name."""
    parts = [target.schema, target.table] if target.schema else [target.table]
    return ".".join(quoted(spark, target, p) for p in parts)


def connect(spark: SparkSession, target: JdbcTarget) -> JavaObject:
    """A connection of the driver process, for statements only, made as Spark's own JDBC
    writer makes its connections, so drivers given to the job are found."""
    options = {"url": target.url, "dbtable": table_name(spark, target), **target.properties()}
    scala = spark._jvm.PythonUtils.toScalaMap(options)
    known = spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.JDBCOptions(scala)
    return _dialect(spark, target).createConnectionFactory(known).apply(-1)


def run(spark: SparkSession, target: JdbcTarget, statements: Iterable[str]) -> list[int]:
    """Run statements in one transaction and give the row count of each."""
    connection = connect(spark, target)
    try:
        connection.setAutoCommit(False)
        try:
            counts = [_execute(connection, s) for s in statements]
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        return counts
    finally:
        connection.close()


def _execute(connection: JavaObject, sql: str) -> int:
    statement = connection.createStatement()
    try:
        return statement.executeUpdate(sql)
    finally:
        statement.close()


def table_exists(spark: SparkSession, target: JdbcTarget) -> bool:
    """Whether the database finds a table of this name, by its own way to ask."""
    connection = connect(spark, target)
    try:
        statement = connection.prepareStatement(
            _dialect(spark, target).getTableExistsQuery(table_name(spark, target))
        )
        try:
            statement.executeQuery()
            return True
        finally:
            statement.close()
    except Py4JJavaError as error:
        if not _no_table(error.java_exception):
            raise
        return False
    finally:
        connection.close()


# SQL states by which databases say that a table or its schema is not there.
_MISSING = ("42S02", "42S04", "42P01", "3F000", "42X05", "42Y07", "42704", "S0002")
_ORACLE_MISSING = 942


def _no_table(error: JavaObject) -> bool:
    """Whether an error says that there is no such table; a lost connection or a missing
    right does not."""
    if "SQL" not in error.getClass().getName():
        return False
    return error.getSQLState() in _MISSING or error.getErrorCode() == _ORACLE_MISSING


def read(
    spark: SparkSession,
    target: JdbcTarget,
    condition: str | None = None,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    splits: int = 1,
) -> DataFrame:
    """The table, with the condition pushed to the database.

    ``split_on`` with its lowest and highest value reads in ``splits`` parallel
    ranges; otherwise one task reads the whole table.
    """
    name = table_name(spark, target)
    if split_on is None:
        rows = spark.read.jdbc(target.url, name, properties=target.properties())
    else:
        if bounds is None:
            raise ValueError("split_on needs bounds")
        low, high = bounds
        rows = spark.read.jdbc(
            target.url, name, column=split_on, lowerBound=low, upperBound=high,
            numPartitions=splits, properties=target.properties(),
        )
    return rows.where(condition) if condition else rows


def column_type(spark: SparkSession, target: JdbcTarget, kind: DataType, key: bool = False) -> str:
    """What the database calls a type; a text key has a length."""
    if key and isinstance(kind, StringType):
        return f"VARCHAR({target.key_length})"
    here = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(kind.json())
    known = _dialect(spark, target).getJDBCType(here)
    if not known.isDefined():
        known = spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils.getCommonJDBCType(here)
    if not known.isDefined():
        raise ValueError(f"no column type for {kind.simpleString()}")
    return known.get().databaseTypeDefinition()


def _counts(spark: SparkSession, target: JdbcTarget, column: str, cells: list[tuple[int, int]]) -> list[int]:
    """Rows with a column in each [low, high), by one statement."""
    key = quoted(spark, target, column)
    each = ", ".join(f"SUM(CASE WHEN {key} >= {a} AND {key} < {b} THEN 1 ELSE 0 END)" for a, b in cells)
    return _first_row(spark, target, f"SELECT {each} FROM {table_name(spark, target)}", len(cells))


def _first_row(spark: SparkSession, target: JdbcTarget, sql: str, n: int) -> list[int | None]:
    connection = connect(spark, target)
    try:
        found = connection.createStatement().executeQuery(sql)
        found.next()
        values = [found.getObject(i + 1) for i in range(n)]
        return [None if v is None else int(str(v)) for v in values]
    finally:
        connection.close()


#: Cells that one statement counts.
_CELLS = 16


def balanced_ranges(spark: SparkSession, target: JdbcTarget, column: str, ranges: int) -> list[str]:
    """Conditions that cut a table into about so many ranges of a whole-number column, with about
    as many rows each, whatever its distribution.

    The database counts: cells with more rows than a range should have are cut further, so
    only heavy stretches cost more statements.  A range has at most twice the mean, but for a
    single value that has more.  Rows without a value are a range of their own.
    """
    key, name = quoted(spark, target, column), table_name(spark, target)
    n, known, low, high = _first_row(spark, target, f"SELECT COUNT(*), COUNT({key}), MIN({key}), MAX({key}) FROM {name}", 4)
    missing = [f"{key} IS NULL"] if n > known else []
    if not known:
        return missing or [f"{key} IS NULL"]
    goal, open_, done = max(1.0, known / ranges), [(low, high + 1, known)], []
    while open_:
        a, b, rows = open_.pop()
        if rows <= goal or b - a == 1:
            done.append((a, b, rows))
            continue
        edges = sorted({a + (b - a) * i // _CELLS for i in range(_CELLS + 1)})
        cells = list(zip(edges, edges[1:]))
        open_ += [(*cell, count) for cell, count in zip(cells, _counts(spark, target, column, cells))]
    bounds, held = [low], 0
    for a, _, rows in sorted(done):
        if held and held + rows > goal:
            bounds.append(a)
            held = 0
        held += rows
    bounds.append(high + 1)
    return [f"{key} >= {a} AND {key} < {b}" for a, b in zip(bounds, bounds[1:])] + missing


def read_balanced(spark: SparkSession, target: JdbcTarget, column: str, ranges: int) -> DataFrame:
    """S8 for uneven keys: each task reads a range with about as many rows as the others."""
    conditions = balanced_ranges(spark, target, column, ranges)
    return spark.read.jdbc(target.url, table_name(spark, target), predicates=conditions, properties=target.properties())


def create_table(
    spark: SparkSession, target: JdbcTarget, schema: StructType, pk: str | None = None
) -> bool:
    """K6: create the table if missing, with the schema's types; true if it was created."""
    if table_exists(spark, target):
        return False
    fields = [
        f"{quoted(spark, target, f.name)} {column_type(spark, target, f.dataType, f.name == pk)}"
        + (" NOT NULL" if f.name == pk else "")
        for f in schema.fields
    ]
    if pk is not None:
        fields.append(f"PRIMARY KEY ({quoted(spark, target, pk)})")
    run(spark, target, [f"CREATE TABLE {table_name(spark, target)} ({', '.join(fields)})"])
    return True


def verify_columns(spark: SparkSession, target: JdbcTarget, columns: Sequence[str]) -> None:
    """K7: the table has exactly these columns in this order."""
    wanted = list(columns)
    actual = read(spark, target).columns
    if len(actual) != len(wanted):
        raise ValueError(f"{target.table}: {len(actual)} table columns, {len(wanted)} row columns")
    for there, here in zip(actual, wanted):
        if there != here:
            raise ValueError(f"{target.table}: table column {there!r}, row column {here!r}")


def drop_table(spark: SparkSession, target: JdbcTarget) -> bool:
    """Drop the table; False if there was none."""
    if not table_exists(spark, target):
        return False
    run(spark, target, [f"DROP TABLE {table_name(spark, target)}"])
    return True


def delete_where(spark: SparkSession, target: JdbcTarget, condition: str) -> int:
    """Delete by a condition written by the caller; gives the number of rows."""
    return run(spark, target, [f"DELETE FROM {table_name(spark, target)} WHERE {condition}"])[0]


def _refused(error: BaseException) -> bool:
    """Whether a database refused a row for its key; the error of a failed job tells its
    causes as text, with their SQL state or their words."""
    return bool(REFUSED.search(str(error)))


def _staging_of(spark: SparkSession) -> str:
    """How the names of a streaming query's staging tables go on after the target's; a query
    keeps its id as long as its checkpoint."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
    return f"_staging_{zlib.crc32(query.encode()):08x}_"


def drop_leftovers(spark: SparkSession, target: JdbcTarget) -> list[str]:
    """Drop the staging tables that an earlier run of this streaming query left when it died;
    outside a streaming query there are none of its own."""
    if not spark.sparkContext.getLocalProperty("sql.streaming.queryId"):
        return []
    begin = f"{target.table}{_staging_of(spark)}"
    connection, names = connect(spark, target), []
    try:
        # an underscore of the pattern stands for any character
        found = connection.getMetaData().getTables(None, target.schema, f"{begin}%", None)
        while found.next():
            names.append(found.getString("TABLE_NAME"))
    finally:
        connection.close()
    left = sorted(n for n in names if n.startswith(begin))
    for name in left:
        drop_table(spark, target.sibling(name.removeprefix(target.table)))
    return left


def stage(rows: DataFrame, target: JdbcTarget, pk: str) -> JdbcTarget:
    """Write rows in parallel to a staging table of their own next to the target.

    A task can be run again after it has committed, when its executor is lost
    before the driver hears of it.  The staging table's primary key then refuses
    the second copy, and the whole staging write starts afresh under another name,
    which a late task of the failed one does not know.  Other errors are the caller's.
    """
    spark = rows.sparkSession
    for attempt in range(1, STAGING_ATTEMPTS + 1):
        staging = target.sibling(f"{_staging_of(spark)}{uuid.uuid4().hex[:12]}")
        create_table(spark, staging, rows.schema, pk)
        try:
            rows.write.jdbc(
                staging.url, table_name(spark, staging), mode="append",
                properties=staging.properties(),
            )
            return staging
        except Exception as error:
            drop_table(spark, staging)
            if attempt == STAGING_ATTEMPTS or not _refused(error):
                raise
    raise AssertionError("unreachable")


def upsert(changes: DataFrame, target: JdbcTarget, pk: str) -> None:
    """K5: apply typed ``op`` + columns, at most one row per key, in one transaction.

    Keys are deleted, then all but the deletes are inserted, so applying the same
    batch again changes nothing.  Rows without an ``op`` column are all inserted.
    """
    spark = changes.sparkSession
    columns = [c for c in changes.columns if c != "op"]
    flag = _unused("is_delete", columns)
    deleted = F.col("op") == "d" if "op" in changes.columns else F.lit(False)
    gone = F.when(deleted, 1).otherwise(0)
    staging = stage(changes.select(*(f"`{c}`" for c in columns), gone.alias(flag)), target, pk)
    into, source = table_name(spark, target), table_name(spark, staging)
    key, mark = quoted(spark, target, pk), quoted(spark, target, flag)
    names = _names(spark, target, columns)
    run(
        spark,
        target,
        [
            f"DELETE FROM {into} WHERE {key} IN (SELECT {key} FROM {source})",
            f"INSERT INTO {into} ({names}) SELECT {names} FROM {source} WHERE {mark} = 0",
        ],
    )
    drop_table(spark, staging)


def _unused(name: str, columns: Sequence[str]) -> str:
    while name in columns:
        name += "_"
    return name


def _names(spark: SparkSession, target: JdbcTarget, columns: Sequence[str]) -> str:
    return ", ".join(quoted(spark, target, c) for c in columns)


def _stage_numbered(rows: DataFrame, target: JdbcTarget) -> JdbcTarget:
    """Stage rows that have no key under a unique row number."""
    number = _unused("row_no", rows.columns)
    return stage(rows.withColumn(number, F.monotonically_increasing_id()), target, number)


def sync(
    changes: DataFrame,
    target: JdbcTarget,
    pk: str,
    types: Mapping[str, str],
    prepare: bool = True,
    **order: bool,
) -> None:
    """K8: last change per key, typed; create the table if missing, check it, apply.

    ``changes`` are flat text rows of one batch, with their log position.  A job that has
    prepared the table with its first batch says so with ``prepare=False``.
    """
    spark = changes.sparkSession
    typed = cast_columns(last_per_key(changes, pk, ["op", *types], **order), types)
    if prepare:
        drop_leftovers(spark, target)
        stored = typed.drop("op")
        create_table(spark, target, stored.schema, pk)
        verify_columns(spark, target, stored.columns)
    upsert(typed, target, pk)


def append_batch(
    rows: DataFrame, target: JdbcTarget, app: str, batch_id: int, query_id: str = "query"
) -> bool:
    """K9: append all columns of a batch once; False if this batch is there already.

    The rows and the batch's mark in a ledger table commit together.  Batches are
    counted anew with every checkpoint, so the mark names the query too.
    """
    spark = rows.sparkSession
    ledger = target.sibling("_commits")
    ledger_name = table_name(spark, ledger)
    if not table_exists(spark, ledger):
        text = f"VARCHAR({target.key_length}) NOT NULL"
        run(
            spark,
            ledger,
            [
                f"CREATE TABLE {ledger_name} (app {text}, query_id {text}, "
                "batch_id BIGINT NOT NULL, PRIMARY KEY (app, query_id, batch_id))"
            ],
        )
    known = f"SELECT 1 FROM {ledger_name} WHERE app = ? AND query_id = ? AND batch_id = ?"
    connection = connect(spark, ledger)
    try:
        query = _prepared(connection, known, app, query_id, batch_id)
        if query.executeQuery().next():
            return False
    finally:
        connection.close()
    create_table(spark, target, rows.schema)
    staging = _stage_numbered(rows, target)
    names = _names(spark, target, rows.columns)
    connection = connect(spark, target)
    try:
        connection.setAutoCommit(False)
        try:
            mark = f"INSERT INTO {ledger_name} (app, query_id, batch_id) VALUES (?, ?, ?)"
            _prepared(connection, mark, app, query_id, batch_id).executeUpdate()
            _execute(
                connection,
                f"INSERT INTO {table_name(spark, target)} ({names}) "
                f"SELECT {names} FROM {table_name(spark, staging)}",
            )
            connection.commit()
        except Exception:
            connection.rollback()
            raise
    finally:
        connection.close()
    drop_table(spark, staging)
    return True


def _prepared(
    connection: JavaObject, sql: str, app: str, query_id: str, batch_id: int
) -> JavaObject:
    statement = connection.prepareStatement(sql)
    statement.setString(1, app)
    statement.setString(2, query_id)
    statement.setObject(3, int(batch_id))
    return statement


def overwrite(rows: DataFrame, target: JdbcTarget) -> None:
    """K9 in complete mode: replace all rows in one transaction."""
    spark = rows.sparkSession
    create_table(spark, target, rows.schema)
    staging = _stage_numbered(rows, target)
    names = _names(spark, target, rows.columns)
    into = table_name(spark, target)
    run(
        spark,
        target,
        [
            f"DELETE FROM {into}",
            f"INSERT INTO {into} ({names}) SELECT {names} FROM {table_name(spark, staging)}",
        ],
    )
    drop_table(spark, staging)
