"""Database scans in parallel slices, bounded incremental queries, and writes back.

The functions that build options are separate from those that connect, so they can be checked
without a database.
"""

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


SAMPLE_PERCENT = 1.0


@dataclass(frozen=True)
class Database:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    fetch_size: int = 10_000
    batch_size: int = 10_000

    def options(self) -> dict[str, str]:
        known = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        return {name: value for name, value in known.items() if value is not None}


def scan_options(
    db: Database, table: str, column: str | None = None, bounds: tuple | None = None, slices: int = 64
) -> dict[str, str]:
    """Options of a whole-table scan, in ``slices`` ranges of a numeric or time column.

    The bounds only set the stride; rows outside them fall into the first and last range.
    """
    options = {**db.options(), "dbtable": table, "fetchsize": str(db.fetch_size)}
    if column is not None and bounds is not None and None not in bounds:
        options |= {
            "partitionColumn": column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(slices),
        }
    return options


def hash_predicates(hash_expression: str, slices: int) -> list[str]:
    """One WHERE clause per slice, for tables whose key has no order worth slicing (UUIDs).

    ``hash_expression`` is the database's own integer hash, e.g. ``hashtext(id::text)``.
    """
    return [f"mod(abs({hash_expression}), {slices}) = {i}" for i in range(slices)]


def after_id_query(table: str, columns: list[str], cursor: int, limit: int = 1000) -> str:
    """Order and limit written into the query, since they are not pushed into a table scan."""
    return (
        f"SELECT {', '.join(columns)} FROM {table} "
        f"WHERE id > {int(cursor)} ORDER BY id LIMIT {int(limit)}"
    )

def page_query(table: str, columns: list[str], condition: str, limit: int = 1000) -> str:
    """A page of the rows that fulfil ``condition``, lowest ids first."""
    return f"SELECT {', '.join(columns)} FROM {table} WHERE {condition} ORDER BY id LIMIT {int(limit)}"


def write_options(db: Database, table: str, schema: StructType | None = None) -> dict[str, str]:
    """Options of a write. ``truncate`` keeps the table's own definition on overwrite."""
    options = {
        **db.options(),
        "dbtable": table,
        "batchsize": str(db.batch_size),
        "truncate": "true",
    }
    if schema is not None:
        options["createTableColumnTypes"] = ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in schema
        )
    return options


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sample_query(table: str, column: str, slices: int, percent: float | None = None) -> str:
    """The values that cut a sample of ``column`` into ``slices`` equal parts, as text, in the database's own order."""
    sample = "" if percent is None else f" TABLESAMPLE SYSTEM ({percent})"
    return (
        f"SELECT CAST(k AS VARCHAR(1000)) AS cut FROM (SELECT {column} AS k, row_number() OVER (ORDER BY {column}) AS r, "
        f"count(*) OVER () AS n FROM {table}{sample} WHERE {column} IS NOT NULL) numbered "
        f"WHERE r < n AND mod(r * {int(slices)}, n) < {int(slices)} ORDER BY k"
    )


def range_predicates(column: str, cuts: list[str]) -> list[str]:
    """One WHERE clause per slice. They cover every value once, and rows without one, whatever the cuts are."""
    cuts = list(dict.fromkeys(cuts))
    if not cuts:
        return ["1 = 1"]
    first = [f"{column} <= {_text(cuts[0])} OR {column} IS NULL"]
    between = [f"{column} > {_text(low)} AND {column} <= {_text(high)}" for low, high in zip(cuts, cuts[1:])]
    return [*first, *between, f"{column} > {_text(cuts[-1])}"]


def staging_name(table: str) -> str:
    return f"{table}_staged"


def ledger_name(table: str) -> str:
    return f"{table}_batches"


def create_ledger(table: str) -> str:
    return (
        f"CREATE TABLE IF NOT EXISTS {ledger_name(table)} "
        "(stream VARCHAR(1000), batch_id BIGINT, attempt VARCHAR(64), PRIMARY KEY (stream, batch_id))"
    )


def guarded_insert(
    table: str, columns: list[str], stream: str, batch_id: int, attempt: str, identity: tuple[str, ...]
) -> list[str]:
    """Statements of one transaction that moves a staged batch into its table, once in the life of a stream.

    The first attempt to claim the batch in the ledger moves its rows; for any other the claim does nothing and
    so does the move. Rows that a repeated task staged twice are told apart from others by ``identity``.
    """
    staged, ledger = staging_name(table), ledger_name(table)
    named = ", ".join(_quoted(c) for c in columns)
    ours = f"stream_name = {_text(stream)} AND stream_batch = {int(batch_id)}"
    same = ", ".join(_quoted(c) for c in identity)
    claim = f"stream = {_text(stream)} AND batch_id = {int(batch_id)} AND attempt = {_text(attempt)}"
    return [
        f"INSERT INTO {ledger} (stream, batch_id, attempt) VALUES ({_text(stream)}, {int(batch_id)}, {_text(attempt)}) "
        "ON CONFLICT (stream, batch_id) DO NOTHING",
        f"INSERT INTO {table} ({named}) SELECT {named} FROM (SELECT {named}, "
        f"row_number() OVER (PARTITION BY {same} ORDER BY {same}) AS copy_number FROM {staged} "
        f"WHERE {ours} AND attempt = {_text(attempt)}) once "
        f"WHERE copy_number = 1 AND EXISTS (SELECT 1 FROM {ledger} WHERE {claim})",
        f"DELETE FROM {staged} WHERE {ours}",
    ]


def staged_rows(df: DataFrame, stream: str, batch_id: int, attempt: str) -> DataFrame:
    return df.withColumns({
        "stream_name": F.lit(stream), "stream_batch": F.lit(batch_id).cast("bigint"), "attempt": F.lit(attempt)})


def run_together(spark: SparkSession, db: Database, statements: list[str]) -> None:
    """Run statements on the driver's own connection as one transaction."""
    jvm = spark.sparkContext._jvm
    if db.driver:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(db.driver)
    login = jvm.java.util.Properties()
    for name in ("user", "password"):
        if getattr(db, name) is not None:
            login.setProperty(name, getattr(db, name))
    connection = jvm.java.sql.DriverManager.getConnection(db.url, login)
    try:
        connection.setAutoCommit(False)
        for text in statements:
            statement = connection.createStatement()
            statement.execute(text)
            statement.close()
        connection.commit()
    finally:
        connection.close()  # what is not committed is rolled back


def append_once(
    df: DataFrame, db: Database, table: str, stream: str, batch_id: int, identity: tuple[str, ...], stage=None, run=None
) -> None:
    """Append a batch to a table so that neither a repeated task nor a replayed batch adds a row twice.

    ``stage(df, table)`` and ``run(statements)`` stand for the database's append and transaction.
    """
    stage = stage or (lambda rows, name: append(rows, db, name))
    run = run or (lambda statements: run_together(df.sparkSession, db, statements))
    attempt = uuid4().hex
    run([create_ledger(table)])
    stage(staged_rows(df, stream, batch_id, attempt), staging_name(table))
    run(guarded_insert(table, df.columns, stream, batch_id, attempt, identity))


def read_bounds(spark: SparkSession, db: Database, table: str, column: str) -> tuple:
    """Least and greatest value, computed by the database (one row comes back)."""
    query = f"SELECT min({column}) AS low, max({column}) AS high FROM {table}"
    row = spark.read.format("jdbc").options(**db.options(), query=query).load().first()
    return row[0], row[1]


def _read_predicates(spark: SparkSession, db: Database, table: str, predicates: list[str]) -> DataFrame:
    properties = {k: v for k, v in db.options().items() if k != "url"}
    properties["fetchsize"] = str(db.fetch_size)
    return spark.read.jdbc(db.url, table, predicates=predicates, properties=properties)


def quantile_cuts(column: str, table: str, slices: int, percent: float, ask) -> list[str]:
    """From a sample of the table's pages; a table too small for that to give every cut is asked whole.

    ``ask(query)`` returns the first column of its rows, fewer than ``slices``.
    """
    cuts = ask(sample_query(table, column, slices, percent))
    return cuts if len(cuts) >= slices - 1 else ask(sample_query(table, column, slices))


def read_sliced(
    spark: SparkSession, db: Database, table: str, column: str, slices: int = 64, percent: float = SAMPLE_PERCENT
) -> DataFrame:
    """The whole table in slices of about as many rows each, however its key is spread; a key of any
    ordered type will do."""

    def ask(query: str) -> list[str]:
        return [row[0] for row in read_query(spark, db, query).collect()]

    return _read_predicates(spark, db, table, range_predicates(column, quantile_cuts(column, table, slices, percent, ask)))


def read_hashed(
    spark: SparkSession, db: Database, table: str, hash_expression: str, slices: int = 64
) -> DataFrame:
    return _read_predicates(spark, db, table, hash_predicates(hash_expression, slices))


def read_query(spark: SparkSession, db: Database, query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**db.options(), query=query).load()


def overwrite(df: DataFrame, db: Database, table: str) -> None:
    df.write.format("jdbc").options(**write_options(db, table, df.schema)).mode("overwrite").save()


def append(df: DataFrame, db: Database, table: str) -> None:
    """A plain append: a retried task may insert rows twice. ``append_once`` guards against that."""
    df.write.format("jdbc").options(**write_options(db, table, df.schema)).mode("append").save()


def into_database(db: Database):
    """A ``save(table, name)`` that overwrites one database table per name."""
    return lambda df, name: overwrite(df, db, name)
