"""Database tables in and out through Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WRITE_BATCH = 25_000  # rows per insert
WRITE_CONNECTIONS = 32  # a database takes some hundred connections at most, whatever the cluster's size
FETCH_ROWS = 10_000  # rows per round trip; many drivers otherwise hold the whole result in memory

# Connection properties for PostgreSQL. Text goes into columns of any type; inserts of a batch are sent as one.
POSTGRESQL = {"driver": "org.postgresql.Driver", "stringtype": "unspecified", "rewriteBatchedInserts": "true"}


def read_jdbc(spark: SparkSession, url: str, table: str, props: dict[str, str]) -> DataFrame:
    """A whole table in one query: for small lookup tables. Filters and columns are still pushed to the database."""
    return spark.read.jdbc(url, table, properties=_fetching(props))


def _fetching(props: dict[str, str]) -> dict[str, str]:
    return {"fetchsize": str(FETCH_ROWS), **props}


def key_bounds(spark: SparkSession, url: str, table: str, key: str, props: dict[str, str], where: str = "") -> tuple[int, int] | None:
    """Smallest and largest key, of the rows that meet the SQL condition `where` if one is given, found by the database; None without rows."""
    only = f" WHERE {where}" if where else ""
    query = f"(SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}{only}) bounds"
    row = spark.read.jdbc(url, query, properties=props).first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))


def read_jdbc_ranged(spark: SparkSession, url: str, table: str, key: str, n: int, props: dict[str, str], where: str = "") -> DataFrame:
    """A table read by `n` range queries over its key. The range comes from the data: fixed bounds would leave the last query everything
    beyond them. where: the range is that of the rows that meet this SQL condition, so that these are spread over all queries. It is not a
    filter: the first and last query hold all rows outside the range; filter the frame by the same condition, which Spark passes on."""
    bounds = key_bounds(spark, url, table, key, props, where)
    if bounds is None:
        return read_jdbc(spark, url, table, props)
    low, high = bounds
    ranges = max(1, min(n, high - low + 1))
    return spark.read.jdbc(
        url, table, column=key, lowerBound=low, upperBound=high + 1, numPartitions=ranges, properties=_fetching(props)
    )


@dataclass(frozen=True)
class LargeTable:
    """A large table of a database as the source of a load: called, it is read whole; a load with marks asks it for less.

    The frames it returns may hold more rows than were asked for; what they are cut into is what suits the rows asked for.
    """

    spark: SparkSession
    url: str
    table: str
    key: str
    ranges: int
    props: dict[str, str]

    def __call__(self) -> DataFrame:
        return read_jdbc_ranged(self.spark, self.url, self.table, self.key, self.ranges, self.props)

    def between(self, column: str, after: datetime | None, until: datetime) -> DataFrame:
        """For rows after one time and not after another, or without one: cut at equal strides of the keys of these rows. Over the keys of
        the whole table nearly all strides would be empty, and the last would hold what is new."""
        inside = f"{column} <= {_literal(until)}" + ("" if after is None else f" AND {column} > {_literal(after)}")
        return read_jdbc_ranged(self.spark, self.url, self.table, self.key, self.ranges, self.props, f"({inside}) OR {column} IS NULL")

    def matching(self, column: str, keys: DataFrame) -> DataFrame:
        """For rows whose `column` is one of `keys`: cut at quantiles of the keys, so each query finds the rows of as many of them."""
        return read_jdbc_by(self.spark, self.url, self.table, key_ranges(keys, [column], self.ranges), self.props)


def key_ranges(keys: DataFrame, columns: Sequence[str], n: int) -> list[str]:
    """Conditions on one or several key columns, at most `n`, that split a table into ranges of about as many rows each.

    keys: rows with these columns, such as the table's last copy in files. The ranges are those of Spark's range partitioning, cut at sampled
    quantiles, so gaps and clusters of keys don't matter; one key is never split. What comes to the driver is the lowest key of each range.
    Together the conditions hold for every row once: the first also takes keys below the lowest one known and keys with a NULL in
    them, the last all above. Texts, numbers, dates and times are written as SQL literals.
    """
    by = [F.col(c) for c in columns]
    ranged = keys.select(*columns).na.drop().repartitionByRange(n, *by)
    lows = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*columns)).alias("low")).select("low.*")
    starts = sorted({tuple(r) for r in lows.collect()})[1:]
    if not starts:
        return ["1 = 1"]
    nulls = " OR ".join(f"{c} IS NULL" for c in columns)
    bounds = [(_at_least(columns, low), _below(columns, low)) for low in starts]
    first = f"({bounds[0][1]}) OR {nulls}"
    middle = [f"({low}) AND ({high})" for (low, _), (_, high) in zip(bounds, bounds[1:])]
    # a comparison with a NULL in a later column may still hold, so keys with one are the first range's alone
    whole = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return [first, *(f"({m}) AND {whole}" for m in [*middle, bounds[-1][0]])]


def _literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    return str(value)


def _below(columns: Sequence[str], key: tuple) -> str:
    """Keys before `key` in the order of the columns, spelled out, as not every database compares tuples."""
    steps = []
    for k, c in enumerate(columns):
        equal = [f"{d} = {_literal(v)}" for d, v in zip(columns[:k], key)]
        steps.append(" AND ".join([*equal, f"{c} < {_literal(key[k])}"]))
    return " OR ".join(f"({s})" for s in steps)


def _at_least(columns: Sequence[str], key: tuple) -> str:
    steps = []
    for k, c in enumerate(columns):
        equal = [f"{d} = {_literal(v)}" for d, v in zip(columns[:k], key)]
        steps.append(" AND ".join([*equal, f"{c} {'>=' if k == len(columns) - 1 else '>'} {_literal(key[k])}"]))
    return " OR ".join(f"({s})" for s in steps)


def read_jdbc_by(spark: SparkSession, url: str, table: str, ranges: Sequence[str], props: dict[str, str]) -> DataFrame:
    """A table read by one query for each condition of `key_ranges`."""
    return spark.read.jdbc(url, table, predicates=list(ranges), properties=_fetching(props))


def write_jdbc(df: DataFrame, url: str, table: str, props: dict[str, str], mode: str = "append", connections: int = WRITE_CONNECTIONS) -> None:
    """Bulk insert, one connection per partition, at most `connections` at once and in all: more partitions than that are put together
    without a shuffle. A task that is repeated inserts its rows again, as the rows of a partition go in by batches: write to a table
    that is emptied first, or one whose key refuses the second row.
    """
    df.write.option("batchsize", WRITE_BATCH).option("numPartitions", connections).jdbc(url, table, mode=mode, properties=props)
