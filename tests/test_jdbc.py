"""What is asked of the database. No database is started: Spark's reader and writer are stood in for."""

from __future__ import annotations

from unittest.mock import MagicMock

from strata.plans import load
from strata.sources import jdbc

PROPS = {"user": "u", **jdbc.POSTGRESQL}
READ = {"fetchsize": "10000", **PROPS}


def session(low, high):
    spark = MagicMock()
    spark.read.jdbc.return_value.first.return_value = (low, high)
    return spark


def test_ranges_follow_the_keys_that_exist():
    spark = session(500, 1_499)
    jdbc.read_jdbc_ranged(spark, "jdbc:x", "source.orders", "order_id", 4, PROPS)
    (bounds, _), (args, options) = spark.read.jdbc.call_args_list
    assert "MIN(order_id)" in bounds[1] and "MAX(order_id)" in bounds[1]
    assert args == ("jdbc:x", "source.orders")
    assert options == {"column": "order_id", "lowerBound": 500, "upperBound": 1_500, "numPartitions": 4, "properties": READ}


def test_no_more_ranges_than_keys_and_none_for_an_empty_table():
    spark = session(3, 4)
    jdbc.read_jdbc_ranged(spark, "jdbc:x", "t", "id", 16, PROPS)
    assert spark.read.jdbc.call_args.kwargs["numPartitions"] == 2
    spark = session(None, None)
    jdbc.read_jdbc_ranged(spark, "jdbc:x", "t", "id", 16, PROPS)
    assert spark.read.jdbc.call_args.args == ("jdbc:x", "t") and spark.read.jdbc.call_args.kwargs == {"properties": READ}


def test_appends_in_large_batches():
    df = MagicMock()
    jdbc.write_jdbc(df, "jdbc:x", "bronze.t", PROPS)
    df.write.option.assert_called_once_with("batchsize", 25_000)
    bounded = df.write.option.return_value.option
    bounded.assert_called_once_with("numPartitions", 32)  # connections, however many partitions there are
    bounded.return_value.jdbc.assert_called_once_with("jdbc:x", "bronze.t", mode="append", properties=PROPS)


def test_database_sources_read_large_tables_in_ranges(tmp_path):
    spark = session(1, 1_000)
    sources = load.database_sources(spark, "jdbc:x", PROPS, str(tmp_path), 8)
    assert set(sources) == set(load.schemas.BRONZE)
    for table, key in {"orders": "order_id", "order_items": "order_item_id", "weblogs": "log_id"}.items():
        sources[table]()
        assert spark.read.jdbc.call_args.kwargs["column"] == key
    sources["companies"]()
    assert spark.read.jdbc.call_args.args == ("jdbc:x", "source.companies")


def test_ranges_by_quantiles_hold_every_row_once(spark):
    from functools import reduce

    from pyspark.sql import functions as F

    # clustered and gappy: nine in ten keys lie within one thousandth of the span
    keys = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") * 50_000).otherwise(F.col("id")).alias("k"), (F.col("id") % 7).alias("j"), F.concat(F.lit("o'"), F.col("id") % 5).alias("t")
    )
    lost = spark.createDataFrame([(None, 1, "a"), (3, None, "b"), (4, 2, None), (None, None, None)], "k long, j long, t string")
    table = keys.unionByName(lost)
    for columns, n in ((["k"], 8), (["j", "k"], 8), (["t", "j", "k"], 5), (["j"], 3)):
        ranges = jdbc.key_ranges(table, columns, n)
        sizes = [table.filter(F.expr(r)).count() for r in ranges]
        assert 1 < len(ranges) <= n and sum(sizes) == table.count(), (columns, sizes)
        if columns != ["j"]:
            assert max(sizes) < 2 * sum(sizes) / len(sizes), (columns, sizes)
        once = reduce(lambda x, y: x.unionByName(y), [table.filter(F.expr(r)) for r in ranges])
        assert once.exceptAll(table).count() == 0
    strides = [keys.filter(f"k >= {a} and k < {a + 125_000_000}").count() for a in range(0, 1_000_000_000, 125_000_000)]
    assert max(strides) > 7 * sum(strides) / len(strides)  # what equal strides would have given
    assert jdbc.key_ranges(table.filter("false"), ["k"], 8) == ["1 = 1"]


def test_ranges_are_read_by_a_query_each(monkeypatch):
    asked = {}

    class Reader:
        def jdbc(self, url, table, **options):
            asked.update(options, table=table)

    class Session:
        read = Reader()

    jdbc.read_jdbc_by(Session(), "jdbc:x", "source.orders", ["a < 5", "a >= 5"], {"user": "u"})
    assert asked["predicates"] == ["a < 5", "a >= 5"] and asked["properties"]["fetchsize"] and asked["table"] == "source.orders"


class Files:
    """Stands in for a database: a table of files, read by a condition each as Spark's reader would, with what was asked."""

    def __init__(self, spark, path):
        self.spark, self.path, self.asked = spark, path, []
        self.read = self

    def jdbc(self, url, table, **options):
        from functools import reduce

        rows = self.spark.read.parquet(self.path)
        self.asked.append((table, options))
        if table.startswith("("):
            rows.createOrReplaceTempView("t_of_files")
            return self.spark.sql(table.removeprefix("(").removesuffix(") bounds").replace("source.t", "t_of_files"))
        if "predicates" in options:
            parts = [rows.filter(p) for p in options["predicates"]]
            return reduce(lambda x, y: x.unionByName(y), parts)
        return rows


def test_a_window_is_spread_over_all_queries(spark, tmp_path):
    from datetime import datetime

    from pyspark.sql import functions as F

    # ten thousand orders, a day apart; 300 are new
    rows = spark.range(10_000).select(F.col("id").alias("order_id"), F.timestamp_seconds(F.col("id") * 86_400).cast("timestamp_ntz").alias("at"))
    rows.write.parquet(str(tmp_path / "t"))
    database = Files(spark, str(tmp_path / "t"))
    table = jdbc.LargeTable(database, "jdbc:x", "source.t", "order_id", 8, PROPS)
    day = lambda n: datetime.fromtimestamp(n * 86_400)
    table.between("at", day(9_699), day(9_999))
    (bounds, _), (_, options) = database.asked
    assert "WHERE (at <= TIMESTAMP" in bounds and "OR at IS NULL" in bounds
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == (9_700, 10_000, 8)
    database.asked.clear()
    table.between("at", None, day(9))
    assert database.asked[1][1]["upperBound"] == 10 and " > " not in database.asked[0][0]
    database.asked.clear()
    table.between("at", day(20_000), day(20_001))  # nothing is new: one query, which the filter empties
    assert "numPartitions" not in database.asked[1][1]


def test_rows_of_known_keys_are_cut_by_the_keys(spark, tmp_path):
    from pyspark.sql import functions as F

    # three lines an order; the new orders are a thin slice far up, so strides over all lines would put it into one query
    lines = spark.range(30_000).select(F.col("id").alias("line_id"), F.expr("id div 3").alias("order_id"))
    lines.write.parquet(str(tmp_path / "t"))
    database = Files(spark, str(tmp_path / "t"))
    table = jdbc.LargeTable(database, "jdbc:x", "source.t", "line_id", 6, PROPS)
    keys = spark.range(9_000, 9_300).select(F.col("id").alias("order_id"))
    read = table.matching("order_id", keys)
    assert read.count() == 30_000  # every row is in one of the queries
    asked = database.asked[0][1]["predicates"]
    wanted = lines.join(keys, "order_id", "left_semi")
    sizes = [wanted.filter(p).count() for p in asked]
    assert 1 < len(sizes) <= 6 and sum(sizes) == 900 and max(sizes) < 2 * 900 / len(sizes)
    strides = [wanted.filter(f"line_id >= {a} and line_id < {a + 5_000}").count() for a in range(0, 30_000, 5_000)]
    assert max(strides) == 900
