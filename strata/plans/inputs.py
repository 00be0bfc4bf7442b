"""The warehouse at every stage over one set of given tables, built on demand: raw, conformed, and the written star schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas
from strata.operators import conform, quality, star
from strata.plans import fixtures
from strata.session import empty_frame, materialize, scratch_path

LINES_PER_FILE = {"leads_csv": 500, "weblog_lines": 2500}


class Inputs:
    """Lazy frames; only the star schema (`dims`, `facts`) is written, once, as the load itself would, and read back."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = build()
        return self._frames[name]

    def given(self, table: str) -> DataFrame:
        return self._once(table, lambda: self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet"))

    def _derived(self, label: str, sql: str) -> DataFrame:
        names = [t for t in fixtures.TABLES if f"{{{t}}}" in sql]
        # Lines are numbered within their order and then meet it: dealt by order once, they need no other shuffle for either.
        frames = {t: self.given(t).repartition("l_orderkey") if t == "lineitem" else self.given(t) for t in names}
        frames |= {f"src_{t}": self.raw(t) for t in fixtures.RAW if f"{{src_{t}}}" in sql}
        return self._once(label, lambda: self.spark.sql(sql, **frames))

    def raw(self, table: str) -> DataFrame:
        wide = table in fixtures.WIDE_RAW and self._wide_lines
        return self._derived(f"raw {table}", (fixtures.WIDE_RAW if wide else fixtures.RAW)[table])

    @cached_property
    def _wide_lines(self) -> bool:
        """Whether the keys that RAW makes of order lines may exceed a long; they are decimals then. Reads four columns' bounds."""
        columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        bounds = [f(F.col(c).cast("long")) for c in columns for f in (F.min, F.max)]
        rows, *ends = self.given("lineitem").agg(F.count("*"), *bounds).first()
        order, line, part, supplier = (max(abs(low or 0), abs(high or 0)) for low, high in zip(ends[::2], ends[1::2]))
        return (((order * 10 + line) * 1000000 + part) * 10000 + supplier) * 10 + rows >= 2**63

    def earlier(self, table: str) -> DataFrame:
        return self._derived(f"earlier {table}", fixtures.EARLIER[table])

    def history(self, table: str) -> DataFrame:
        return self._derived(f"history {table}", fixtures.WIDE_HISTORY.get(table, fixtures.HISTORY[table]))

    def bronze(self, table: str, batch_id: int = 1) -> DataFrame:
        return conform.stamp_batch(self.raw(table), batch_id)

    def bronze_earlier(self, table: str) -> DataFrame:
        return conform.stamp_batch(self.earlier(table), 1)

    def empty(self, table: str) -> DataFrame:
        return empty_frame(self.spark, schemas.GOLD[table])

    # Conformed rows of the raw tables.

    def lines(self, batch_id: int = 1) -> DataFrame:
        return conform.sales_lines(self.bronze("order_items", batch_id), self.bronze("orders", batch_id))

    def web(self, batch_id: int = 1) -> DataFrame:
        return conform.web_activity(self.bronze("weblogs", batch_id))

    def leads(self, batch_id: int = 1) -> DataFrame:
        return conform.lead_types(self.bronze("leads_csv", batch_id))

    def good_lines(self, batch_id: int = 1) -> DataFrame:
        return quality.split(self.lines(batch_id), quality.sales_rule())[0]

    def good_web(self, batch_id: int = 1) -> DataFrame:
        return quality.split(self.web(batch_id), quality.weblog_rule())[0]

    def good_leads(self, batch_id: int = 1) -> DataFrame:
        return quality.split(self.leads(batch_id), quality.lead_rule())[0]

    def rejects(self) -> DataFrame:
        from strata import fixed

        rules = [
            (self.lines(), quality.sales_rule(), fixed.SALES_SOURCE, fixed.SALES_REASON),
            (self.web(), quality.weblog_rule(), fixed.WEBLOG_SOURCE, fixed.WEBLOG_REASON),
            (self.leads(), quality.lead_rule(), fixed.LEAD_SOURCE, fixed.LEAD_REASON),
        ]
        return quality.union_rejects(
            *[quality.quarantine(quality.split(df, rule)[1], source, reason, 1) for df, rule, source, reason in rules]
        )

    # The star schema after one load of the raw tables.

    def gold(self, table: str) -> DataFrame:
        builders = {
            "dim_company": lambda t: star.dim_company(t, conform.companies(self.bronze("companies"))),
            "dim_customer": lambda t: star.dim_customer(t, conform.customers(self.bronze("end_customers"), fixtures.AS_OF)),
            "dim_product": lambda t: star.dim_product(t, conform.products(self.bronze("products"))),
            "dim_device": lambda t: star.dim_device(t, self.good_web()),
            "dim_geo": lambda t: star.dim_geo(t, self.good_web()),
            "dim_date": lambda t: star.dim_date(t, fixtures.AS_OF),
            "fact_sales": lambda t: star.fact_sales(
                t, self.good_lines(), self.gold("dim_company"), self.gold("dim_customer"), self.gold("dim_product"), fixtures.NOW
            ),
            "fact_web_activity": lambda t: star.fact_web_activity(
                t, self.good_web(), self.gold("dim_geo"), self.gold("dim_device"), self.gold("dim_customer")
            ),
            "fact_marketing_lead": lambda t: star.fact_marketing_lead(t, self.good_leads(), 1),
        }
        return self._once(table, lambda: self._written(builders[table](self.empty(table)), table))

    # The star schema as the earlier load left it.

    def earlier_gold(self, table: str) -> DataFrame:
        builders = {
            "dim_company": lambda t: star.dim_company(t, conform.companies(self.bronze_earlier("companies"))),
            "dim_customer": lambda t: star.dim_customer(t, conform.customers(self.bronze_earlier("end_customers"), fixtures.AS_OF)),
            "dim_product": lambda t: star.dim_product(t, conform.products(self.bronze_earlier("products"))),
            "dim_device": lambda t: star.dim_device(t, self.earlier_web().filter("device_type <> 'Desktop'")),
            "dim_geo": lambda t: star.dim_geo(t, self.earlier_web().withColumn("country", F.lit("Nowhere"))),
            "fact_sales": lambda t: star.fact_sales(
                t, self.earlier_lines(), self.gold("dim_company"), self.gold("dim_customer"), self.gold("dim_product"),
                fixtures.EARLIER_NOW,
            ),
            "fact_web_activity": lambda t: star.fact_web_activity(
                t, self.earlier_web().withColumn("batch_id", F.lit(0).cast("bigint")), self.gold("dim_geo"), self.gold("dim_device"),
                self.gold("dim_customer"),
            ),
            "fact_marketing_lead": lambda t: star.fact_marketing_lead(t, self.earlier_leads(), 1),
        }
        return self._once(f"earlier {table}", lambda: self._written(builders[table](self.empty(table)), table, "earlier_"))

    @staticmethod
    def _written(rows: DataFrame, table: str, label: str = "") -> DataFrame:
        """The first sales of all have been written by their merge."""
        return rows if table == "fact_sales" else materialize(rows, label + table)

    def earlier_lines(self) -> DataFrame:
        lines = conform.sales_lines(self.bronze_earlier("order_items"), self.bronze_earlier("orders"))
        return quality.split(lines, quality.sales_rule())[0]

    def earlier_web(self) -> DataFrame:
        return quality.split(conform.web_activity(self.bronze_earlier("weblogs")), quality.weblog_rule())[0]

    def earlier_leads(self) -> DataFrame:
        return quality.split(conform.lead_types(self.bronze_earlier("leads_csv")), quality.lead_rule())[0]

    # Files.

    @cached_property
    def leads_dir(self) -> str:
        """The leads as CSV files, so many leads each, in key order."""
        number = F.expr("CAST(substring(lead_id, 2) AS BIGINT)")
        leads = self.raw("leads_csv").withColumn("_n", number)
        path = scratch_path(self.spark, "leads")
        self._write_files(leads, LINES_PER_FILE["leads_csv"]).options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
        return path

    def write_log(self, path: str, first_file_only: bool = False) -> None:
        """The access log as text files, so many lines each, in line order: the first file, or those after it."""
        lines = self.raw("weblog_lines").select("raw_line", (F.col("source_line_number") - 1).alias("_n"))
        first = F.col("_n") < LINES_PER_FILE["weblog_lines"]
        self._write_files(lines.filter(first if first_file_only else ~first), LINES_PER_FILE["weblog_lines"]).mode("append").text(path)

    @cached_property
    def log_dir(self) -> str:
        path = scratch_path(self.spark, "weblogs")
        self.write_log(path, first_file_only=True)
        self.write_log(path)
        return path

    @staticmethod
    def _write_files(df: DataFrame, rows_per_file: int):
        chunked = df.withColumn("chunk", F.floor(F.col("_n") / rows_per_file))
        sorted_rows = chunked.repartition("chunk").sortWithinPartitions("chunk", "_n").drop("_n")
        return sorted_rows.write.partitionBy("chunk")


_known: dict[tuple[str, str], Inputs] = {}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """One `Inputs` per application and folder, so that queries share the written star schema."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _known:
        _known[key] = Inputs(spark, sf_dir)
    return _known[key]
