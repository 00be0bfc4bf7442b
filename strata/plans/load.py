"""The load: raw tables to bronze, bronze to silver and quarantine, silver to the star schema, star schema to reports.

Functions elsewhere turn frames into frames; writing happens here. A layer starts only when the one before it is finished and marked so,
and a failed batch is taken up again at the layer where it stopped. Every step can be repeated: bronze and silver are replaced whole, the
quarantine per batch, and merges of rows already merged change nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata import fixed, schemas
from strata.operators import conform, merge, quality, spans, star
from strata.plans import audit, reports
from strata.session import materialize_counted, one_row
from strata.sources import files, jdbc, tables

Sources = Mapping[str, Callable[[], DataFrame]]

REJECTS = {
    "sales_order_lines": (quality.sales_rule, fixed.SALES_SOURCE, fixed.SALES_REASON),
    "web_activity": (quality.weblog_rule, fixed.WEBLOG_SOURCE, fixed.WEBLOG_REASON),
    "marketing_leads": (quality.lead_rule, fixed.LEAD_SOURCE, fixed.LEAD_REASON),
}


#: Which judged table each fact is looked up from.
FACT_SOURCES = {"fact_sales": "sales_order_lines", "fact_web_activity": "web_activity", "fact_marketing_lead": "marketing_leads"}


class Mark(NamedTuple):
    """How the new rows of a source table are told: by a time column, or by a key of another table (`of`) whose new rows are known."""

    column: str
    of: str | None = None


Marks = Mapping[str, Mark]
#: Tables of the source of which a load needs to read only what came since the last one. Lines come with their order.
BY_TIME: Marks = {"orders": Mark("order_timestamp"), "order_items": Mark("order_id", of="orders"), "weblogs": Mark("request_time")}


@dataclass(frozen=True)
class Warehouse:
    """Where the tables of a warehouse are."""

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def bronze(self, table: str, batch_id: int) -> DataFrame:
        return conform.for_batch(self.spark.read.schema(schemas.BRONZE[table]).parquet(self.path("bronze", table)), batch_id)

    def silver(self, table: str) -> DataFrame:
        return self.spark.read.schema(schemas.SILVER[table]).parquet(self.path("silver", table))

    def judged(self, table: str, verdict: str) -> DataFrame:
        """The rows of one verdict; each verdict is a directory of its own, so no others are read."""
        schema = StructType([*schemas.SILVER[table].fields, StructField("verdict", StringType())])
        rows = self.spark.read.schema(schema).parquet(self.path("silver", table))
        return rows.filter(F.col("verdict") == verdict).drop("verdict")

    def gold(self, table: str, parts: list[int] | None = None) -> DataFrame:
        return tables.read_table(self.spark, self.path("gold", table), schemas.GOLD[table], parts)

    def report(self, table: str) -> DataFrame:
        """As it was written: a month's revenue may be wider than in `schemas.REPORTS`."""
        return self.spark.read.parquet(self.path("gold", table))

    def load_counts(self) -> DataFrame:
        return self.spark.read.parquet(self.path("audit", "load_counts"))

    def count(self, layer: str, batch_id: int, counts: Mapping[tuple[str, str], int]) -> None:
        """Keep what the writes of a layer have counted: a few rows a table. Repeating a batch replaces them."""
        rows = [(table, outcome, n) for (table, outcome), n in counts.items()]
        frame = self.spark.createDataFrame(rows, "table string, outcome string, rows long")
        files.write_full(frame.coalesce(1), f"{self.path('audit', 'layer_counts')}/batch_id={batch_id}/layer={layer}")

    def counted(self, batch_id: int) -> dict[tuple[str, str], int]:
        """What the layers of a batch have counted so far."""
        seen = self.spark.read.schema("table string, outcome string, rows long, batch_id long, layer string").parquet(self.path("audit", "layer_counts"))
        return {(r.table, r.outcome): r.rows for r in conform.for_batch(seen, batch_id).collect()}

    def committed_mark(self, load_name: str) -> datetime | None:
        """Up to when a load has taken in its sources: the last mark of a bronze layer that succeeded."""
        state = audit.layer_state(self.events("layer_events"))
        row = state.filter((F.col("pipeline_name") == load_name) & (F.col("layer_name") == fixed.BRONZE)).first()
        return None if row is None else row.last_watermark

    def quarantine(self) -> DataFrame:
        return files.read_quarantine(self.spark, self.path("audit", "quarantine_records"))

    def events(self, table: str) -> DataFrame:
        return tables.read_or_create(self.spark, self.path("audit", table), schemas.AUDIT[table])

    def log(self, table: str, **values) -> int:
        """Append one event; returns its number."""
        seq = time.time_ns()
        event = one_row(self.spark, schemas.AUDIT[table], **{"seq": seq, "event_time": datetime.now(), **values})
        event.write.mode("append").parquet(self.path("audit", table))
        return seq


def database_sources(spark: SparkSession, url: str, props: dict[str, str], leads_path: str, ranges: int) -> Sources:
    """The source tables in a database, the large ones read in key ranges, and the leads file."""

    def whole(table: str):
        return lambda: jdbc.read_jdbc(spark, url, f"source.{table}", props)

    def ranged(table: str, key: str):
        return jdbc.LargeTable(spark, url, f"source.{table}", key, ranges, props)

    return {
        "companies": whole("companies"),
        "end_customers": whole("end_customers"),
        "products": whole("products"),
        "orders": ranged("orders", "order_id"),
        "order_items": ranged("order_items", "order_item_id"),
        "weblogs": ranged("weblogs", "log_id"),
        "marketing_leads": lambda: files.read_leads(spark, leads_path, located=True),
    }


def together(*steps: Callable[[], object]) -> list:
    """Run independent writes side by side, so that small tables do not hold up the cluster. Fails when one of them fails."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [started.result() for started in [pool.submit(step) for step in steps]]


def load_bronze(
    w: Warehouse, sources: Sources, batch_id: int, now: datetime, alignment: str = "exact", marks: Marks | None = None,
    after: datetime | None = None, only: Collection[str] = tuple(schemas.BRONZE),
) -> None:
    """Copy the source tables (or `only` some), stamped with batch and lineage. Of tables in `marks` only what lies after `after` and not
    after `now` is read; the bound reaches the scan.

    A table whose rows come with those of another (`of`) is copied after it, by the keys that the other's copy holds: they are not
    looked for in the source again, where more may have come since, and spans of them reach the scan. Where `only` leaves the other out,
    its rows are taken from the source.
    """
    marks = marks or {}

    def dated(table: str, column: str) -> DataFrame:
        source = sources[table]
        rows = source.between(column, after, now) if isinstance(source, jdbc.LargeTable) else source()
        return conform.beyond(rows, column, after, now)

    def taken(table: str) -> DataFrame:
        mark = marks.get(table)
        if mark is None:
            return sources[table]()
        if mark.of is None:
            return dated(table, mark.column)
        known = w.bronze(mark.of, batch_id) if mark.of in only else taken(mark.of)
        keys, source = known.select(mark.column), sources[table]
        rows = source.matching(mark.column, keys) if isinstance(source, jdbc.LargeTable) else source()
        return spans.narrowed(rows, keys, mark.column).join(keys, mark.column, "left_semi")

    def copy(table: str) -> int:
        rows = taken(table)
        if table == "marketing_leads":
            rows = conform.add_lineage(rows, now)
        aligned = conform.align_schema(conform.stamp_batch(rows, batch_id), schemas.BRONZE[table], alignment)
        return files.write_full(aligned, w.path("bronze", table), counts=rows_counted())["rows"]

    def copies(table: str) -> dict[str, int]:
        """Rows of a table, and of those that are copied by its keys, once it is there."""
        rows = copy(table)
        later = [partial(copies, t) for t in only if t in marks and marks[t].of == table]
        return reduce(lambda x, y: x | y, together(*later) if later else [], {table: rows})

    first = [t for t in only if t not in marks or marks[t].of not in only]
    copied = reduce(lambda x, y: x | y, together(*[partial(copies, table) for table in first]) if first else [], {})
    if len(copied) < len(only):
        raise ValueError(f"marks of {', '.join(t for t in only if t not in copied)} wait for each other")
    w.count("bronze", batch_id, {(table, "raw"): n for table, n in copied.items()})


def load_silver(w: Warehouse, batch_id: int, as_of: date, load_name: str = fixed.LOAD_NAME) -> None:
    """Each table is conformed, judged and written once; accepted and rejected rows are then read back."""
    conformed = {
        "companies": conform.companies(w.bronze("companies", batch_id)),
        "customers": conform.customers(w.bronze("end_customers", batch_id), as_of),
        "products": conform.products(w.bronze("products", batch_id)),
        "sales_order_lines": conform.sales_lines(w.bronze("order_items", batch_id), w.bronze("orders", batch_id)),
        "web_activity": conform.web_activity(w.bronze("weblogs", batch_id)),
        "marketing_leads": conform.lead_types(w.bronze("marketing_leads", batch_id)),
    }

    def write(table: str, rows: DataFrame) -> dict[tuple[str, str], int]:
        if table not in REJECTS:
            files.write_full(rows, w.path("silver", table))
            return {}
        verdicts = {v: F.count_if(F.col("verdict") == v) for v in (quality.GOOD, quality.BAD, quality.UNDECIDED)}
        seen = files.write_full(quality.with_verdict(rows, REJECTS[table][0]()), w.path("silver", table), "verdict", verdicts)
        return {(table, v): n for v, n in seen.items() if n}

    counts = together(*[partial(write, table, rows) for table, rows in conformed.items()])
    w.count("silver", batch_id, reduce(lambda x, y: x | y, counts))

    rejects = quality.union_rejects(
        *[quality.quarantine(w.judged(t, quality.BAD), source, reason, batch_id, load_name) for t, (_, source, reason) in REJECTS.items()]
    )
    files.append_quarantine(rejects, w.path("audit", "quarantine_records"), batch_id)


def verdict_counts(w: Warehouse) -> DataFrame:
    """Rows per conformed table and verdict, from the file footers."""
    counts = []
    for table in REJECTS:
        judged = w.spark.read.schema("verdict STRING").parquet(w.path("silver", table))
        counts.append(judged.groupBy(F.lit(table).alias("table"), "verdict").agg(F.count("*").alias("rows")))
    return reduce(DataFrame.unionByName, counts)


class Merge(NamedTuple):
    """One table's merged rows with their actions (None: nothing to write), which old parts they replace (None: all), the rows by
    action where an earlier write has counted them, and the key by which later batches look rows up (see `tables.publish`)."""

    table: str
    actions: DataFrame | None
    part: Column | None = None
    replaces: list[int] | None = None
    counts: dict[str, int] | None = None
    key: tuple[str, ...] = ()


def publish_merge(w: Warehouse, m: Merge, now: datetime) -> dict[str, int]:
    """Make a merge the current version of its table. Returns rows inserted, updated and kept, as counted by the write."""
    if m.actions is None:
        return m.counts or {}
    tally = tables.Tally({} if m.counts is not None else merge.action_counts())
    tables.publish(w.spark, w.path("gold", m.table), m.actions, now, m.part, m.replaces, tally, None, m.key)
    return m.counts if m.counts is not None else {a: n for a, n in tally.seen.items() if n}


def _dimension(table: str, keyed: merge.Keyed) -> Merge:
    """A dimension whose content stays the same gets no new version; one that only grows gets its new rows."""
    if keyed.changed:
        return Merge(table, keyed.rows, counts=keyed.counts)
    grown = keyed.rows.filter(F.col("_action") == merge.INSERT) if keyed.counts.get(merge.INSERT) else None
    return Merge(table, grown, replaces=[], counts=keyed.counts)


def _calendar(w: Warehouse, as_of: date) -> Merge:
    held, seen = materialize_counted(star.date_actions(w.gold("dim_date"), as_of), "days", merge.action_counts())
    return _dimension("dim_date", merge.Keyed(held, {a: n for a, n in seen.items() if n}, 0))


def _fact_updates(w: Warehouse, table: str, key: str, rows: DataFrame, update_cols: tuple[str, ...]) -> tuple[Merge, int]:
    """A merge into a fact split by month, and the number of its updates: only the months that updates touch are rewritten, however many
    updates there are."""
    part = tables.month_part()
    rows, seen = materialize_counted(rows, "updates", rows_counted())  # looked up once, used several times
    touched = tables.touched_parts(w.gold(table), rows, [key], part, seen["rows"])
    actions = merge.merged(w.gold(table, touched), rows, [key], update_cols, updates_rows=seen["rows"])
    return Merge(table, actions, part, touched, key=(key,)), seen["rows"]


def rows_counted() -> dict[str, Column]:
    """What a write counts where only the number of rows matters."""
    return {"rows": F.count(F.lit(1))}


def load_counts(w: Warehouse, batch_id: int) -> list[tuple[str, str, int]]:
    """Where the rows of a batch went, as table, outcome and rows: the verdicts of each judged table; order items without an order
    ("orphan"); and accepted rows that found a dimension ("fact") or not ("unmatched"). Verdicts and orphans add up to the raw rows, facts
    and unmatched rows to the accepted ones.

    All of it follows from what the layers' writes have counted: every order has one row in its table and every key one in its dimension, so
    what a join leaves out is what it was given less what it gave. Nothing is joined or read here but these counts.
    """
    seen = w.counted(batch_id)
    out = [(table, verdict, n) for (table, verdict), n in seen.items() if table in REJECTS]
    judged = sum(n for table, _, n in out if table == "sales_order_lines")
    if ("order_items", "raw") in seen:
        out.append(("sales_order_lines", "orphan", seen["order_items", "raw"] - judged))
    for fact, source in FACT_SOURCES.items():
        if (fact, "fact") in seen:
            out += [(fact, "fact", seen[fact, "fact"]), (fact, "unmatched", seen.get((source, quality.GOOD), 0) - seen[fact, "fact"])]
    return out


def record_counts(w: Warehouse, batch_id: int, merges: dict[str, dict[str, int]]) -> None:
    """Write the batch's counts, and those of its merges by action, to the audit tables. Repeating a batch replaces them."""
    rows = load_counts(w, batch_id) + [(table, action, n) for table, actions in merges.items() for action, n in actions.items()]
    counts = w.spark.createDataFrame(rows, "table string, outcome string, rows long")  # a few rows a table
    files.write_full(counts.coalesce(1), f"{w.path('audit', 'load_counts')}/batch_id={batch_id}")


def load_gold(w: Warehouse, batch_id: int, as_of: date, now: datetime) -> dict[str, dict[str, int]]:
    """Dimensions, then facts. Returns the rows of each merge by action, and records them with the batch's other counts."""
    web, lines, leads = (w.judged(t, quality.GOOD) for t in ("web_activity", "sales_order_lines", "marketing_leads"))

    def publish_all(merges: dict[str, Callable[[], Merge]]) -> dict[str, dict[str, int]]:
        done = together(*[lambda build=build: publish_merge(w, build(), now) for build in merges.values()])
        return dict(zip(merges, done))

    counts = publish_all(
        {
            "dim_company": lambda: _dimension("dim_company", star.company_merge(w.gold("dim_company"), w.silver("companies"))),
            "dim_customer": lambda: _dimension("dim_customer", star.customer_merge(w.gold("dim_customer"), w.silver("customers"))),
            "dim_product": lambda: _dimension("dim_product", star.product_merge(w.gold("dim_product"), w.silver("products"))),
            "dim_device": lambda: _dimension("dim_device", star.device_merge(w.gold("dim_device"), web)),
            "dim_geo": lambda: _dimension("dim_geo", star.geo_merge(w.gold("dim_geo"), web)),
            "dim_date": lambda: _calendar(w, as_of),
        }
    )
    company, customer, product = w.gold("dim_company"), w.gold("dim_customer"), w.gold("dim_product")
    facts: dict[tuple[str, str], int] = {}

    def sales() -> Merge:
        rows = star.sales_rows(lines, company, customer, product, now)
        done, facts["fact_sales", "fact"] = _fact_updates(w, "fact_sales", "source_order_item_id", rows, star.SALES_UPDATES)
        return done

    def activity() -> Merge:
        # Known log rows stay as they are, so only new ones are written; the months before are listed again. Of those only the ids
        # that the batch can have are read.
        found = star.fact_web_lookup(web, w.gold("dim_geo"), w.gold("dim_device"), customer)
        rows, seen = materialize_counted(found, "updates", rows_counted())
        facts["fact_web_activity", "fact"] = seen["rows"]
        held = spans.narrowed(w.gold("fact_web_activity"), rows, "source_log_id", seen["rows"])
        actions = merge.merged(held, rows, ["source_log_id"], [], on_duplicate="first", first_by=star.WEB_FIRST, updates_rows=seen["rows"])
        return Merge("fact_web_activity", actions.filter(F.col("_action") == merge.INSERT), tables.month_part(), [], key=("source_log_id",))

    def scored_leads() -> Merge:
        rows = star.lead_rows(leads, batch_id)
        done, facts["fact_marketing_lead", "fact"] = _fact_updates(w, "fact_marketing_lead", "source_lead_id", rows, star.LEAD_UPDATES)
        return done

    counts |= publish_all({"fact_sales": sales, "fact_web_activity": activity, "fact_marketing_lead": scored_leads})
    w.count("gold", batch_id, facts)
    record_counts(w, batch_id, counts)
    return counts


def refresh_sales_days(w: Warehouse, now: datetime) -> list[int]:
    """Bring the days behind the monthly report up to date. Only months of the sales fact that a merge has written since are read, and
    only theirs replaced. Returns these months. Which they are follows from the versions of both tables, so a refresh that was left out or
    broke off is made up for by the next one."""
    path = w.path("gold", "sales_days")
    days = tables.read_table(w.spark, path, schemas.SALES_DAYS)
    known = {r.month: r.fact_version for r in days.groupBy(F.expr("date_key div 100").alias("month")).agg(F.min("fact_version").alias("fact_version")).collect()}
    current = tables.part_versions(w.spark, w.path("gold", "fact_sales"))
    stale = sorted(m for m, v in current.items() if m != tables.WHOLE and known.get(m) != v)  # part 0 holds sales without a date
    gone = [m for m in known if m not in current]
    if not stale and not gone:
        return []
    sales = w.gold("fact_sales", stale)
    held, seen = materialize_counted(reports.sales_days(sales), "days", {"split": F.sum("split_orders")})  # a row a day
    if seen["split"]:
        raise ValueError("an order lies on several days of a month")
    versions = F.create_map(*[F.lit(x) for m in stale for x in (m, current[m])]) if stale else F.create_map(F.lit(0), F.lit(0))
    fresh = held.withColumn("fact_version", F.get(F.map_values(F.map_filter(versions, lambda m, _: m == F.expr("date_key div 100"))), F.lit(0)).cast("bigint"))
    tables.publish(w.spark, path, fresh.select(*schemas.SALES_DAYS.names), now, tables.month_part(), [*stale, *gone])
    return stale


def refresh_reports(w: Warehouse, as_of: date) -> None:
    """Replace the three report tables. The logins per customer and country feed two parts of one report, so they are held meanwhile."""
    refresh_sales_days(w, datetime.now())
    days = tables.read_table(w.spark, w.path("gold", "sales_days"), schemas.SALES_DAYS)
    web, sales = w.gold("fact_web_activity"), w.gold("fact_sales")
    logins = reports.customer_country_logins(web.filter(F.col("customer_key").isNotNull()), w.gold("dim_geo")).persist()
    results = {
        "report_top_devices": reports.top_devices(web, w.gold("dim_device")),
        "report_top_products_in_top_country": reports.top_products(web, sales, w.gold("dim_geo"), w.gold("dim_product"), logins),
        "report_monthly_sales_last_year": reports.monthly_from_days(days, w.gold("dim_date"), as_of),
    }
    try:
        together(*[partial(files.write_full, rows, w.path("gold", table)) for table, rows in results.items()])
    finally:
        logins.unpersist()


def next_batch(w: Warehouse, load_name: str) -> tuple[int, str]:
    """(batch, first layer to run): the failed last batch from where it stopped, or a new batch from bronze."""
    batches = audit.batch_status(w.events("batch_events"))
    point = audit.resume_point(batches, audit.layer_state(w.events("layer_events"))).filter(F.col("pipeline_name") == load_name).first()
    if point is not None and point.restart_batch_id is not None:
        return point.restart_batch_id, point.resume_from_layer
    last = batches.agg(F.max("batch_id")).first()[0]
    return (last or 0) + 1, "bronze"


def run_load(
    spark: SparkSession, root: str, sources: Sources, as_of: date, now: datetime, load_name: str = fixed.LOAD_NAME, alignment: str = "exact",
    marks: Marks | None = None,
) -> tuple[int, list[str]]:
    """Run the next batch. Returns its number and the layers that ran. alignment: how source columns are matched, see `align_schema`.

    marks (such as BY_TIME): of these tables read only what came after the last committed mark, up to `now`, which becomes the mark when
    the bronze layer has succeeded. A batch that failed before that is read again from the same mark; without marks all is read, and the
    mark stays where it was.
    """
    w = Warehouse(spark, root)
    batch_id, first = next_batch(w, load_name)
    after = w.committed_mark(load_name) if marks and first == "bronze" else None
    w.log("batch_events", batch_id=batch_id, pipeline_name=load_name, status=fixed.RUNNING)

    work = {
        "bronze": (fixed.BRONZE, lambda: load_bronze(w, sources, batch_id, now, alignment, marks, after), now if marks else None),
        "silver": (fixed.SILVER, lambda: load_silver(w, batch_id, as_of, load_name), None),
        "gold": (fixed.GOLD, lambda: load_gold(w, batch_id, as_of, now), None),
    }
    names = list(work)
    todo = names[names.index(first) :]
    try:
        for name in todo:
            run_layer(w, load_name, batch_id, *work[name])
    except BaseException as problem:
        w.log("batch_events", batch_id=batch_id, pipeline_name=load_name, status=fixed.FAILED, error_message=str(problem))
        raise
    w.log("batch_events", batch_id=batch_id, pipeline_name=load_name, status=fixed.SUCCESS)
    return batch_id, todo


def run_layer(w: Warehouse, load_name: str, batch_id: int, layer: str, work: Callable[[], object], mark: datetime | None = None) -> None:
    """Run one layer between its events. mark: up to when the sources are taken in once it has succeeded."""
    job = time.time_ns()

    def log(status: str, error: str | None = None, until: datetime | None = None) -> None:
        w.log("job_events", job_run_id=job, batch_id=batch_id, job_name=layer, status=status, error_message=error)
        w.log("layer_events", pipeline_name=load_name, layer_name=layer, batch_id=batch_id, status=status, last_watermark=until)

    log(fixed.RUNNING)
    try:
        work()
    except Exception as problem:
        log(fixed.FAILED, str(problem))
        raise
    log(fixed.SUCCESS, until=mark)
