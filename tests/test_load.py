from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata import fixed, schemas, session
from strata.operators import conform, quality, star
from strata.plans import audit, fixtures, load, reports
from strata.plans.inputs import inputs
from strata.sources import files, tables

SF_DIR = "/root/testdata/sf0.001"
FACTS = {"fact_sales": "source_order_item_id", "fact_web_activity": "source_log_id", "fact_marketing_lead": "source_lead_id"}


def make_sources(spark):
    i = inputs(spark, SF_DIR)
    leads = i.leads_dir
    raw = {t: (lambda t=t: i.raw(t)) for t in ("companies", "end_customers", "products", "orders", "order_items", "weblogs")}
    return raw | {"marketing_leads": lambda: files.read_leads(spark, leads)}


def run(spark, root, sources):
    return load.run_load(spark, root, sources, fixtures.AS_OF, fixtures.NOW)


def content(w, table):
    return sorted(map(repr, w.gold(table).drop("updated_at", "etl_batch_id").collect()))


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    assert run(spark, root, make_sources(spark)) == (1, ["bronze", "silver", "gold"])
    return load.Warehouse(spark, root)


def test_load_equals_the_single_steps(spark, loaded):
    i = inputs(spark, SF_DIR)
    for table in schemas.GOLD:
        expected = sorted(map(repr, i.gold(table).select(*schemas.GOLD[table].names).drop("updated_at", "etl_batch_id").collect()))
        assert content(loaded, table) == expected, table


def test_no_row_is_lost_on_the_way(spark, loaded):
    counts = {(r.table, r.verdict): r.rows for r in load.verdict_counts(loaded).collect()}
    i = inputs(spark, SF_DIR)
    for table, rows in {"sales_order_lines": i.lines(), "web_activity": i.web(), "marketing_leads": i.leads()}.items():
        assert sum(n for (t, _), n in counts.items() if t == table) == rows.count()
        assert counts[table, quality.GOOD] == loaded.judged(table, quality.GOOD).count()
    rejected = {r.source_name: r.rejected for r in quality.reject_counts(loaded.quarantine()).collect()}
    assert rejected[None] == sum(n for (_, v), n in counts.items() if v == quality.BAD)
    good = loaded.judged("sales_order_lines", quality.GOOD)
    dims = [loaded.gold(f"dim_{d}") for d in ("company", "customer", "product")]
    assert loaded.gold("fact_sales").count() + star.unmatched_lines(good, *dims).count() == good.count()


def test_lines_without_a_dimension_row_are_counted(spark, loaded):
    good = loaded.judged("sales_order_lines", quality.GOOD)
    company, customer, product = (loaded.gold(f"dim_{d}") for d in ("company", "customer", "product"))
    few = customer.filter("customer_key <= 60")
    kept, left = star.fact_sales_lookup(good, company, few, product), star.unmatched_lines(good, company, few, product)
    assert 0 < kept.count() < good.count()
    assert kept.count() + left.count() == good.count()


def test_second_load_changes_no_content_and_no_keys(spark, loaded):
    before = {t: content(loaded, t) for t in schemas.GOLD}
    batch, ran = run(spark, loaded.root, make_sources(spark))
    assert (batch, ran) == (2, ["bronze", "silver", "gold"])
    assert {t: content(loaded, t) for t in schemas.GOLD} == before
    batches = {t: {r[0] for r in loaded.gold(t).select("etl_batch_id").distinct().collect()} for t in FACTS}
    assert batches == {"fact_sales": {2}, "fact_web_activity": {1}, "fact_marketing_lead": {2}}
    for dim in ("company", "customer", "product", "device", "geo"):
        keys = [r[0] for r in loaded.gold(f"dim_{dim}").select(f"{dim}_key").collect()]
        assert sorted(keys) == list(range(1, len(keys) + 1))
    for table, key in FACTS.items():
        assert loaded.gold(table).count() == loaded.gold(table).select(key).distinct().count()
    # Web rows of the first batch were not written again.
    again = tables.read_data(spark, loaded.path("gold", "fact_web_activity"), 2, "source_log_id LONG")
    assert again.count() == 0
    runs = audit.job_runs(loaded.events("job_events"))
    assert runs.count() == 6 and {r.status for r in runs.collect()} == {"SUCCESS"}


def test_reports_are_replaced(spark, loaded):
    for _ in range(2):
        load.refresh_reports(loaded, fixtures.AS_OF)
    web, sales = loaded.gold("fact_web_activity"), loaded.gold("fact_sales")
    devices = loaded.report("report_top_devices").orderBy("rank_no").collect()
    assert devices == reports.top_devices(web, loaded.gold("dim_device")).orderBy("rank_no").collect()
    products = reports.top_products(web, sales, loaded.gold("dim_geo"), loaded.gold("dim_product"))
    assert loaded.report("report_top_products_in_top_country").orderBy("rank_no").collect() == products.orderBy("rank_no").collect()
    months = reports.monthly_sales(sales, loaded.gold("dim_date"), fixtures.AS_OF).collect()
    assert loaded.report("report_monthly_sales_last_year").orderBy(F.desc("month_start")).collect() == months


@pytest.mark.parametrize("layer", ["bronze", "silver", "gold"])
def test_failed_layer_is_taken_up_again(spark, tmp_path, monkeypatch, layer, loaded):
    root, sources = str(tmp_path / "w"), make_sources(spark)
    names = ["bronze", "silver", "gold"]

    def broken(*_):
        raise RuntimeError("x" * 300)

    with monkeypatch.context() as m:
        m.setattr(load, f"load_{layer}", broken)
        with pytest.raises(RuntimeError):
            run(spark, root, sources)
    w = load.Warehouse(spark, root)
    failed = audit.batch_status(w.events("batch_events")).first()
    assert (failed.status, failed.error_message) == ("FAILED", "x" * 255)
    states = {r.layer_name: r.status for r in audit.layer_state(w.events("layer_events")).collect()}
    at = names.index(layer)
    assert [states[n] for n in fixed.LAYERS] == ["SUCCESS"] * at + ["FAILED"] + ["PENDING"] * (2 - at)
    assert run(spark, root, sources) == (1, names[at:])
    assert audit.batch_status(w.events("batch_events")).first().status == "SUCCESS"
    assert content(w, "fact_sales") == content(loaded, "fact_sales")


def test_failure_in_the_middle_of_gold_repeats_nothing(spark, tmp_path, monkeypatch, loaded):
    root, sources = str(tmp_path / "w"), make_sources(spark)
    whole = tables.publish

    def stops_at_sales(spark, path, *rest):
        if path.endswith("fact_sales"):
            raise OSError("lost")
        return whole(spark, path, *rest)

    with monkeypatch.context() as m:
        m.setattr(tables, "publish", stops_at_sales)
        with pytest.raises(OSError):
            run(spark, root, sources)
    assert run(spark, root, sources) == (1, ["gold"])
    w = load.Warehouse(spark, root)
    for table in ("dim_geo", "dim_customer", "fact_sales", "fact_web_activity"):
        assert content(w, table) == content(loaded, table)


def sales(spark, rows):
    return spark.createDataFrame(rows, "id long, date_key int, v string")


SALES_SCHEMA = schemas.StructType.fromJson(
    {"type": "struct", "fields": [{"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in [("id", "long"), ("date_key", "integer"), ("v", "string")]]}
)


def test_only_touched_months_are_written_again(spark, tmp_path):
    from strata.operators.merge import merged

    path, now, month = str(tmp_path / "t"), datetime(2001, 1, 1), tables.month_part()
    tables.publish(spark, path, sales(spark, [(1, 20010105, "a"), (2, 20010205, "b"), (3, 20010305, "c"), (4, None, "d")]), now, month)
    updates = sales(spark, [(2, 20010406, "B"), (4, 20010407, "D"), (9, 20010305, "n")])  # row 2 and 4 move to another month
    touched = tables.touched_parts(tables.read_table(spark, path, SALES_SCHEMA), updates, ["id"], month)
    assert sorted(touched) == [0, 200102, 200103, 200104]
    old = tables.read_table(spark, path, SALES_SCHEMA, touched)
    assert sorted(r.id for r in old.collect()) == [2, 3, 4]
    version = tables.publish(
        spark, path, merged(old, updates, ["id"], ["date_key", "v"], updates_rows=3).drop("_action"), now, month, touched
    )
    got = sorted(tuple(r) for r in tables.read_table(spark, path, SALES_SCHEMA).collect())
    assert got == [(1, 20010105, "a"), (2, 20010406, "B"), (3, 20010305, "c"), (4, 20010407, "D"), (9, 20010305, "n")]
    assert tables.read_data(spark, path, version, "id LONG").count() == 4


def test_unpublished_data_is_not_seen(spark, tmp_path):
    path, now = str(tmp_path / "t"), datetime(2001, 1, 1)
    tables.publish(spark, path, sales(spark, [(1, 20010105, "a")]), now)
    sales(spark, [(2, 20010105, "lost")]).write.parquet(f"{path}/data_version=2/_part=0")  # a crash before publishing
    assert [r.id for r in tables.read_table(spark, path, SALES_SCHEMA).collect()] == [1]
    tables.publish(spark, path, sales(spark, [(3, 20010105, "c")]), now)
    assert [r.id for r in tables.read_table(spark, path, SALES_SCHEMA).collect()] == [3]
    tables.publish(spark, path, sales(spark, [(4, 20010205, "d")]), now, replaces=[])
    for _ in range(2):
        assert sorted(r.id for r in tables.read_table(spark, path, SALES_SCHEMA).collect()) == [3, 4]
        tables.compact(spark, path, SALES_SCHEMA, now, tables.month_part())
    tables.publish(spark, path, sales(spark, []), now)
    assert tables.read_table(spark, path, SALES_SCHEMA).collect() == []


def test_batch_filter_reads_one_directory(spark, tmp_path):
    i = inputs(spark, SF_DIR)
    path = str(tmp_path / "b")
    files.write_full(i.bronze("orders", 1).unionByName(i.bronze("orders", 2)), path, "batch_id")
    one = conform.for_batch(spark.read.schema(schemas.BRONZE["orders"]).parquet(path), 2)
    assert one.count() == i.raw("orders").count()
    assert all("/batch_id=2/" in f for f in one.select(F.input_file_name()).distinct().toPandas().iloc[:, 0])


def test_months_written_do_not_depend_on_the_size_of_a_batch(spark, tmp_path, monkeypatch):
    """The row limit decides between broadcast and shuffle, not what is rewritten."""
    i, written = inputs(spark, SF_DIR), []
    for limit in (session.BROADCAST_ROWS, 0):
        w = load.Warehouse(spark, str(tmp_path / str(limit)))
        path = w.path("gold", "fact_sales")
        tables.publish(spark, path, i.gold("fact_sales"), fixtures.NOW, tables.month_part())
        one = i.gold("fact_sales").limit(1)
        with monkeypatch.context() as m:
            m.setattr(session, "BROADCAST_ROWS", limit)
            load.publish_merge(w, load._fact_updates(w, "fact_sales", "source_order_item_id", one, star.SALES_UPDATES)[0], fixtures.NOW)
        written.append(sorted(p.name for p in (tmp_path / str(limit) / "gold" / "fact_sales" / "data_version=2").iterdir() if p.is_dir()))
    assert written[0] == written[1] and len(written[0]) == 1


def test_unchanged_dimensions_get_no_new_version(spark, loaded):
    version = tables._current(spark, loaded.path("gold", "dim_geo"))[0]
    run(spark, loaded.root, make_sources(spark))
    assert tables._current(spark, loaded.path("gold", "dim_geo"))[0] == version


def test_counts_of_a_load_balance(spark, loaded):
    counts = {(r.table, r.outcome): r.rows for r in loaded.load_counts().filter("batch_id = 1").collect()}
    i = inputs(spark, SF_DIR)
    judged = sum(n for (t, o), n in counts.items() if t == "sales_order_lines")
    assert judged == i.raw("order_items").count()  # verdicts and orphans
    assert counts["fact_sales", "fact"] + counts["fact_sales", "unmatched"] == counts["sales_order_lines", quality.GOOD]
    assert counts["fact_sales", "insert"] == counts["fact_sales", "fact"]


def test_load_name_reaches_the_quarantine(spark, tmp_path):
    load.run_load(spark, str(tmp_path / "w"), make_sources(spark), fixtures.AS_OF, fixtures.NOW, load_name="other_load")
    names = load.Warehouse(spark, str(tmp_path / "w")).quarantine().select("job_name").distinct().collect()
    assert [r.job_name for r in names] == ["other_load"]


def test_scratch_needs_a_shared_folder_off_one_machine():
    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Session())
