"""Times the load and the headline queries and prints one JSON line. Input: $BENCH_SF_DIR, cores: $BENCH_CPUS."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.operators import quality  # noqa: E402
from strata.plans import fixtures, load, reports  # noqa: E402
from strata.plans.catalog import QUERIES  # noqa: E402
from strata.plans.inputs import inputs  # noqa: E402
from strata.session import build_session, materialize  # noqa: E402
from strata.sources import files  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def median(work, repeats: int = REPEATS) -> float:
    """Of several runs after a first one, which compiles."""
    work()
    return statistics.median(timed(work) for _ in range(repeats))


def run_all(df) -> None:
    """Compute every row and column, keep none."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    i = inputs(spark, SF_DIR)
    for table in ("orders", "order_items", "weblogs"):  # written once, so that the operators are timed and not the making of their input
        i._frames[f"raw {table}"] = materialize(i.raw(table), table)
    leads = i.leads_dir
    sources = {t: (lambda t=t: i.raw(t)) for t in ("companies", "end_customers", "products", "orders", "order_items", "weblogs")}
    sources["marketing_leads"] = lambda: files.read_leads(spark, leads)
    root = tempfile.mkdtemp(prefix="bench-")
    w = load.Warehouse(spark, root)

    seconds = {}
    seconds["load_first_batch"] = timed(lambda: load.run_load(spark, root, sources, fixtures.AS_OF, fixtures.NOW))
    seconds["load_second_batch"] = timed(lambda: load.run_load(spark, root, sources, fixtures.AS_OF, fixtures.NOW))
    seconds["load_bronze"] = timed(lambda: load.load_bronze(w, sources, 3, fixtures.NOW))
    seconds["load_silver"] = timed(lambda: load.load_silver(w, 3, fixtures.AS_OF))
    seconds["load_gold"] = timed(lambda: load.load_gold(w, 3, fixtures.AS_OF, fixtures.NOW))
    seconds["report_tables"] = median(lambda: load.refresh_reports(w, fixtures.AS_OF))

    web, sales = w.gold("fact_web_activity"), w.gold("fact_sales")
    geo, device, product, days = (w.gold(f"dim_{d}") for d in ("geo", "device", "product", "date"))
    seconds["R1_top_devices"] = median(lambda: run_all(reports.top_devices(web, device)))
    seconds["R2_top_products_in_top_country"] = median(lambda: run_all(reports.top_products(web, sales, geo, product)))
    seconds["R3_monthly_sales_last_year"] = median(lambda: run_all(reports.monthly_sales(sales, days, fixtures.AS_OF)))
    seconds["J1_Q1_sales_lines_judged"] = median(
        lambda: run_all(quality.with_verdict(i.lines(), quality.sales_rule()))
    )
    for name in ("J3_fact_web_lookup", "M2_surrogate_keys", "M9_fact_sales", "M10_fact_web_activity", "S4_weblog_parse", "S5_line_numbers"):
        seconds[name] = median(lambda name=name: run_all(QUERIES[name](spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "seconds of the three reports from the star schema",
                "value": round(sum(v for k, v in seconds.items() if k[:2] in ("R1", "R2", "R3")), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "rows": {"fact_sales": sales.count(), "fact_web_activity": web.count()},
            }
        )
    )


if __name__ == "__main__":
    main()
