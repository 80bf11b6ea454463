"""Time the headline queries and print one JSON line.

Every query is run to the end with a no-op sink, once to warm up and then
BENCH_RUNS times; the best run counts.  Working copies (raw text, silver lines, options
and the marts the views read) are built first and reported as ``build_*``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dinerlake.operators.lines import enrich_lines  # noqa: E402
from dinerlake.plans.marts import daily_sales_by_store  # noqa: E402
from dinerlake.session import local_session  # noqa: E402
from dinerlake.sources import sample_tables  # noqa: E402
from verification.queries import all_queries  # noqa: E402
from verification.workspace import Workspace  # noqa: E402

HEADLINE = [
    "options_split_per_line", "orders_by_store", "orders_by_user",
    "g1_daily_sales_by_store", "g2_item_sales_by_day", "g3_customer_facts",
    "g4_discounts_by_day", "silver_dedupe_items", "silver_current_options",
    "seed_clean_items", "options_orphans", "loss_audit",
    "sales_trends_daily", "top_items_30d", "category_mix_monthly_12m",
    "holiday_uplift_12m", "location_actions_90d", "churn_risk_latest",
    "discount_orders_90d", "daily_sales_matrix", "churn_medians", "category_drift",
    "report_discounted_vs_full_price", "report_month_weekday_sales",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session("dinerlake-bench", cores)
    queries, times = all_queries(), {}

    work = Workspace(spark, sf_dir)
    for name in (
        "items", "options", "raw_items", "raw_options", "raw_dates", "g1", "g2", "g3", "g4"
    ):
        times[f"build_{name}"] = timed(getattr(work, name))

    def straight() -> None:
        items = sample_tables.order_items(spark, sf_dir)
        options = sample_tables.options(spark, sf_dir)
        run(daily_sales_by_store(enrich_lines(items, options)))

    straight()
    times["g1_from_source"] = min(timed(straight) for _ in range(runs))
    for name in HEADLINE:
        def once(name: str = name) -> None:
            run(queries[name](spark, sf_dir))

        once()
        times[name] = min(timed(once) for _ in range(runs))
    spark.stop()
    times = {name: round(seconds, 3) for name, seconds in times.items()}
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
