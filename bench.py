"""Time the headline queries and print one JSON line: the faster of two runs of each.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores, BENCH_QUERIES (comma list) a choice.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quayside.plans.catalog import all_queries  # noqa: E402
from quayside.session import local_session  # noqa: E402

HEADLINE = """
monthly_trade_balance monthly_real_balance all_measures_total measure_totals_cube country_share_by_year concentration_by_year
year_over_year_by_month running_totals_by_year running_totals_by_country_month top_cities_by_exports top_countries_and_others
partner_tornado ranking_states_by_exports balance_matrix category_exports_by_year partners_by_month active_cities_by_state
top_category_by_year sliced_category_exports category_lead_streak silver_exports silver_cities silver_index fact_trades
quality_orders normalized_documents customer_upsert landing_manifest shipping_calendar narrative_balance
quality_silver quality_gold silver_exports_incremental fact_trades_incremental fact_partition_upsert streamed_load
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = local_session("bench", cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    queries["data_span"](spark, sf_dir).collect()  # start the executors
    times = {}
    for name in chosen * 2:  # the first round also compiles; building the plan is part of the time
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent = round(time.perf_counter() - start, 3)
        times[name] = min(spent, times.get(name, spent))
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": Path(sf_dir).name}))
    spark.stop()


if __name__ == "__main__":
    main()
