"""Time the headline analyses; prints one JSON line.

The tables of $BENCH_SF_DIR are first loaded into a star schema, as the shop's
data would be (``load_star``, timed, but not part of the total). Every analysis
then runs three times over the loaded tables, computing its whole result into
the noop sink; the median of the second and third run counts.

    python bench.py            headline analyses on the loaded star
    python bench.py NAME ...   registered queries straight on the given tables
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.query_catalog import QUERIES  # noqa: E402
from ordersight.operators import anomaly, cohort, marts, ranking, rfm  # noqa: E402
from ordersight.plans.shared_store import drop_stored, run_folder  # noqa: E402
from ordersight.session import build_session  # noqa: E402
from ordersight.sources import published  # noqa: E402
from ordersight.sources.driver_tables import star_from_driver_tables  # noqa: E402
from ordersight.sources.star_tables import StarHome, store_star  # noqa: E402

HEADLINE = {
    "rfm_segments_detail": rfm.rfm_segments_detail,
    "rfm_segment_summary": rfm.rfm_segment_summary,
    "rfm_segments_mart": marts.rfm_segments_mart,
    "cohort_retention": cohort.cohort_retention,
    "cohort_pivot": cohort.cohort_pivot,
    "repurchase_interval": cohort.repurchase_interval,
    "product_ranking": ranking.product_ranking,
    "top_products": ranking.top_products,
    "payment_outliers": anomaly.payment_outliers,
    "weekly_sales_drop": partial(anomaly.weekly_sales_drop, min_prev=2),
    "daily_volume_outliers": anomaly.daily_volume_outliers,
    "late_deliveries": anomaly.late_deliveries,
    "product_week_zscore": anomaly.product_week_zscore,
    "seller_delivery_trend": ranking.seller_delivery_trend,
    "seller_trend_summary": ranking.seller_trend_summary,
    "kpi_general": marts.kpi_general,
    "revenue_monthly": marts.revenue_monthly,
    "top_categories": marts.top_categories,
    "delivery_performance": marts.delivery_performance,
}
RUNS = 3


def timed(action: Callable[[], None]) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median_time(make: Callable[[], DataFrame]) -> float:
    def run() -> None:
        make().write.format("noop").mode("overwrite").save()

    return round(statistics.median([timed(run) for _ in range(RUNS)][1:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(cpus),
        spark__ui__enabled="false",
        # The default of 1 MB would run most stages of so little data as one task.
        spark__sql__adaptive__coalescePartitions__minPartitionSize="128k",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    extra: dict[str, float] = {}
    if sys.argv[1:]:
        for name in sys.argv[1:]:
            seconds[name] = median_time(partial(QUERIES[name], spark, folder))
    else:
        place = f"{run_folder(spark)}/bench"
        home = StarHome(f"{place}/star", database="bench", buckets=cpus)
        start = time.perf_counter()
        star = store_star(star_from_driver_tables(spark, folder), home)
        extra["load_star"] = round(time.perf_counter() - start, 3)
        for name, operator in HEADLINE.items():
            seconds[name] = median_time(partial(operator, star))
        # A dashboard chart reads a result stored after the last load.
        published.publish_mart(marts.revenue_monthly(star), f"{place}/marts", "revenue_monthly")
        seconds["dashboard_chart_stored"] = median_time(
            partial(published.read_mart, spark, f"{place}/marts", "revenue_monthly")
        )
    print(
        json.dumps(
            {
                "metric": "headline analyses, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                **extra,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    drop_stored(spark)
    spark.stop()


if __name__ == "__main__":
    main()
