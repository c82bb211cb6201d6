"""Command line: load raw files, write one report, refresh the KPI tables.

    python -m ordersight etl RAW HOME [--snapshots DIR] [--file orders=orders_2018.csv ...]
    python -m ordersight report NAME HOME OUT [--set ref_date=2018-09-01 ...]
    python -m ordersight refresh HOME MARTS
"""

from __future__ import annotations

import argparse
import logging
from datetime import date

from ordersight.operators import anomaly, cohort, marts, quality, ranking, rfm
from ordersight.plans.shared_store import drop_stored
from ordersight.session import build_session
from ordersight.sources.csv_files import read_raw
from ordersight.sources.published import refresh_all
from ordersight.sources.star_tables import StarHome, run_etl, stored_star

REPORTS = {
    operator.__name__: operator
    for operator in (
        quality.row_counts,
        quality.orphan_items,
        quality.orphan_payments,
        quality.orphan_reviews,
        quality.critical_nulls,
        quality.date_coverage,
        quality.status_distribution,
        quality.fk_violations,
        quality.pk_violations,
        quality.check_violations,
        quality.length_violations,
        rfm.rfm_segments_detail,
        rfm.rfm_segment_summary,
        rfm.rfm_simple,
        cohort.cohort_retention,
        cohort.cohort_pivot,
        cohort.repurchase_interval,
        anomaly.payment_outliers,
        anomaly.weekly_sales_drop,
        anomaly.daily_volume_outliers,
        anomaly.late_deliveries,
        anomaly.product_week_zscore,
        ranking.product_ranking,
        ranking.top_products,
        ranking.seller_delivery_trend,
        ranking.seller_trend_summary,
        ranking.orders_in_range,
        ranking.product_revenue_since,
        marts.kpi_general,
        marts.revenue_monthly,
        marts.top_categories,
        marts.delivery_performance,
        marts.rfm_segments_mart,
    )
}


def _option(pair: str) -> tuple[str, object]:
    """``name=value`` of an operator's parameter: a date, a number or a text."""
    name, value = pair.split("=", 1)
    for read in (date.fromisoformat, int, float):
        try:
            return name, read(value)
        except ValueError:
            continue
    return name, value


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ordersight")
    parser.add_argument("--database", help="register the tables here")
    parser.add_argument("--buckets", type=int, help="bucket orders, items and payments")
    commands = parser.add_subparsers(dest="command", required=True)
    etl = commands.add_parser("etl")
    etl.add_argument("raw")
    etl.add_argument("home")
    etl.add_argument("--snapshots")
    etl.add_argument("--file", action="append", default=[], metavar="DATASET=NAME", help="a dataset's file below RAW")
    report = commands.add_parser("report")
    report.add_argument("name", choices=sorted(REPORTS))
    report.add_argument("home")
    report.add_argument("out")
    report.add_argument("--set", action="append", default=[], type=_option, metavar="PARAMETER=VALUE", help="such as ref_date=2018-09-01 or n=5")
    refresh = commands.add_parser("refresh")
    refresh.add_argument("home")
    refresh.add_argument("marts")
    options = parser.parse_args(arguments)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = build_session()
    home = StarHome(options.home, options.database, options.buckets)
    try:
        if options.command == "etl":
            files = dict(pair.split("=", 1) for pair in options.file)
            run_etl(read_raw(spark, options.raw, files), home, options.snapshots)
        elif options.command == "report":
            result = REPORTS[options.name](stored_star(spark, home), **dict(options.set))
            result.write.mode("overwrite").option("header", True).csv(options.out)
        else:
            refresh_all(stored_star(spark, home), options.marts, database=options.database)
    finally:
        drop_stored(spark)


if __name__ == "__main__":
    main()
