"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the table folder (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Every query runs once to warm up and then three times; the best time counts.
"""

import json
import os
import tempfile
import time

from lavra.plans.queries import QUERIES, Tables
from lavra.session import build_session

HEADLINE = (
    "clean_codes", "parse_locale_numbers", "normalize_labels", "target_flags", "shares_per_capita",
    "multipart_union", "validated_enrich", "join_coverage", "semi_filter", "entity_rollup", "group_summary",
    "value_counts", "dataset_summary", "rate_by_category", "column_profile", "correlation_rank", "quality_report",
    "rank_global", "rank_with_ties", "rank_in_group", "ranking_list", "melt_years", "sample_exact",
    "group_folds_by_order", "page_links", "event_json", "header_row_table", "exact_medians",
    "impute_scale_encode", "binary_metrics", "curve_points", "risk_rollup",
    "many_categories", "permutation_ring", "stratified_folds", "mixed_json", "quoted_breaks_in_splits",
)
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="lavra-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    times = {}
    for name in names:
        best = None
        for turn in range(REPEATS + 1):
            start = time.perf_counter()
            # The noop sink computes every row and column without collecting them.
            QUERIES[name].run(Tables(spark, folder)).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if turn:
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
