"""Time the headline queries and print one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) on local[BENCH_CPUS]. Every query builds its plan
and writes all of its rows to the no-op sink; the time is the shortest of BENCH_RUNS runs.
"""

from __future__ import annotations

import json
import os
import time

from outbreaklens.plans.queries import QUERIES
from outbreaklens.session import build_session, local_cpus

HEADLINE = [
    "cleaning_report",
    "clean_cases",
    "rt_proxy",
    "trend_features",
    "label_next_7d",
    "labelled_features",
    "date_cutoff_split",
    "cases_deaths_left_join",
    "cfr_trend",
    "density_impute",
    "serving_trend",
    "zone_state",
    "latest_per_zone",
    "top15_zones",
    "anomaly_scores",
    "early_warning",
    "star_latest_top10",
    "watchlist_history",
    "surge_evaluation",
    "classification_report",
    "html_article_text",
    "mention_context",
    "severity_labels",
    "gazetteer_locations",
    "bulletin_headlines",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = local_cpus(), int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "outbreaklens-bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        seconds[name] = round(min(taken), 3)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
