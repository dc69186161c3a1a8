"""Time the headline queries on ``$BENCH_SF_DIR`` and print one JSON line.

Each query runs to the end (``noop`` sink), ``$BENCH_WARMUPS`` times untimed (1 unless set, so that
the JVM has compiled the code paths) and then once timed. ``end_to_end_run`` is the whole pipeline: CSV
to Bronze, validation, quality, features, roll-up, a 300-tree forest with five-fold
cross-validation, attribution and reports.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegauge.plans import catalog  # noqa: E402
from tidegauge.session import build_session  # noqa: E402

HEADLINE = [
    "silver_feature_metrics", "agg_daily", "engineer_features", "daily_trends", "feature_summary",
    "dq_report", "validate_schema", "null_rate_gate", "drift_pct_change", "drift_psi", "drift_ks",
    "risk_target", "robust_scale", "stratified_split", "eval_roc_auc", "high_risk_owners",
    "bronze_append", "stream_bronze_sink", "sample_n", "map_category", "end_to_end_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    warmups = int(os.environ.get("BENCH_WARMUPS", "1"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("tidegauge-bench", **{
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        for _ in range(warmups + 1):
            started = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }))


if __name__ == "__main__":
    main()
