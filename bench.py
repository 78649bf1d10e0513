"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import importlib
import json
import os
import tempfile
import time

from periodlens.session import get_session, release_pins

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "panel_base",
    "next_period_label",
    "features_full",
    "training_split",
    "dim_upsert",
    "fact_insert_absent",
    "fact_violation_load",
    "constraint_report",
    "dq_features",
    "rule_bounds",
    "rule_scores",
    "topk_metrics",
    "roc_auc",
    "kpi_summary",
    "top_risk",
    "entity_detail",
    "logistic_scores",
    "staged_employment_production_quarterly",
    "staged_violations",
)


def main() -> None:
    spark = get_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="periodlens-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    entry = importlib.import_module("__spark_entry__")
    queries = entry.queries()
    entry.entry(spark).write.format("noop").mode("overwrite").save()  # start the engine
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    release_pins(spark)
    total = round(sum(seconds.values()), 3)
    scale = FOLDER.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
