"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query is timed from building its plan to the last row, after one untimed run.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import all_queries  # noqa: E402
from clickloom.session import start  # noqa: E402

HEADLINE = """
    feature_table training_table join_offer_meta past_impressions rfm_features trans_features
    ctr_encoding label_encode joint_label_encode encode_unseen infer_numeric_columns
    variance_filter temporal_split group_fold log_loss map_at_5 rank_score dedupe_last
    template_match submission_ids ensemble_scores rf_scores ranker_scores
""".split()
ONCE = {"ensemble_scores", "rf_scores", "ranker_scores"}  # model fits: no untimed run


def run(query, spark, sf_dir: str) -> float:
    begun = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = start("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        query = all_queries()[name]
        if name not in ONCE:
            run(query, spark, sf_dir)
        times[name] = round(run(query, spark, sf_dir), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
