"""Times the headline queries and prints one JSON line.

Every query is run in full into a no-op sink, so all its output columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from panelwright.session import build_session  # noqa: E402
from panelwright.workload import catalogue, fixture  # noqa: E402

HEADLINE = (
    "p10_silver_panel",
    "c01_c10_collapse_loans",
    "c11_stratum_by_vintage",
    "a02_numeric_profile",
    "a05_null_counts",
    "a14_static_consistency",
    "a19_range_audit",
    "a23_cast_loss_audit",
    "a24_descriptive_statistics",
    "k02_partitioned_overwrite",
    "o08_stratified_hash_sample",
    "o11_sample_smd",
    "m10_w02_spearman_matrix",
    "m40_m41_agreement_matrix",
    "m46_kruskal_wallis",
    "m44_profile_medians",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    runs = catalogue.queries()
    times = {}
    # the stage tables that the queries read; each is built from the one before
    for stage in (fixture.bronze_table, fixture.silver_table, fixture.loan_table):
        start = time.perf_counter()
        stage(spark, sf_dir)
        times[f"build_{stage.__name__}"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        runs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    panel_rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "lineitem_rows": panel_rows,
            }
        )
    )


if __name__ == "__main__":
    main()
