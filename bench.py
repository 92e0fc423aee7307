"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from workload import all_queries  # noqa: E402

HEADLINE = [
    "align_distance_by_species", "gpa_consensus", "gpa_by_species", "outlier_flags_by_species", "nested_anova",
    "within_group_variance", "permutation_p", "pca_scores", "lda_posteriors", "logo_cv", "renumber",
    "renumber_eighteen_points", "renumber_noise_clouds", "localization_error", "reproject_round_trip", "landmark_file_round_trip",
    "harmonised_identity", "identity_conflicts", "allocate_ids", "attach_ids", "photo_ids", "scan_status",
    "duplicate_groups", "duplicate_keys", "dataset_join", "latest_status", "step_stats", "failure_run_lengths",
    "status_crosstab", "exclusion_report", "path_match", "class_report", "top_three_choices",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()[0]

    def timed(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed("align_distance_by_species")  # start the JVM and the Python workers
    seconds, rates = {}, {}
    for name in HEADLINE:
        try:
            seconds[name] = round(timed(name), 3)
        except Exception as problem:
            print(f"{name}: {type(problem).__name__}: {str(problem)[:300]}", file=sys.stderr)
            seconds[name] = None
    shapes = spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    for name in ("renumber", "renumber_eighteen_points", "renumber_noise_clouds"):
        if seconds.get(name):
            rates[f"{name}_shapes_per_sec"] = round(shapes / seconds[name], 1)
    total = round(sum(s for s in seconds.values() if s is not None), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")), "rates": rates,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
