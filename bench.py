"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

HEADLINE = (
    "flagship_seasonal_by_segment", "ts5_gap_fill", "fx2_date_features", "jn1_intersection", "zs1_class_rates", "zs4_majority_statistics", "sp2_repeated_splits",
    "fu1_majority_vote", "fu2_dempster_shafer", "va6_class_scores", "va6_global_scores", "rg1_patches", "rg7_local_majority", "ms8_mode_resample",
    "ml6_classification", "u1_user_features", "jn1_shape_intersection", "jn2_shape_difference", "au4_neighbours", "dr3_correlations", "rg11_superpixels", "sp11_selected_by_model",
)


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from landseries.plans.registry import QUERIES

    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["sc6_date_bounds"](spark, folder).collect()  # the first job starts the engine
    took = {}
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
