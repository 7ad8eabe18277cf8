"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Every query is computed in full (all rows and columns) into Spark's no-op sink.
"""

import json
import os
import sys
import time

from loomstat.plans import catalog
from loomstat.session import local_session

HEADLINE = [
    # scaler + support vector classifier
    "c11_linear_svm",
    "c11_rbf_svm",
    # TF-IDF, then logistic regression on it
    "t16_tfidf",
    "t17_tfidf_unseen",
    "w9_text_classifier",
    # bounded counts, then topics
    "t13_pruned_vocabulary",
    "d6_topics",
    # the rest of the path from table to judged model
    "w0_split_scale_fit_score",
    "t6_clean",
    "l1_stratified_split",
    "w5_learning_curve",
    "w6_validation_curve",
    "r3_ransac",
    "v9_roc_curve",
    "v13_mean_roc",
    "c10_nearest_neighbour_classifier",
    "k1_kmeans_random",
    "k5_silhouette",
    "c9_forest_importances",
    "c14_adaboost",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in catalog.QUERIES if n in sys.argv[1:]] or HEADLINE
    if sys.argv[1:] == ["all"]:
        names = list(catalog.QUERIES)
    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus)) if cpus.isdigit() else 8, app="bench")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before the clock
    spent = {}
    for name in names:
        started = time.time()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.time() - started, 3)
        print(f"{name} {spent[name]:.2f}s", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(spent.values()), 3), "unit": "sec", "queries": spent, "sf": folder}))


if __name__ == "__main__":
    main()
