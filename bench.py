"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import certificates  # noqa: E402
from tessera.plans.queries import REGISTRY  # noqa: E402
from tessera.session import get_session  # noqa: E402

HEADLINE = (
    "category_avg",
    "top_words",
    "frequent_itemsets",
    "frequent_itemsets_min_basket",
    "son_itemsets",
    "similar_pairs",
    "jaccard_pairs_exact",
    "near_duplicate_documents",
    "similar_pairs_complete",
    "similar_documents_exact",
    "block_jaccard_pairs",
    "hot_shared_keys",
    "pearson_weights",
    "pearson_weights_all",
    "cf_predict",
    "cf_blend",
    "block_label_propagation",
    "block_components",
    "block_betweenness",
    "edge_betweenness",
    "bfr_assign",
    "feature_frame",
    "pca_linreg_cv",
    "nonneg_linreg",
    "linear_svr",
    "random_forest_cv",
    "girvan_newman_certificate",
    "cs_merged_stats",
)

ALL = {**REGISTRY, **certificates.REGISTRY}
COUNTED = ("block_components", "block_betweenness", "block_jaccard_pairs", "hot_shared_keys")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["review_count"](spark, sf_dir).collect()  # starts the JVM's engines
    took = {}
    for name in names:
        start = time.time()
        ALL[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    # What the graph and similarity queries work on, so that an empty input shows.
    made = {n: ALL[n](spark, sf_dir).count() for n in COUNTED if n in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "rows": made,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
