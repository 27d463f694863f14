"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from check import spark_session
from recordloom.plans.queries import QUERIES

HEADLINE = [
    "normalize_name", "string_similarity", "quality_features", "xml_records", "kv_blocks", "tagged_blocks",
    "registry_tsv_roundtrip", "decode_payloads", "upsert_by_key", "merge_by_name", "merge_by_name_first",
    "apply_lookup", "missing_keys", "corroborate", "build_registry", "provenance", "block_sizes",
    "candidate_pair_total", "candidate_pairs", "feature_frame", "fs_score", "resolve_links", "explain_links",
    "top_links", "lf_report", "majority_label", "label_model", "gbt_matcher", "isolation_forest",
    "extract_mentions", "knn_pairs", "name_index", "fuzzy_terms", "search_names",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = spark_session(os.environ.get("BENCH_CPUS", "8"))
    # Start the JVM and the Python workers before the clock.
    QUERIES["normalize_name"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
