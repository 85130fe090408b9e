"""Headline queries timed on one machine; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the local cores.  Every query
builds its own stage tables, so its time does not depend on the others.
"""

from __future__ import annotations

import json
import os
import sys
import time

from guidewave.functions.session import local_session
from guidewave.plans import all_queries
from guidewave.plans.screen_tables import forget

HEADLINE = [
    "agg_01_cell_rna_qc", "rel_03_strict_filter", "rel_27_dominant_guide_call", "rel_24_harmonized_labels", "agg_08_target_coverage", "rel_12_normalize_total",
    "rel_15_clr_per_cell", "agg_19_knockdown_effect", "agg_20_perturbation_strength", "agg_27_effect_matrix", "stat_27_gene_ranking", "stat_29_cluster_enrichment",
    "join_15_exact_knn", "agg_33_local_enrichment_summary", "agg_35_response_summary", "stat_13_perturbation_distance", "join_17_target_pairs", "stat_30_protein_effect_tests",
    "stat_19_response_protein", "ml_03_rna_components", "join_21_master_tables",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "guidewave-bench")
    queries = all_queries()
    timings = {}
    for name in HEADLINE:
        forget()
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(name, timings[name], file=sys.stderr)
    print(json.dumps({"metric": "headline screen queries, total wall time", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
