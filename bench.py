"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

QUERIES = ("assign_status", "interval_union", "pair_evidence", "strand_votes", "largest_cluster", "translocations", "inversions", "rdna_loci", "depth_stats", "n50_l50", "completeness_matrix", "classify_cascade", "scaffold_layout", "ref_origin_split", "gc_content", "column_consensus", "chain_greedy")


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC"}
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from karyolytics.plans import catalog

    catalog.QUERIES["n50_l50"](spark, sf).collect()
    took = {}
    for q in QUERIES:
        t = time.time()
        catalog.QUERIES[q](spark, sf).write.format("noop").mode("overwrite").save()
        took[q] = round(time.time() - t, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
