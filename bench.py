"""Bench: time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries",
"sf", ...}.  Each query is run to completion with a full-result aggregate (a
hash over every output column) so no column is pruned away.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from notelab.plans.catalog import QUERIES  # noqa: E402
from notelab.session import local_session  # noqa: E402

HEADLINE = [
    "D02_remove_inner_labels",     # crop/link: the step the reference reports at > 1 day for 600k terms
    "D10_extract_lab_results",     # flagship composition
    "D03_extract_measures",
    "D06_extract_table_measures",
    "J01_overlap_closed",
    "J02_overlap_halfopen",
    "A01_build_dictionary",
    "J14_nearest_concept",
    "J16_best_string_match",
    "X01_normalize_term_notes",
    "D15_drug_codes",
    "D18_resolve_overlaps",
    "D19_chunk_notes",
    "J15_nearest_in_block",
    "D09_normalize_terms",
    "E07_bootstrap_multinomial",
    "O07_balanced_split",
]


def run(df) -> int:
    cols = [F.col(f"`{c}`").cast("string") for c in df.columns]
    return df.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64(*cols), F.lit(1000003)))).collect()[0][0]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n in QUERIES]
    spark = local_session(cores=cpus, shuffle_partitions=max(cpus * 2, 8), app="notelab-bench")
    # warm-up: JVM, codegen and Python workers
    run(spark.range(1000).select((F.col("id") % 7).alias("x")).groupBy("x").count())
    times, rows = {}, {}
    for name in names:
        t0 = time.time()
        rows[name] = run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {rows[name]} rows in {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
