"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default: sf0.1), BENCH_CPUS the local cores. Each
query is computed in full into a sink that drops the rows. One warm-up starts
the JVM and the Python workers and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

from textloom.catalog import registry
from textloom.session import local_session

HEADLINE = (
    "filter_reasons",
    "content_filter",
    "html_extract",
    "encoding_recovery",
    "lang_detect",
    "domain_tag",
    "minhash_signatures",
    "dedup_kept",
    "rebalanced",
    "word_counts",
    "bpe_train",
    "encode_corpus",
    "decode_roundtrip",
    "stage_chain",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.all_queries()
    queries["nfc"][0](spark, sf_dir).limit(1).collect()

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        queries[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
