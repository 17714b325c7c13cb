"""Benchmark: run the headline queries on $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS] and print ONE JSON line.

Every query is executed completely (noop sink: the whole plan runs, nothing
is collected to the driver). ``eval_tokens_per_sec`` is the count model's
scoring throughput over every position of both streams, the counterpart of
the reference's evaluation tokens/sec.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "assemble_records",      # flagship: instruction records from a flat line stream
    "json_stories",
    "byte_budget",
    "word_counts",           # pre-tokenize + count
    "bpe_train",             # batched merge training (first call trains)
    "bpe_encode",
    "pack_stream",
    "next_token_pairs",
    "ngram_eval",            # fit + score every position of both streams
    "eval_report",           # window-sampled eval over the seed sweep
    "sft_triplets",
    "masked_loss",
    "best_so_far",
    "sample_n",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from talewright.session import local_session
    from talewright.plans.catalog import QUERIES

    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="talewright-bench")
    times: dict[str, float] = {}
    extra: dict[str, float] = {}
    # JVM start and first-use class loading / JIT are not query work: one
    # untimed scan + shuffle, reported on its own.
    t0 = time.time()
    spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).groupBy("lang").count().collect()
    extra["warmup_sec"] = round(time.time() - t0, 3)
    for name in only or HEADLINE:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        if name == "ngram_eval":
            n = sum(r["n_tokens"] for r in df.collect())
            extra["eval_tokens"] = n
            extra["eval_tokens_per_sec"] = round(n / times[name], 1)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, **extra}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
