"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the number of cores. Every query runs once to
warm up and then BENCH_RUNS times (1); the best run counts. A result is computed in full,
every column of every row, and discarded. Vocabulary training is timed once, and the
encode query uses its result.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tokenloom.catalog.queries import QUERIES
from tokenloom.session import build_session

HEADLINE = (
    "word_counts", "pair_counts", "encode", "decode", "pack_trim", "chunk_block",
    "shuffle_rows", "split_head", "split_head_shuffled", "batch_pad", "mlm_mask",
    "whole_word_mask", "align_labels", "span_scores", "fill_slot_topk",
    "next_token_distribution", "sample_next", "repeated_ngrams", "corpus_to_splits",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", cores=cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["word_counts"](spark, sf_dir).count()
    started = time.perf_counter()
    QUERIES["bpe_train"](spark, sf_dir).count()
    seconds = {"bpe_train": round(time.perf_counter() - started, 3)}
    for name in HEADLINE:
        best = None
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
