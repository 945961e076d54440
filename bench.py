"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line.

The tables are first copied into as many files as there are cores, outside the times, as
a cluster would store them. Every query is executed in full into the no-op sink: once to
warm up, then twice (once if it takes over three seconds), and the mean is reported. The
longest, over 20 seconds, are run only once. ``bpe_merges`` trains in every run; the
others read the saved model.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wordloom.plans import subword_queries  # noqa: E402
from wordloom.plans.catalog import QUERIES  # noqa: E402
from wordloom.session import build_session, new_path  # noqa: E402

#: The tables that the queries read.
TABLES = "documents pages events embeddings benchmark conversations labels".split()

HEADLINE = """flagship articles page_links links_distinct clean_text preprocess_default mask_patterns
    ws_tokens tok_naive tok_regex tok_rules tok_sentences tok_wordpunct top_tokens top_tokens_by_lang
    vocab_size oov_rate tokens_per_word corpus_summary budget_prefix split_80_20 text_similarity
    stem_porter stem_snowball_ru tokenizer_grid scan_jsonl_strict stream_preprocess word_types
    bpe_merges bpe_encode corpus_encode fragmentation""".split()


#: Queries that measure training; the others find the model that these have saved.
TRAINING = {"bpe_merges"}


def run(spark, folder: str, name: str) -> float:
    if name in TRAINING:
        subword_queries.forget_models(spark, folder)  # training is part of every run
    start = time.time()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.time() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        f"local[{cpus}]", "wordloom-bench", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    spread = new_path(spark, "bench")
    for name in TABLES:
        spark.read.parquet(f"{folder}/{name}.parquet").repartition(int(cpus)).write.parquet(f"{spread}/{name}.parquet")
    source, folder = folder, spread
    run(spark, folder, "clean_text")  # start the JVM's compiler and the Python workers
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = [run(spark, folder, name)]
        if taken[0] <= 20:
            taken = [run(spark, folder, name) for _ in range(2 if taken[0] < 3 else 1)]
        times[name] = round(statistics.mean(taken), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": source.rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
