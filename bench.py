"""Times the headline queries; prints one JSON line.

Every query runs to the end of its plan (a no-op sink takes all rows). The first
run of each is a warm-up; the better of two later runs counts.
"""

import json
import os
import sys
import time

from threadloom.catalog import QUERIES
from threadloom.session import build_session, ensure_work_folder

HEADLINE = [
    "fct_posts",
    "clean_text_documents",
    "clean_html_pages",
    "stg_posts",
    "low_quality_filter",
    "dedupe_by_key",
    "left_join_fanout",
    "left_join_hot_keys",
    "anti_known_ids",
    "watermark_filter",
    "listing_unnest",
    "envelope_unnest",
    "ingest_new_posts",
    "dq_model_tests",
    "dq_duplicate_keys",
    "top_lines_per_order",
    "post_context",
    "memory_buffer",
    "chunk_posts",
    "chunk_comments",
    "union_corpus",
    "embed_chunks",
    "similarity_topk",
    "similarity_topk_cells",
    "question_topk",
    "retrieval_context",
    "partitioned_roundtrip",
    "stream_dedupe",
    "stream_watermark_filter",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_work_folder(spark)
    seconds = {}
    for name in only or HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs[1:]), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
