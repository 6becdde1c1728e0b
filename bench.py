"""Time the headline queries: BENCH_SF_DIR on local[BENCH_CPUS], one JSON line on stdout."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from topictide.catalog.queries import QUERIES  # noqa: E402
from topictide.session import get_session  # noqa: E402

HEADLINE = (
    "p15_clean_text",
    "t2_assign_intervals_half_open",
    "t3_cap_per_interval",
    "a17_dedupe",
    "a5_keyword_freq",
    "a7_tfidf_slice",
    "w1_top_keywords",
    "m17_tfidf_timesliced",
    "a18_ctfidf",
    "w4_topic_terms",
    "m12_document_topics",
    "m15_trend_summary",
    "m4_lda_corpus",
    "m2_lda_timesliced",
    "m7_density_topics",
    "m13_layout_2d",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # started JVM, Python workers and compiled code are not part of any query
    QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total wall-clock of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
