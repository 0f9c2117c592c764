"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import QUERIES  # noqa: E402
from reelmill.session import build_session  # noqa: E402

HEADLINE = [
    "genre_vs_adult", "genre_vs_runtime", "genre_rating_votes", "extreme_runtimes", "talent_weighted", "talent_by_rating",
    "adult_vs_rating", "content_performance", "curate_title_basics", "curate_title_crew", "curate_title_episode",
    "grouped_summary", "multi_summary", "multi_summary_plain", "box_stats_outliers", "ecdf_prices", "histogram_by",
    "crosstab", "duplicate_keys", "top_n_per_group", "arg_extreme", "attach_list", "explode_list_people",
    "lookup_default", "chain_join", "assign_chunks", "table_fingerprint", "sample_rows", "parse_events", "event_ingest",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM side once, so that the first query is not charged for it.
    spark.read.parquet(f"{folder}/region.parquet").count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(Path(folder).name.removeprefix("sf")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
