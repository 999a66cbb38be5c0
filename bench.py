"""Time the headline queries. Prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores),
BENCH_RUNS (timed runs per query, default 3), BENCH_QUERIES (comma-separated names, default: the list below).
The median of the timed runs counts. Queries under ``LONG`` seconds run once more, unmeasured, before; in longer ones the
median of three leaves out the first run, which compiles, anyway. Rows go to the noop sink.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from opinara.registry import PLAIN  # noqa: E402
from opinara.session import local_session  # noqa: E402

LONG = 2.0
HEADLINE = """
remove_duplicates processed_reviews stemmed_reviews text_features
sentiment_scores sentiment_by_bank
tfidf_vectors lda_topic_words topics_by_bank
narrow_fact enriched_fact
main_dataset bank_summary temporal_trends topic_analysis branch_performance bank_topic_matrix wordcloud_terms
kpi_overview monthly_trend summary_metrics metric_correlations score_quartiles sentiment_trend filtered_reviews
distinct_links extract_reviews flat_bank_summary
""".split()


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    PLAIN[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def measure(spark, name: str, folder: str, runs: int) -> float:
    times = [timed(spark, name, folder) for _ in range(runs)]
    if times[0] <= LONG:
        times = [*times[1:], timed(spark, name, folder)]
    return round(statistics.median(times), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(int(os.environ["BENCH_CPUS"]) if os.environ.get("BENCH_CPUS") else None)
    seconds = {}
    for name in names:
        seconds[name] = measure(spark, name, folder, runs)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "total time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(Path(folder).name.removeprefix("sf")) if Path(folder).name.startswith("sf") else folder,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
