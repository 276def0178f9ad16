"""Headline timings; prints one JSON line.

The event table is written once in both layouts (not timed); every query is
warmed up and then timed to the last row. `value` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from tidewright.catalog import roles  # noqa: E402
from tidewright.functions.time_bounds import date_key, latest_micros, seconds_between  # noqa: E402
from tidewright.operators import activity, detection, neighbors, outcomes, snapshot, windowed  # noqa: E402
from tidewright.operators.order_stats import median_and_tail  # noqa: E402
from tidewright.plans.formats import bench_queries  # noqa: E402
from tidewright.session import build_session, pin_utc, work_dir  # noqa: E402
from tidewright.sources import sinks, tables  # noqa: E402
from tidewright.streaming.ingest import IngestPaths, ingest_batch  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
TRIALS = int(os.environ.get("BENCH_TRIALS", "7"))
WARM_UPS = 3
WEEK = 7 * 24 * 60


def drain(rows) -> None:
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", int(CPUS), "16g")
    spark.sparkContext.setLogLevel("ERROR")
    pin_utc(spark)
    root = work_dir(spark, "bench")

    stored = (
        roles.payload_events(spark, SF_DIR)
        .withColumns(
            {
                "public": F.lit(True),
                "actor_id": F.col("user_id"),
                "created_at": F.col("created_at").cast("timestamp"),
                "ingested_at": F.col("ingested_at").cast("timestamp"),
            }
        )
        .withColumn("date", date_key(F.col("created_at")))
    )
    sinks.append_events(stored, f"{root}/parquet")
    sinks.append_events_jsonl(stored, f"{root}/jsonl")
    events = tables.read_events(spark, f"{root}/parquet")
    mirror = tables.read_events_jsonl(spark, f"{root}/jsonl")
    runs = roles.ci_runs(spark, SF_DIR).withColumn("created_at", F.col("created_at").cast("timestamp"))
    sinks.overwrite(runs, f"{root}/runs")
    runs = tables.read_ci_runs(spark, f"{root}/runs")
    corpus_path, cases_path = f"{root}/corpus", f"{root}/cases"
    sinks.overwrite(roles.cases(spark, SF_DIR), cases_path)
    sinks.overwrite(roles.corpus(spark, SF_DIR), corpus_path)
    corpus = spark.read.parquet(corpus_path)
    raw_path = f"{root}/raw"
    roles.raw_events(spark, SF_DIR).repartition(int(CPUS)).write.parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    as_of = latest_micros(events, "created_at")

    def retrieval():
        subjects = roles.subjects(spark, SF_DIR)
        found = neighbors.search(subjects, corpus, 5)
        return outcomes.estimate_outcomes(subjects, found, corpus)

    jobs = {}
    for name, query in bench_queries(as_of).items():
        jobs[f"{name}_parquet"] = lambda q=query: drain(q(events))
        jobs[f"{name}_jsonl"] = lambda q=query: drain(q(mirror))
    jobs |= {
        "event_counts": lambda: drain(activity.event_counts(events, WEEK, as_of)),
        "top_entities": lambda: drain(activity.top_entities(events, WEEK, 10, as_of)),
        "lag_stats": lambda: drain(activity.lag_stats(events, WEEK, as_of)),
        "recent_events": lambda: drain(activity.recent_events(events, 20)),
        "failure_rates": lambda: drain(windowed.failure_rates(runs, as_of)),
        "merge_times": lambda: drain(windowed.merge_times(events, as_of)),
        "detect_all": lambda: drain(detection.detect_all(events, runs, as_of)),
        "health_signal": lambda: drain(detection.health_signal(events, runs, as_of)),
        "snapshot_text": lambda: drain(
            snapshot.evidence_snapshot(events, runs, as_of).select(snapshot.snapshot_text())
        ),
        "order_statistics": lambda: drain(
            median_and_tail(
                events.select(
                    "event_type",
                    seconds_between(F.col("created_at"), F.col("ingested_at")).alias("lag"),
                ),
                ["event_type"],
                "lag",
            )
        ),
        "retrieval_outcomes": lambda: drain(retrieval()),
    }
    timings = {}
    for name, job in jobs.items():
        for _ in range(WARM_UPS if "retrieval" not in name else 1):
            job()
        trials = []
        for _ in range(TRIALS if "retrieval" not in name else 3):
            start = time.perf_counter()
            job()
            trials.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(trials), 4)
    ingest_batch(raw, IngestPaths(f"{root}/warm/events", f"{root}/warm/dead"), "bench-0")
    start = time.perf_counter()
    ingest_batch(raw, IngestPaths(f"{root}/live/events", f"{root}/live/dead"), "bench-0")
    timings["ingest_all_events"] = round(time.perf_counter() - start, 4)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": SF_DIR,
                "events": events.count(),
            }
        )
    )


if __name__ == "__main__":
    main()
