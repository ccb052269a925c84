"""Benchmark: ingestion throughput, marts build and every question at one scale factor.

Prints one JSON line. Environment: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8), BENCH_EVENT_LOG (set: write Spark's event log to the scratch folder). Each timed step runs to completion through the
``noop`` sink (full computation, nothing collected).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import sys
import tempfile
import time
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from civicflow import oracle as O  # noqa: E402
from civicflow.operators import quality as D  # noqa: E402
from civicflow.operators.load import WatermarkLog, read_raw  # noqa: E402
from civicflow.operators.normalize import conform  # noqa: E402
from civicflow.plans import marts as M  # noqa: E402
from civicflow.plans import queries as Q  # noqa: E402
from civicflow.session import build_session  # noqa: E402
from civicflow.sources import testdata  # noqa: E402
from civicflow.streaming import ingest_pages, ingest_planned, ingest_stream, land_as_json  # noqa: E402

AS_OF = dt.date.fromisoformat(O.AS_OF)
NOW = dt.datetime.combine(AS_OF, dt.time())


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn):
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def _median(fn, runs: int = 3):
    """Median of a few timed runs (this host's timings vary run to run)."""
    return sorted(_timed(fn) for _ in range(runs))[runs // 2]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m_sf = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m_sf.group(1)) if m_sf else None
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    extra = {"spark.driver.memory": "16g"}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task times for tools/stage_times.py
        os.makedirs(f"{scratch}/events")
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{scratch}/events"})
        print(f"event log: {scratch}/events", file=sys.stderr)
    spark = build_session(f"local[{cpus}]", app="civicflow-bench", shuffle_partitions=cpus, **extra)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", f"file://{scratch}/ckpt")
        spark.sparkContext.setCheckpointDir(f"file://{scratch}/ckpt")
    root = f"file://{scratch}"
    times: dict[str, float] = {}

    # -- ingestion: landed JSON files -> conform -> dedupe -> insert-if-absent -> append -> watermark
    raw_src = conform(testdata.requests(spark, sf_dir))
    n_rows = raw_src.count()
    land_as_json(raw_src, f"{root}/landing", files=8)
    # first run in a fresh JVM (recorded), then the measured run into a fresh table
    t0 = time.perf_counter()
    ingest_stream(spark, f"{root}/landing", f"{root}/raw_cold", f"{root}/watermark_cold",
                  f"{root}/stream_ckpt_cold", files_per_batch=4, now=NOW, created_is_immutable=True)
    times["ingest_stream_cold"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    counters = ingest_stream(spark, f"{root}/landing", f"{root}/raw", f"{root}/watermark",
                             f"{root}/stream_ckpt", files_per_batch=4, now=NOW,
                             created_is_immutable=True)
    times["ingest_stream"] = round(time.perf_counter() - t0, 3)
    # replaying every file again must add nothing (idempotent load); timed as well
    t0 = time.perf_counter()
    replay = ingest_stream(spark, f"{root}/landing", f"{root}/raw", f"{root}/watermark",
                           f"{root}/stream_ckpt_replay", files_per_batch=8, now=NOW,
                           created_is_immutable=True)
    times["ingest_replay"] = round(time.perf_counter() - t0, 3)

    # -- the same load as a keyset page loop (extract page after the watermark -> load -> re-read),
    #    100,000-row pages like the reference's chosen batch size, from a Parquet copy of the requests
    raw_src.write.parquet(f"{root}/source")
    t0 = time.perf_counter()
    pages = ingest_pages(spark, spark.read.parquet(f"{root}/source"), f"{root}/raw_pages", f"{root}/wm_pages",
                         batch_size=100_000, now=NOW)
    times["ingest_pages"] = round(time.perf_counter() - t0, 3)

    # -- the same pages planned by one histogram, then streamed
    t0 = time.perf_counter()
    planned = ingest_planned(spark, spark.read.parquet(f"{root}/source"), f"{root}/raw_planned", f"{root}/wm_planned", f"{root}/plans",
                             batch_size=100_000, now=NOW)
    times["ingest_planned"] = round(time.perf_counter() - t0, 3)

    # -- marts: read raw back, build and materialise fact, dims, calendar, aggregates
    raw = read_raw(spark, f"{root}/raw")
    lazy = M.derive(spark, raw, meta=None, calendar=M.TESTDATA_CALENDAR)
    t0 = time.perf_counter()
    marts = M.materialize(spark, lazy, f"{root}/warehouse")
    times["build_marts"] = round(time.perf_counter() - t0, 3)
    marts = replace(marts, meta=WatermarkLog(f"{root}/watermark").read(spark).cache())

    steps = {
        "overview": lambda: Q.overview(marts),
        "daily_trends": lambda: Q.daily_trends(marts, O.TREND_DAYS, AS_OF),
        "top_types": lambda: Q.top_complaint_types(marts, O.TOP_DAYS, AS_OF),
        "geo_hotspots": lambda: Q.geo_hotspots(marts, O.GEO_DAYS, AS_OF),
        "agency_trend": lambda: Q.agency_trend(marts, O.AGENCY_MONTHS, AS_OF),
        "filter_options": lambda: Q.borough_options(marts).unionByName(
            Q.status_options(marts).withColumnRenamed("status", "borough")).unionByName(
            Q.agency_options(marts).withColumnRenamed("agency", "borough")),
        "recent_filtered": lambda: Q.recent_requests(marts, O.RECENT_LIMIT, **O.RECENT_FILTER),
        "heatmap_month": lambda: Q.heatmap_by_month(marts),
        "latest_inspection": lambda: Q.latest_inspection(marts),
        "instant_close_by_agency": lambda: Q.instant_close_by_agency(marts),
        "display_time": lambda: Q.display_times(marts),
        "ingestion_status": lambda: Q.ingestion_status(marts.meta, NOW),
    }
    for name, make in steps.items():
        _run(make())  # warm (plan + first read of the files)
        times[name] = _median(lambda: _run(make()))
    tests = D.run_all(marts, NOW)
    times["data_tests"] = _median(lambda: [_run(df) for df in tests.values()])

    query_total = round(sum(v for k, v in times.items() if k not in ("ingest_stream", "ingest_stream_cold",
                                                                       "ingest_replay", "ingest_pages", "ingest_planned",
                                                                       "build_marts")), 3)
    out = {
        "metric": "bi_queries_total_sec",
        "value": query_total,
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "rows": n_rows,
        "ingest_rows_per_sec": round(counters.rows / times["ingest_stream"], 1),
        "ingest_batches": counters.batches,
        "ingest_per_batch": counters.per_batch,
        "replay_rows_added": replay.loaded,
        "page_ingest_rows_per_sec": round(pages.rows / times["ingest_pages"], 1),
        "page_ingest_batches": pages.batches,
        "planned_ingest_rows_per_sec": round(planned.rows / times["ingest_planned"], 1),
        "end_to_end_sec": round(times["ingest_stream"] + times["build_marts"] + query_total, 3),
        "cpus": cpus,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
