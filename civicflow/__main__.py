"""Command line: ingest, build the marts, run the data tests.

  python -m civicflow ingest --raw R --watermark W --json-source FILE
  python -m civicflow ingest --raw R --watermark W --landing DIR --checkpoint C [--files-per-batch N]
                             [--marts ROOT]   (refresh a month-layout warehouse after each micro-batch)
  python -m civicflow ingest --raw R --watermark W --table PARQUET [--batch-size N] [--start-date D]
  python -m civicflow ingest --raw R --watermark W --table PARQUET --plan DIR [--batch-size N]   (planned pages)
  python -m civicflow sample (--table PARQUET | --json-source FILE) --out DIR [--size N] [--key K]
  python -m civicflow build  --raw R --watermark W --out ROOT [--by-month]
  python -m civicflow refresh --raw R --watermark W --out ROOT --months 2026-01,2026-02 [--undated]
  python -m civicflow test   --raw R --watermark W --out ROOT [--now T]

Paths are on the cluster's shared storage; the master comes from spark-submit.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from .operators import quality
from .operators.load import WatermarkLog, read_raw
from .plans import marts as M
from .schema import DEFAULT_BATCH_SIZE, DEFAULT_START, SAMPLE_SIZE
from .session import build_session
from .sources.extract import write_sample
from .sources.files import read_json_array
from .plans.published import open_published, publish
from .streaming import backfill_json, ingest_pages, ingest_planned, ingest_stream


def _args(argv=None):
    ap = argparse.ArgumentParser(prog="civicflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("sample")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--json-source", help="JSON file (array of records)")
    src.add_argument("--table", help="Parquet table")
    p.add_argument("--out", required=True, help="directory of the raw and the normalised CSV copy")
    p.add_argument("--size", type=int, default=SAMPLE_SIZE)
    p.add_argument("--key", type=int, default=None, help="only the rows with this key")
    for name in ("ingest", "build", "refresh", "test"):
        p = sub.add_parser(name)
        p.add_argument("--raw", required=True)
        p.add_argument("--watermark", required=True)
        if name == "ingest":
            src = p.add_mutually_exclusive_group(required=True)
            src.add_argument("--json-source", help="JSON file (array of records), loaded once")
            src.add_argument("--landing", help="directory of landed JSON-lines files (streamed, availableNow)")
            src.add_argument("--table", help="Parquet table paged in (created, key) order")
            p.add_argument("--split-bytes", type=int, default=None, help="read a --json-source file by one task for each so many bytes")
            p.add_argument("--checkpoint")
            p.add_argument("--plan", default=None, help="directory of page plans (--table): plan all pages first, then stream them")
            p.add_argument("--files-per-batch", type=int, default=1)
            p.add_argument("--batch-size", type=int, default=DEFAULT_BATCH_SIZE)
            p.add_argument("--start-date", type=dt.datetime.fromisoformat, default=DEFAULT_START)
            p.add_argument("--by-month", action="store_true")
            p.add_argument("--latest", action="store_true", help="a later version of a key replaces the stored one (--landing with --by-month)")
            p.add_argument("--created-immutable", action="store_true")
            p.add_argument("--marts", default=None, help="month-layout warehouse to refresh per micro-batch")
        else:
            p.add_argument("--out", required=True)
            p.add_argument("--now", type=dt.datetime.fromisoformat, default=None)
            p.add_argument("--by-month", action="store_true", help="month layout (build)")
            p.add_argument("--publish", action="store_true", help="build a new version under --out and put it in force when whole (build); use the version in force (test)")
            p.add_argument("--months", default="", help="YYYY-MM list (refresh)")
            p.add_argument("--undated", action="store_true", help="also rows without a creation time (refresh)")
    return ap.parse_args(argv)


def main(argv=None) -> None:
    a = _args(argv)
    spark = build_session()
    if a.cmd == "sample":
        rows = spark.read.parquet(a.table) if a.table else read_json_array(spark, a.json_source)
        write_sample(rows, a.out, a.size, a.key)
        return
    if a.cmd == "ingest":
        if a.json_source:
            r = backfill_json(spark, a.json_source, a.raw, a.watermark, split_bytes=a.split_bytes)
            print(json.dumps({"rows": r.rows_in, "loaded": r.rows_loaded, "watermark": str(r.watermark)}))
            return
        if a.landing:
            if not a.checkpoint:
                raise SystemExit("--checkpoint is required with --landing")
            run = ingest_stream(spark, a.landing, a.raw, a.watermark, a.checkpoint, a.files_per_batch,
                                created_is_immutable=a.created_immutable, by_month=a.by_month,
                                marts_root=a.marts, mode="latest" if a.latest else "first")
        elif a.plan:
            run = ingest_planned(spark, spark.read.parquet(a.table), a.raw, a.watermark, a.plan, a.batch_size, a.start_date,
                                 created_is_immutable=a.created_immutable)
        else:
            run = ingest_pages(spark, spark.read.parquet(a.table), a.raw, a.watermark, a.batch_size, a.start_date)
        print(json.dumps({"rows": run.rows, "loaded": run.loaded, "batches": run.batches,
                          "quarantined": run.quarantined, "failed_cells": run.failed_cells,
                          "seconds": round(run.seconds, 3), "rows_per_second": round(run.rows_per_second, 1)}))
        return
    raw, meta = read_raw(spark, a.raw), WatermarkLog(a.watermark).read(spark)
    if a.cmd == "build":
        if a.publish:
            publish(spark, M.derive(spark, raw, meta), a.out, by_month=a.by_month)
        else:
            M.materialize(spark, M.derive(spark, raw, meta), a.out, by_month=a.by_month)
        return
    if a.cmd == "refresh":
        months = [dt.date.fromisoformat(m.strip() + "-01") for m in a.months.split(",") if m.strip()]
        M.refresh_months(spark, a.out, raw, months + ([None] if a.undated else []), meta)
        return
    now = a.now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    reports = quality.run_all(open_published(spark, a.out, raw, meta) if a.publish else M.load(spark, a.out, raw, meta), now)
    failed = 0
    for name, df in reports.items():
        rows = df.collect()  # one row per declared test
        failed += sum(1 for r in rows if r["status"] not in ("pass", "warn"))
        df.show(truncate=False)
    raise SystemExit(1 if failed else 0)


if __name__ == "__main__":
    main()
