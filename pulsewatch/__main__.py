"""Command line: run one of the reference's jobs.

    python -m pulsewatch listen metrics --kafka broker:9092 --topic metrics \
        --tables /shared/tables --checkpoints /shared/checkpoints
    python -m pulsewatch listen views --files /shared/topics/metrics ...
    python -m pulsewatch listen attackers --segments /shared/topics/metrics --starting-offsets earliest ...
    python -m pulsewatch archive --as-of 2024-02-15 --tables ... --out ...
    python -m pulsewatch maintain --as-of 2024-02-15T00:00:00 --tables ... --archives ...

The master and resources come from ``spark-submit`` / the environment; the
session gets this package's settings (UTC, AQE, runtime-only broadcasts).
``--available-now`` processes what is there and stops (backfills, tests).
"""

from __future__ import annotations

import argparse
import datetime as dt

from .plans.applications import (
    archiver, attackers_listener, burst_listener, listener, maintain, sketch_listener, views_listener,
)
from .session import build_session, cluster_settings, ensure_checkpoint_dir
from .sources.segments import subscribe_segments
from .sources.streams import subscribe, text_stream
from .streaming.jobs import run_available, run_caught_up, run_together

WINDOWED = {"views": views_listener, "sketches": sketch_listener, "bursts": burst_listener, "attackers": attackers_listener}
JOBS = ["metrics", "logs", "resources", *WINDOWED]


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pulsewatch")
    sub = p.add_subparsers(dest="command", required=True)
    ls = sub.add_parser("listen", help="run a streaming job")
    ls.add_argument("job", choices=JOBS)
    src = ls.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--files", help="folder of JSON-lines files (file form of a topic)")
    src.add_argument("--segments", help="topic folder of segments (own offsets)")
    ls.add_argument("--topic", default="metrics")
    ls.add_argument("--fail-on-data-loss", action="store_true", help="stop where a segment or offset is gone")
    ls.add_argument("--starting-offsets", default="latest")
    ls.add_argument("--tables", required=True, help="table root (shared storage)")
    ls.add_argument("--checkpoints", help="checkpoint root (default: under spark.checkpoint.dir)")
    ls.add_argument("--trigger", default="default", help="processing-time interval")
    ls.add_argument("--available-now", action="store_true")
    ls.add_argument("--rate", type=int, help="most new files (or Kafka offsets) per micro-batch")
    _sizing(ls)
    ar = sub.add_parser("archive", help="archive the day one month before --as-of")
    ar.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    ar.add_argument("--tables", required=True)
    ar.add_argument("--out", required=True)
    ar.add_argument("--format", default="csv")
    _sizing(ar)
    mt = sub.add_parser("maintain", help="compact all tables and purge what is proven to be archived")
    mt.add_argument("--as-of", required=True, type=dt.datetime.fromisoformat)
    mt.add_argument("--tables", required=True)
    mt.add_argument("--archives", help="where `archive` wrote; without it no expired day is purged")
    _sizing(mt)
    return p


def _sizing(p: argparse.ArgumentParser) -> None:
    p.add_argument("--input-bytes", type=int, help="size of a run's input, to size splits and shuffles by")
    p.add_argument("--cores", type=int, default=64, help="executor cores of the run")


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    extra = cluster_settings(args.input_bytes, args.cores) if args.input_bytes else None
    spark = build_session(app_name=f"pulsewatch-{args.command}", extra=extra)
    if args.command == "archive":
        for name, path in archiver(spark, args.tables, args.as_of, args.out, args.format).items():
            print(f"{name}: {path}")
        return
    if args.command == "maintain":
        for name, (generation, days) in maintain(spark, args.tables, args.as_of, args.archives).items():
            print(f"{name}: generation {generation}, purged {days if isinstance(days, str) else [str(d) for d in days]}")
        return
    ckpts = args.checkpoints or f"{ensure_checkpoint_dir(spark).rstrip('/')}/pulsewatch-jobs"
    if args.kafka:
        rate = {"maxOffsetsPerTrigger": str(args.rate)} if args.rate else {}
        messages = subscribe(spark, args.topic, args.kafka, args.starting_offsets, args.fail_on_data_loss, **rate)
    elif args.segments:
        place = f"{ckpts.rstrip('/')}/{args.job}-segments"
        messages = subscribe_segments(spark, args.segments, args.starting_offsets, args.fail_on_data_loss,
                                      f"{place}/start.json", f"{place}/lost")
    else:
        messages = text_stream(spark, args.files, args.rate)
    trigger = None if args.trigger in ("", "none") else args.trigger
    if args.job in WINDOWED:
        specs = WINDOWED[args.job](spark, messages, args.tables, ckpts, trigger)
    else:
        specs = listener(spark, args.job, messages, args.tables, ckpts, trigger)
    if args.available_now:
        (run_caught_up if args.segments else run_available)(specs)
    else:
        run_together(spark, specs)


if __name__ == "__main__":
    main()
