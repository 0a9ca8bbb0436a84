"""Command line for the batch pipeline (what the reference's run script and
hourly schedule do):

    python -m tickcast batch   --landing L --formatted F --documents D --checkpoint C [--as-of DATE] [--quotes Q]
    python -m tickcast periodic ...same...   # availableNow: only newly landed files are formatted
    python -m tickcast stream  --messages M --documents D --checkpoint C [--bootstrap-servers B] [--max-per-trigger N]

``--quotes`` is a folder of quote payloads (symbol, fetched_at, payload).
``--input-bytes`` sizes shuffle partitions and splits (``cluster_settings``).
"""

from __future__ import annotations

import argparse

from tickcast.operators.combine import latest_quotes
from tickcast.session import build_session, cluster_settings
from tickcast.streaming.jobs import PipelineConfig, StreamConfig, run_available_now, run_batch, start_stream


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tickcast")
    ap.add_argument("mode", choices=["batch", "periodic", "stream"])
    for name in ("documents", "checkpoint"):
        ap.add_argument(f"--{name}", required=True)
    for name in ("landing", "formatted", "messages", "bootstrap-servers"):
        ap.add_argument(f"--{name}", default=None)
    for name in ("input-bytes", "max-per-trigger"):
        ap.add_argument(f"--{name}", type=int, default=None)
    ap.add_argument("--as-of", default=None)
    ap.add_argument("--quotes", default=None)
    ap.add_argument("--master", default=None)
    ap.add_argument("--load-id", type=int, default=None)  # by default the run's time
    args = ap.parse_args(argv)
    for name in ("messages",) if args.mode == "stream" else ("landing", "formatted"):
        if getattr(args, name) is None:
            ap.error(f"{args.mode} needs --{name}")
    spark = build_session(args.master, extra=cluster_settings(args.input_bytes) if args.input_bytes else None)
    quotes = None
    if args.quotes:
        # Parquet carries its schema; fetched_at may be a date or a timestamp.
        quotes = latest_quotes(spark.read.parquet(args.quotes).select("symbol", "fetched_at", "payload"))
    if args.mode == "stream":
        start_stream(spark, StreamConfig(
            args.messages, args.documents, args.checkpoint, args.bootstrap_servers,
            quotes, args.as_of, max_per_trigger=args.max_per_trigger,
        ))
        spark.streams.awaitAnyTermination()
        return
    cfg = PipelineConfig(args.landing, args.formatted, args.documents, args.checkpoint, quotes=quotes, as_of=args.as_of)
    (run_batch if args.mode == "batch" else run_available_now)(spark, cfg, args.load_id)


if __name__ == "__main__":
    main()
