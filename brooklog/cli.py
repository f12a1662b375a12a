"""Prints the records of a change log: python -m brooklog.cli --path LOG --checkpoint DIR [...]. Each option may come from the environment as BROOKLOG_<NAME>."""

from __future__ import annotations

import argparse
import logging
import os
import signal
import uuid
from datetime import datetime, timezone

from brooklog.session import session
from brooklog.sources import changes
from brooklog.sources.control import ControlStore
from brooklog.operators.transitions import refresh_runner, register_runner
from brooklog.streaming.subscriber import json_lines, subscribe


def _time(text: str) -> str:
    datetime.fromisoformat(text.replace("Z", "+00:00"))
    return text


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="brooklog", description=__doc__)
    env = lambda name, default=None: os.environ.get(f"BROOKLOG_{name}", default)
    out.add_argument("--path", default=env("PATH"), help="change log, partitioned by partition_token")
    out.add_argument("--checkpoint", default=env("CHECKPOINT"), help="folder of the stream's offsets")
    out.add_argument("--control", default=env("CONTROL"), help="folder of the control tables; without it none are kept")
    out.add_argument("--start", type=_time, default=env("START"), help="first commit time, RFC 3339")
    out.add_argument("--end", type=_time, default=env("END"), help="last commit time, RFC 3339")
    out.add_argument("--max-partitions", type=int, default=int(env("MAX_PARTITIONS", "0")), help="partitions advanced in a batch; 0: all")
    out.add_argument("--ack-timeout", type=float, default=float(env("ACK_TIMEOUT", "0")), help="seconds; 0: none")
    out.add_argument("--pool", default=env("POOL"), help="scheduler pool, as a priority hint")
    out.add_argument("--follow", action="store_true", help="go on after all that is there has been printed")
    out.add_argument("--log-level", default=env("LOG_LEVEL", "info"))
    out.add_argument("--master", default=env("MASTER"))
    return out


def level(name: str) -> int:
    """info for a name that there isn't."""
    found = logging.getLevelNamesMapping().get(name.upper())
    if found is None:
        logging.getLogger(__name__).warning("no log level %r; info is used", name)
    return found or logging.INFO


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if not args.path or not args.checkpoint:
        parser().error("--path and --checkpoint are needed")
    logging.basicConfig(level=level(args.log_level))
    spark = session(args.master, "brooklog")
    changes.register(spark)
    options = {"path": args.path, "maxPartitionsPerTrigger": str(args.max_partitions)} | ({"startTimestamp": args.start} if args.start else {}) | ({"endTimestamp": args.end} if args.end else {})
    runner, after = str(uuid.uuid4()), None
    if args.control:
        store = ControlStore(spark, args.control)
        store.migrate()
        store.write("runners", register_runner(store.read("runners"), runner, datetime.now(timezone.utc).replace(tzinfo=None)))
        after = lambda df, n: store.write("runners", refresh_runner(store.read("runners"), runner, datetime.now(timezone.utc).replace(tzinfo=None)))
    stream = spark.readStream.format("changes").options(**options).load()
    query = subscribe(stream, args.checkpoint, json_lines(), bounded=not args.follow, ack_timeout=args.ack_timeout, pool=args.pool, name="brooklog", after_batch=after)
    signal.signal(signal.SIGINT, lambda *_: query.stop())
    signal.signal(signal.SIGTERM, lambda *_: query.stop())
    query.awaitTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
