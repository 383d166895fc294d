"""Command line: tideline replay | consume | record | compare | stats | explain | health | setup | writebench."""

from __future__ import annotations

import argparse
import json
import sys


def _session(name: str, shared: str | None = None):
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName(f"tideline-{name}").config("spark.sql.session.timeZone", "UTC")
    return (builder.config("spark.checkpoint.dir", shared) if shared else builder).getOrCreate()


def replay(args) -> int:
    """Replay archive files and folders; with --store merge all tables there. Prints the summary."""
    from pyspark.sql import Observation

    from tideline.plans.replay import Replay
    from tideline.sources.archive import read_archive
    from tideline.sources.shared import cleaned, settled

    spark, skipped = _session("replay", args.shared), Observation()
    raw = settled(read_archive(spark, *args.paths, skipped=skipped), "raw")
    print(json.dumps(Replay(raw).run(args.store) | {"skipped_lines": skipped.get["n"]}))
    cleaned(spark)
    return 0


def consume(args) -> int:
    """Record the live socket and store what comes of it, until a signal ends it; what has come is stored before it ends."""
    import signal
    import threading

    from tideline.sources import live, metrics_text, settings
    from tideline.streaming import live as stream
    from tideline.streaming import observed

    own, series = settings.load(), observed.Series()
    spark = _session("consume", args.shared)
    spark.streams.addListener(stream.Progress())
    spark.streams.addListener(observed.Observer(series))
    ended = threading.Event()
    for s in (signal.SIGINT, signal.SIGTERM):
        signal.signal(s, lambda *_: ended.set())
    recorder = live.Recorder(own.archive, seconds=args.segment)
    source = live.frames(lambda: live.WebSocket(own.url))

    def until_ended():
        for payload in source:
            if ended.is_set():
                return
            yield payload

    thread = threading.Thread(target=live.record, args=(until_ended(), recorder), daemon=True)
    thread.start()
    trigger = {"processingTime": f"{args.segment} seconds"}
    raw = stream.archive_stream(spark, own.archive)
    queries = [stream.store_stream(raw, own.store, f"{own.store}/_checkpoints/records", trigger), stream.store_live(raw, own.store, f"{own.store}/_checkpoints/live", trigger=trigger, series=series)]
    while not ended.wait(args.segment):
        if series.store(spark, f"{own.store}/_metrics"):
            metrics_text.written(series.samples(spark)).coalesce(1).write.mode("overwrite").text(f"{own.store}/_metrics_text")
        if failed := next((q for q in queries if q.exception()), None):
            print(failed.exception(), file=sys.stderr)
            return 1
    thread.join(5)
    recorder.close()
    stream.drained(*queries)
    return 0


def record(args) -> int:
    """Record the live socket's frames to the archive for some seconds."""
    from tideline.sources import live, settings

    own = settings.load()
    print(live.record(live.frames(lambda: live.WebSocket(own.url)), live.Recorder(args.root or own.archive), seconds=args.seconds))
    return 0


def compare(args) -> int:
    """The Markdown report on both detectors over the stored features."""
    from tideline.operators import compare as report
    from tideline.operators import detectors
    from tideline.sources import sinks
    from tideline.sources.shared import settled

    spark = _session("compare", args.shared)
    rows = settled(detectors.vectors(sinks.stored(spark, args.store, "features")), "vectors")
    both = settled(report.both_scored(detectors.zscores(rows), detectors.forest_scores(rows)), "both")
    text = report.report(both)
    if args.out:
        with open(args.out, "w", encoding="utf-8") as f:
            f.write(text)
    else:
        print(text)
    return 0


def setup(args) -> int:
    """Make the stored tables that aren't there yet."""
    from tideline.sources import sinks

    print("made", ", ".join(sinks.set_up(_session("setup", args.shared), args.store)) or "nothing")
    return 0


def writebench(args) -> int:
    """Rows a second of appends and merges of made-up trades into new tables below --store."""
    import time

    from pyspark.sql import functions as F

    from tideline.sources import sinks

    spark = _session("writebench", args.shared)
    at, n = F.timestamp_seconds(1_700_000_000 + F.col("id") % 86_400).alias("time"), F.col("id")
    money = lambda c: c.cast("decimal(18,8)")
    rows = spark.range(args.rows).select(at, F.concat(F.lit("S"), n % 4).alias("symbol"), n.alias("trade_id"), money(1 + n % 997 / 7).alias("price"), money(1 + n % 13).alias("qty"), (n % 2 == 0).alias("buyer_is_maker"), at.alias("event_time"), at.alias("received_at"))
    ways = {"append": lambda path: sinks.append(rows, path), "merge": lambda path: sinks.merge(rows, path, "trades", partition="time")}
    for name, path in (("append", "appended"), ("merge", "merged"), ("merge again", "merged")):
        began = time.perf_counter()
        took = ways[name.split(" ")[0]](f"{args.store}/{path}")
        seconds = time.perf_counter() - began
        print(json.dumps({"way": name, "rows": took, "seconds": round(seconds, 3), "rows_per_s": round(args.rows / seconds)}))
    return 0


def stats(args) -> int:
    """Rows, files, bytes and days of each stored table."""
    from tideline.schemas import TABLES
    from tideline.sources import sinks

    spark = _session("stats", args.shared)
    for name in TABLES:
        if sinks.read_or_none(spark, f"{args.store}/{name}") is not None:
            print(name, json.dumps(sinks.table_stats(spark, f"{args.store}/{name}").first().asDict(), default=str))
    return 0


def explain(args) -> int:
    """The plan and the time of the query for each symbol's latest trade."""
    from tideline.operators import dashboard
    from tideline.sources import sinks

    spark = _session("explain", args.shared)
    trades = sinks.stored(spark, args.store, "trades")
    plan, seconds = sinks.explained(dashboard.latest(trades, "symbol", ["time", "price"], ("time", "trade_id")))
    print(plan)
    print(f"{seconds:.3f} s")
    return 0


def health(args) -> int:
    """0 if the newest stored trade or depth update, or the last frame that the text in --metrics tells of, was received at most --age seconds ago."""
    from pyspark.sql import functions as F

    from tideline.operators import metrics
    from tideline.sources import metrics_text, sinks

    spark = _session("health", args.shared)
    if args.metrics:
        last = metrics_text.read(spark.read.text(args.metrics)).where("name = 'last_frame_timestamp_seconds'")
        row = metrics.staleness(last.select(F.timestamp_seconds("value").alias("t")), F.current_timestamp(), [], "t", args.age).first()
        print(row.health, "no frame yet" if row.age_s is None else f"last frame {row.age_s:.1f} s ago")
        return int(row.health != "healthy")
    rows = sinks.stored(spark, args.store, "trades").select("received_at").unionAll(sinks.stored(spark, args.store, "depth_updates").select("received_at"))
    row = metrics.staleness(rows, F.current_timestamp(), [], "received_at", args.age).first()
    print(row.health, "no frame yet" if row.age_s is None else f"last frame {row.age_s:.1f} s ago")
    return int(row.health != "healthy")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tideline", description=__doc__)
    out.add_argument("--shared", help="folder for intermediate tables that all machines share (spark.checkpoint.dir)")
    commands = out.add_subparsers(dest="command", required=True)

    def command(run, *arguments):
        one = commands.add_parser(run.__name__, help=run.__doc__)
        one.set_defaults(run=run)
        for names, options in arguments:
            one.add_argument(*names, **options)

    store = (["--store"], {"required": True})
    command(replay, (["paths"], {"nargs": "+"}), (["--store"], {}))
    command(consume, (["--segment"], {"type": float, "default": 10.0}))
    command(record, (["--root"], {}), (["--seconds"], {"type": float, "default": 60.0}))
    command(compare, store, (["--out"], {}))
    command(stats, store)
    command(explain, store)
    command(health, (["--store"], {}), (["--metrics"], {}), (["--age"], {"type": int, "default": 60}))
    command(setup, store)
    command(writebench, store, (["--rows"], {"type": int, "default": 1_000_000}))
    return out


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.run is health and not (args.store or args.metrics):
        parser().error("health needs --store or --metrics")
    return args.run(args)


if __name__ == "__main__":
    sys.exit(main())
