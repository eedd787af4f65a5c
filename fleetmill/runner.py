"""Runs the jobs from a command line: ``python -m fleetmill.runner JOB --root DIR …``, or all of them,
in order, by run_pipeline()."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from fleetmill.config import DEFAULT, Settings
from fleetmill.sources import tables
from fleetmill.sources.files import download_feed
from fleetmill.streaming import jobs


@dataclass(frozen=True)
class Layout:
    """Where tables and checkpoints lie; all below folders that every executor sees."""

    root: str
    raw: str
    checkpoints: str

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.checkpoints.rstrip('/')}/{name}"


def _table(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    return tables.read_table(spark, layout.table(name))


def streaming_jobs(spark: SparkSession, layout: Layout, cfg: Settings = DEFAULT, once: bool = True) -> dict[str, Callable]:
    """Each starts one streaming query and returns it; with ``once`` it takes what is there and ends."""
    t, c = layout.table, layout.checkpoint
    return {
        "bronze": lambda: jobs.bronze(spark, layout.raw, t("bronze"), c("bronze"), cfg, once),
        "silver": lambda: jobs.silver_positions(spark, t("bronze"), _table(spark, layout, "gtfs_routes"), t("positions"), c("silver"), cfg, once),
        "arrivals": lambda: jobs.stop_arrivals(spark, t("positions"), _table(spark, layout, "gtfs_stops"), t("stop_arrivals"), c("arrivals"), cfg, once),
        "speed": lambda: jobs.speed(spark, t("positions"), t("speed_congestion"), c("speed"), cfg, once),
        "headway": lambda: jobs.headway(spark, t("stop_arrivals"), t("headway_regularity"), c("headway"), cfg, once),
        "on-time": lambda: jobs.on_time(spark, t("stop_arrivals"), _table(spark, layout, "gtfs_stop_times"), t("on_time_performance"), c("on_time"), cfg, once),
    }


def daily_jobs(spark: SparkSession, layout: Layout, day: str) -> dict[str, Callable[[], None]]:
    t = layout.table
    return {
        "fleet": lambda: tables.fleet_day(spark, _table(spark, layout, "positions"), _table(spark, layout, "gtfs_stop_times"), _table(spark, layout, "gtfs_routes"), day, t("fleet_utilization")),
        "equity": lambda: tables.equity_day(spark, _table(spark, layout, "positions"), _table(spark, layout, "census"), day, t("coverage_equity")),
    }


def run_pipeline(spark: SparkSession, layout: Layout, day: str, cfg: Settings = DEFAULT) -> list[str]:
    """All streaming jobs over what is there, each after the one that it reads, then the day's tables;
    the names of the jobs in the order in which they ran."""
    done = []
    for name, start in streaming_jobs(spark, layout, cfg).items():
        start().awaitTermination()
        done.append(name)
    for name, run in daily_jobs(spark, layout, day).items():
        run()
        done.append(name)
    return done


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="fleetmill", description="Jobs over vehicle positions")
    out.add_argument("job", choices=["bronze", "silver", "arrivals", "speed", "headway", "on-time", "fleet", "equity", "load-gtfs", "load-census", "pipeline"])
    out.add_argument("--root", required=True, help="folder of the tables")
    out.add_argument("--raw", help="folder of the raw messages (default: raw in the root)")
    out.add_argument("--checkpoints", help="folder of the checkpoints (default: _checkpoints in the root)")
    out.add_argument("--source", help="feed archive (a path or an http address), or census file")
    out.add_argument("--work", default="/tmp/fleetmill-feed", help="folder that all executors see, in which a feed is unpacked")
    out.add_argument("--date", default=str(date.today() - timedelta(days=1)), help="day of the daily tables (default: yesterday)")
    out.add_argument("--follow", action="store_true", help="keep streaming instead of ending with what is there")
    return out


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    layout = Layout(args.root, args.raw or f"{args.root.rstrip('/')}/raw", args.checkpoints or f"{args.root.rstrip('/')}/_checkpoints")
    spark = spark or SparkSession.builder.appName(f"fleetmill-{args.job}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    cfg = Settings.from_env()
    if args.job == "load-gtfs":
        archive = args.source if "://" not in args.source else download_feed(args.source, f"{args.work}/feed.zip")
        tables.load_gtfs(spark, archive, f"{args.work}/feed", args.root.rstrip("/"))
    elif args.job == "load-census":
        tables.load_census(spark, args.source, layout.table("census"), cfg)
    elif args.job == "pipeline":
        run_pipeline(spark, layout, args.date, cfg)
    elif args.job in (daily := daily_jobs(spark, layout, args.date)):
        daily[args.job]()
    else:
        streaming_jobs(spark, layout, cfg, not args.follow)[args.job]().awaitTermination()


if __name__ == "__main__":
    main()
