"""Command line of the layered run, event landing and source preparation.

    python -m yardline run --root <uri> --seeds-dir <uri>
    python -m yardline land --root <uri> --events <uri> --once
    python -m yardline prepare --out <uri> --states <uri> --municipalities <uri> ...
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging

from yardline.plans.metrics import StreamMetrics
from yardline.plans.pipeline import ALL_STAGES, QUARANTINE, STAGES, Run, run_stages
from yardline.plans.source_prep import Inputs, prepare
from yardline.session import build_session
from yardline.sources.lake import Lake
from yardline.streaming.events import (
    ALL_AVAILABLE,
    EVERY_TEN_SECONDS,
    decoded_lines,
    land,
    land_apart,
    read_lines,
)
from yardline.tables import EVENT_BATCHES, EVENT_LANDING


def _date(text: str) -> str:
    return dt.date.fromisoformat(text).isoformat()


def _year_path(text: str) -> tuple[int, str]:
    year, _, path = text.partition("=")
    return int(year), path


def _option(text: str) -> tuple[str, str]:
    key, found, value = text.partition("=")
    if not (key and found):
        raise argparse.ArgumentTypeError(f"{text!r} is not KEY=VALUE")
    return key, value


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(
        prog="yardline", description=__doc__, formatter_class=argparse.RawTextHelpFormatter
    )
    commands = top.add_subparsers(dest="command", required=True)
    for name in ("run", *ALL_STAGES):
        stage = commands.add_parser(name)
        stage.add_argument("--root", required=True, help="lake root, any Hadoop file-system URI")
        stage.add_argument("--table", action="append", help="batch table to ingest; repeatable")
        today = dt.datetime.now(dt.UTC).date().isoformat()
        stage.add_argument("--ingestion-date", default=today, type=_date)
        stage.add_argument("--seeds-dir", default="", help="folder of the source CSV files")
        stage.add_argument("--use-warehouse", action="store_true", help="read catalog tables")
        stage.add_argument("--warehouse-format", help="read sources with this connector, such as arrow_export")
        stage.add_argument(
            "--warehouse-option", action="append", default=[], type=_option, metavar="KEY=VALUE", help="option of the connector; repeatable"
        )
        stage.add_argument("--deduplicate-events", action="store_true")

    landing = commands.add_parser("land")
    landing.add_argument("--root", required=True)
    landing.add_argument("--events", required=True, help="folder in which event files appear")
    landing.add_argument("--ingestion-date", type=_date, help="default: date of the micro-batch")
    landing.add_argument("--encoded", action="store_true", help="each line is a base64 payload")
    landing.add_argument("--max-files", type=int, help="files per micro-batch")
    landing.add_argument("--apart", action="store_true", help="set malformed lines apart in the same step")
    landing.add_argument("--once", action="store_true", help="land what is there and stop")

    prep = commands.add_parser("prepare")
    prep.add_argument("--out", required=True)
    prep.add_argument("--states", required=True)
    prep.add_argument("--municipalities", required=True)
    for name in ("--entity-sheet", "--group-sheet", "--microdata"):
        prep.add_argument(name, action="append", required=True, type=_year_path, metavar="YEAR=URI")
    return top


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    args = parser().parse_args(argv)
    spark = build_session(f"yardline-{args.command}")
    if args.command == "land":
        lines = read_lines(spark, args.events, args.max_files)
        if args.encoded:
            lines = decoded_lines(lines, "value")
        lake, root = Lake(args.root), args.root.rstrip("/")
        trigger = ALL_AVAILABLE if args.once else EVERY_TEN_SECONDS
        with StreamMetrics(spark, f"{root}/run_metrics", "landing"):
            if args.apart:
                apart = lake.path("bronze", f"{QUARANTINE}/{EVENT_BATCHES}")
                mark = f"{root}/checkpoints/{EVENT_BATCHES}"
                query = land_apart(lines, lake.path("bronze", EVENT_BATCHES), apart, mark, args.ingestion_date, trigger=trigger)
            else:
                mark = f"{root}/checkpoints/{EVENT_LANDING}"
                query = land(lines, lake.path("bronze", EVENT_LANDING), mark, args.ingestion_date, trigger)
            query.awaitTermination()
    elif args.command == "prepare":
        sheets = (dict(args.entity_sheet), dict(args.group_sheet), dict(args.microdata))
        prepare(spark, Inputs(args.states, args.municipalities, *sheets), args.out)
    else:
        run = Run(
            spark,
            Lake(args.root),
            args.ingestion_date,
            seeds=args.seeds_dir,
            use_warehouse=args.use_warehouse,
            warehouse_format=args.warehouse_format,
            warehouse_options=dict(args.warehouse_option),
            deduplicate_events=args.deduplicate_events,
        )
        stages = STAGES if args.command == "run" else (args.command,)
        run_stages(run, stages, args.table)


if __name__ == "__main__":
    main()
