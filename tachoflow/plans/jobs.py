"""Jobs to submit: the periodic batch run and the live stream.

    spark-submit ... -m tachoflow.plans.jobs batch  --inbox DIR --root DIR
    spark-submit ... -m tachoflow.plans.jobs stream --inbox DIR --root DIR
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import build_session, sizing_conf
from ..sources.bronze import scan_bronze
from ..sources.jsonl import WHITE_SPACE, stream_lines
from ..streaming.ingest import consume_once
from ..streaming.live import live_stream
from .batch import build
from .lake import Lake

RAW = "raw_events"
#: Files a live batch takes, so that a first start does not take the whole backlog at once.
FILES_PER_TRIGGER = 1_000


def run_batch(spark: SparkSession, inbox: str, root: str, *, strict: bool = True) -> list:
    """Load what arrived since the last run, rebuild all layers, return the check results.

    Run it on a schedule with one run at a time; a failed run can simply be repeated.
    """
    lake = Lake(spark, root=root)
    raw = lake.path("bronze", RAW)
    consume_once(spark, inbox, raw)
    return build(lake, scan_bronze(spark, raw), strict=strict)


def start_live(spark: SparkSession, inbox: str, root: str, **trigger) -> list[StreamingQuery]:
    """Feed the live table, the alert table and the quarantine from arriving messages, in one query.

    Blank lines are left out. Messages that are no JSON or hold values of a wrong type go to
    the table ``quarantine`` as they came. ``live_table`` reads the tables below ``root/live``.
    """
    lines = stream_lines(spark, inbox, FILES_PER_TRIGGER).where(F.btrim("value", F.lit(WHITE_SPACE)) != "")
    return [live_stream(lines.select("value"), f"{root}/live", f"{root}/_checkpoints/live", **trigger)]


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("job", choices=("batch", "stream"))
    parser.add_argument("--inbox", required=True, help="folder of arriving JSON-lines files")
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--every", default="10 seconds", help="trigger interval of the stream")
    parser.add_argument("--warn-only", action="store_true", help="publish even if a check fails")
    parser.add_argument("--input-bytes", type=int, default=0, help="size of bronze, to size splits and shuffles")
    options = parser.parse_args(arguments)
    spark = build_session(**sizing_conf(options.input_bytes) if options.input_bytes else {})
    if options.job == "batch":
        for row in run_batch(spark, options.inbox, options.root, strict=not options.warn_only):
            print(*row, sep="\t")
    else:
        start_live(spark, options.inbox, options.root, processingTime=options.every)
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
