"""Jobs for ``spark-submit``: ``python -m skygauge <job> --raw ... --refined ...``."""

from __future__ import annotations

import argparse
from datetime import datetime

from skygauge.operators.quantiles import METHODS
from skygauge.plans import batch, recent, upkeep
from skygauge.session import build_session
from skygauge.sources.landed import LOOKBACK
from skygauge.sources.tables import Lake
from skygauge.streaming import ingest, topics
from skygauge.streaming.refresh import utc_now

BATCH = {
    "detect-weather": batch.detect_weather,
    "detect-airquality": batch.detect_air_quality,
    "refine": batch.refine_facts,
}
RECENT = {
    "recent-weather": recent.detect_recent_weather,
    "recent-airquality": recent.detect_recent_air_quality,
}
LANDING = {
    "land-weather": ("weather", ingest.WEATHER),
    "land-airquality": ("airquality", ingest.AIR_QUALITY),
}
UPKEEP = {
    "file-weather": upkeep.file_weather,
    "compact-airquality": upkeep.compact_air_quality,
    "compact-weather": upkeep.compact_weather,
}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="skygauge", description=__doc__)
    parser.add_argument("job", choices=[*BATCH, *RECENT, *LANDING, *UPKEEP])
    parser.add_argument("--raw", required=True, help="root of the raw zone")
    parser.add_argument("--refined", default="", help="root of the refined zone")
    parser.add_argument("--cities", default="", help="JSON file of coordinates by city")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="UTC moment of a recent or upkeep job")
    parser.add_argument("--lookback", type=int, default=LOOKBACK, help="seconds")
    parser.add_argument("--landed-by-stream", action="store_true",
                        help="recent weather lies in the layout of land-weather")
    parser.add_argument("--method", choices=list(METHODS), default="exact", help="quartiles of a detecting job")
    parser.add_argument("--servers", default="", help="Kafka servers of a landing job")
    parser.add_argument("--checkpoint", default="", help="checkpoint folder of a landing job")
    return parser.parse_args(argv)


def start_landing(job: str, messages, lake: Lake, checkpoint: str, trigger: dict | None = None):
    """Start the landing of a topic: its rows, and the messages that cannot be read beside them."""
    topic, kind = LANDING[job]
    return ingest.land(messages, kind, lake.raw_path(topic), lake.raw_path(f"{topic}_rejected"),
                       f"{checkpoint}/{topic}", trigger or topics.WHEN_FLUSHED)


def run(spark, args: argparse.Namespace) -> None:
    lake = Lake(args.raw, args.refined, args.cities)
    if args.job in BATCH:
        BATCH[args.job](spark, lake, **({} if args.job == "refine" else {"method": args.method}))
    elif args.job in RECENT:
        streamed = args.job == "recent-weather" and args.landed_by_stream
        layout = {"landed_by_stream": True} if streamed else {}
        RECENT[args.job](spark, lake, args.as_of or utc_now(), args.lookback, method=args.method, **layout)
    elif args.job in UPKEEP:
        UPKEEP[args.job](spark, lake, args.as_of or utc_now())
    else:
        messages = topics.topic_source(spark, args.servers, LANDING[args.job][0])
        start_landing(args.job, messages, lake, args.checkpoint).awaitTermination()


if __name__ == "__main__":
    options = arguments()
    session = build_session(f"skygauge {options.job}")
    run(session, options)
    session.stop()
