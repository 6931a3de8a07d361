"""python -m wayfold.cli --month 2026-07 [--chaos KIND] [--sample [FOLDER]] [--refresh-weather] [--refresh-311]"""

from __future__ import annotations

import argparse
import os
import re
import sys
from dataclasses import replace
from pathlib import Path

from .config import Thresholds
from .plans import monthly
from .session import build
from .sources import offline
from .storage import Place


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="wayfold")
    p.add_argument("--month", required=True)
    p.add_argument("--chaos", choices=monthly.CHAOS, default="none")
    p.add_argument("--sample", nargs="?", const="data/sample", metavar="FOLDER", help="the small month in a folder, without a network: zones need 20 rides only, and outputs go to a folder of their own")
    p.add_argument("--make-sample", metavar="FOLDER", help="draw such a folder from what a run has preserved, and stop")
    p.add_argument("--refresh-weather", action="store_true")
    p.add_argument("--refresh-311", action="store_true")
    a = p.parse_args(argv)
    if not re.fullmatch(r"\d{4}-(0[1-9]|1[0-2])", a.month):
        p.error("the month is written YYYY-MM")
    data = os.environ.get("DATA_DIR", "data")
    if a.make_sample:
        spark = build()
        offline.draw(spark, Place(spark, data), a.month, Place(spark, a.make_sample))
        return 0
    feeds = monthly.Feeds.from_env()
    if a.sample:
        if not (Path(a.sample) / offline.ABOUT).exists():
            p.error(f"{a.sample} holds no sample; --make-sample draws one")
        feeds = replace(feeds, **offline.feeds(Path(a.sample)))
        data = f"{data}/of_sample"
    out = os.environ.get("OUTPUT_DIR", "output").rstrip("/")
    return monthly.run(
        monthly.Run(
            build(), a.month, feeds, data, f"{out}/sample" if a.sample else out, Path(os.environ.get("LOG_DIR", "logs")),
            Thresholds.from_env(**({"min_rides_per_zone": 20} if a.sample else {})), a.chaos, "sample" if a.sample else "full", a.refresh_weather, a.refresh_311,
        )
    )


if __name__ == "__main__":
    sys.exit(main())
