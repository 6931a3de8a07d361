"""A month in small: drawn from what a run has preserved, and read again without a network.

Rides are drawn by a hash, exactly as many as asked for; everything else is copied as it
is. The folder's addresses stand in for those of the services, so a run on it takes the
same way as any other.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..storage import Place
from . import tables

#: The folder's files, and what it says about itself.
FILES = {"trips": "trips_{month}.parquet", "zones": "zones.csv", "shapes": "zones.zip", "weather": "weather_{month}.json", "complaints": "complaints_{month}.json"}
ABOUT, LABEL = "SAMPLE.json", "sample, not the whole data"


def draw(spark: SparkSession, data: Place, month: str, to: Place, rides: int = 10_000, seed: int = 42) -> dict:
    """Writes the folder from the raw files under data; returns what it says about itself."""
    name = {k: v.format(month=month) for k, v in FILES.items()}
    raw = data / "raw"
    source = spark.read.parquet(str(raw / "hvfhv" / month / f"fhvhv_tripdata_{month}.parquet"))
    keyed = source.select(F.col("_metadata.row_index").alias("ride_id"), "*")
    drawn = tables.sample(keyed, rides, seed)
    parts = to / "_rides"
    parts.delete()
    drawn.drop("ride_id").coalesce(1).write.parquet(str(parts))  # a few thousand rows: one file, as the service has it
    whole = next(n for n in parts.names() if n.endswith(".parquet"))
    (to / name["trips"]).delete()
    (parts / whole).move(to / name["trips"])
    parts.delete()
    for kind, at in (("zones", "taxi_zone_lookup.csv"), ("shapes", "taxi_zones.zip")):
        (to / name[kind]).write((data / "reference" / at).read())
    folder = raw / "weather" / month
    (to / name["weather"]).write((folder / (folder / "_manifest.json").read_json()["file"]).read())
    folder = raw / "nyc311" / month
    kept = (folder / "_manifest.json").read_json()
    rows = [r for p in kept["pages"] for r in json.loads((folder / kept["folder"] / p["file"]).read())]
    (to / name["complaints"]).write(json.dumps(rows))
    about = {"label": LABEL, "month": month, "seed": seed, "source_rows": source.count(), "rides": drawn.count(), "sha256": {k: (to / n).sha256() for k, n in name.items()}}
    (to / ABOUT).write_json(about)
    return about


def feeds(folder: Path) -> dict[str, str]:
    """Addresses of the folder's files, as Feeds takes them."""
    return {k: (folder.resolve() / "_").as_uri()[:-1] + n for k, n in FILES.items()}
