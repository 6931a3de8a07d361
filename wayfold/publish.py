"""Editions of a month by a log of manifests, and the files in them."""

from __future__ import annotations

import csv
import io
import json
import logging
import re
import time
from pathlib import Path

from pyspark.sql import DataFrame

from .storage import Place

log = logging.getLogger("wayfold")


class Edition:
    """A month's files in the making; published by one manifest.

    `<month>/editions/<name>` is written once and never changed or renamed. `<month>/log` holds a
    manifest for each edition that was published, numbered, created only if that number is free,
    and never changed. Readers follow the newest manifest that they can read whole, so between
    any two steps of a writer they see one whole edition, also on object stores, where a rename
    is a copy. A writer that dies leaves a folder without a manifest, or a manifest that isn't
    whole; both are passed over, and tidied away later.
    """

    #: Editions that stay for readers that began with them; hours until a folder without a manifest counts as left behind.
    KEPT, STALE_H = 2, 24.0

    def __init__(self, output: Place, month: str, run_id: str):
        self.month, self.name = output / month, run_id
        self.folder = self.month / "editions" / run_id
        if self.folder.exists():
            raise FileExistsError(f"{self.folder} is there already")
        self.folder.mkdir()

    def publish(self) -> Place:
        """Makes this the edition that readers see; the last one to publish counts."""
        held = {"edition": self.name, "files": self.folder.sizes()}
        number = max(numbers(self.month), default=0) + 1
        while not (self.month / "log" / f"{number:08d}.json").create(json.dumps(held | {"number": number})):
            number += 1
        try:
            self.tidy()
        except Exception as e:  # it is published all the same
            log.warning("older editions of %s stay: %s", self.month, e)
        return self.folder

    def discard(self) -> None:
        self.folder.delete()

    def tidy(self) -> None:
        """Removes manifests and folders of editions that are no longer kept, manifests first."""
        known = [(n, m) for n in numbers(self.month) if (m := manifest(self.month, n))]
        for n, m in known[: -self.KEPT]:
            (self.month / "log" / f"{n:08d}.json").delete()
        kept = {m["edition"] for _, m in known[-self.KEPT :]}
        dropped = {m["edition"] for _, m in known[: -self.KEPT]} - kept
        for name in (self.month / "editions").names():
            folder = self.month / "editions" / name
            if name in dropped or (name not in kept and folder.hours_old() >= self.STALE_H):
                folder.delete()


def numbers(month: Place) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in (month / "log").names() if re.fullmatch(r"\d{8,}\.json", n))


def manifest(month: Place, number: int) -> dict | None:
    """A manifest, or None where it isn't whole."""
    found = (month / "log" / f"{number:08d}.json").read_json()
    return found if isinstance(found, dict) and "edition" in found else None


def current(output: Place, month: str) -> Place | None:
    """The folder of the edition that counts, or None."""
    at = output / month
    for n in reversed(numbers(at)):
        if found := manifest(at, n):
            return at / "editions" / found["edition"]
    return None


def csv_text(rows: list[dict]) -> str:
    """Rows as CSV with a header; no rows give no header either."""
    out = io.StringIO()
    if rows:
        w = csv.DictWriter(out, list(rows[0]))
        w.writeheader()
        w.writerows(rows)
    return out.getvalue()


def small_csv(df: DataFrame, to: Place) -> None:
    """For frames of a row a zone or a bounded preview."""
    to.write(csv_text([r.asDict() for r in df.collect()]))


def one_csv(df: DataFrame, to: Place) -> None:
    """A frame as one CSV file under one name, with a header; null is nothing, "" an empty text.

    One task writes it as its rows come by, so memory is bounded; for frames that are few enough
    to be a file, like a month's complaints. Quotes in values are doubled. The file is moved by
    name once, inside an edition that nobody reads yet.
    """
    parts = to.parent / f"{to.name}.parts"
    df.coalesce(1).write.option("header", True).option("escape", '"').csv(str(parts))
    (part,) = [n for n in parts.names() if n.endswith(".csv")]
    (parts / part).move(to)
    parts.delete()


def logger(folder: Path, month: str, run_id: str, level: str = "INFO") -> logging.Logger:
    folder.mkdir(parents=True, exist_ok=True)
    h = logging.FileHandler(folder / f"pipeline_{month}.log")
    f = logging.Formatter(f"%(asctime)sZ %(levelname)s run={run_id} %(message)s")
    f.converter = time.gmtime
    h.setFormatter(f)
    for old in list(log.handlers):
        log.removeHandler(old)
        old.close()
    log.addHandler(h)
    log.setLevel(level)
    return log
