"""Files by way of Spark's own file systems: what is staged on a cluster is where executors see it."""

from __future__ import annotations

import json
import os
import posixpath
import re
import tempfile
import time
import uuid
from pathlib import Path
from urllib.parse import unquote, urlsplit

from pyspark.sql import SparkSession


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process."""
    return bool(re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master))


class Place:
    """A file or folder by its address; a plain path is one of the default file system's, or, in
    local mode, of this machine."""

    def __init__(self, spark: SparkSession, address: str | os.PathLike):
        self.spark, self.jvm = spark, spark.sparkContext._jvm
        text = os.fspath(address)
        if "://" not in text and not text.startswith("file:") and is_local(spark):
            text = Path(text).resolve().as_uri()
        self.path = self.jvm.org.apache.hadoop.fs.Path(text)
        fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        # checksum files beside local files would be left behind by whoever edits these
        self.fs = fs.getRaw() if fs.getScheme() == "file" else fs
        self.uri = self.fs.makeQualified(self.path).toString()

    def __truediv__(self, name: str) -> Place:
        return Place(self.spark, posixpath.join(self.uri, name))

    def __str__(self) -> str:
        return self.uri

    @property
    def name(self) -> str:
        return self.path.getName()

    @property
    def parent(self) -> Place:
        return Place(self.spark, self.path.getParent().toString())

    def exists(self) -> bool:
        return self.fs.exists(self.path)

    def mkdir(self) -> Place:
        self.fs.mkdirs(self.path)
        return self

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path)) if self.exists() else []

    def delete(self) -> None:
        self.fs.delete(self.path, True)

    def move(self, to: Place) -> None:
        """Renames to a name that is free; nothing changes if that fails."""
        if to.exists():
            raise FileExistsError(f"{to} is there already")
        if not self.exists():
            raise FileNotFoundError(str(self))
        if not self.fs.rename(self.path, to.path):
            raise OSError(f"{self} can't become {to}")

    def read(self) -> bytes:
        stream = self.fs.open(self.path)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, content: bytes | str) -> None:
        self.fs.mkdirs(self.path.getParent())
        stream = self.fs.create(self.path, True)
        try:
            stream.write(content.encode() if isinstance(content, str) else content)
        finally:
            stream.close()

    def create(self, content: str) -> bool:
        """Writes a file that isn't there, whole; False if it is there, whoever wrote it."""
        self.fs.mkdirs(self.path.getParent())
        if urlsplit(self.uri).scheme == "file":  # a link takes a free name or none
            to = urlsplit(self.uri).path
            own = f"{posixpath.dirname(unquote(to))}/.{uuid.uuid4().hex}"
            Path(own).write_text(content)
            try:
                os.link(own, unquote(to))
            except FileExistsError:
                return False
            finally:
                os.unlink(own)
            return True
        try:
            stream = self.fs.create(self.path, False)
        except Exception:
            if self.exists():
                return False
            raise
        try:
            stream.write(content.encode())
        finally:
            stream.close()
        return True

    def sizes(self) -> dict[str, int]:
        """Bytes of all files below, by their paths from here."""
        found, files = {}, self.fs.listFiles(self.path, True)
        while files.hasNext():
            f = files.next()
            found[f.getPath().toString()[len(self.uri) :].lstrip("/")] = f.getLen()
        return found

    def hours_old(self) -> float:
        return (time.time() * 1000 - self.fs.getFileStatus(self.path).getModificationTime()) / 3.6e6

    def put(self, local: Path) -> None:
        """Copies a file of the driver here: under a side name first, so that a name means a whole file."""
        self.fs.mkdirs(self.path.getParent())
        side = Place(self.spark, f"{self.uri}.part")
        self.fs.copyFromLocalFile(False, True, self.jvm.org.apache.hadoop.fs.Path(local.resolve().as_uri()), side.path)
        self.delete()
        side.move(self)

    def sha256(self) -> str:
        stream = self.fs.open(self.path)
        try:
            return self.jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()

    def read_json(self):
        """The value, or None where there is none that can be read."""
        try:
            return json.loads(self.read()) if self.exists() else None
        except json.JSONDecodeError:
            return None

    def write_json(self, value) -> None:
        self.write(json.dumps(value, indent=2, default=str))


def work_folder(spark: SparkSession, name: str) -> Place:
    """A new folder under spark.checkpoint.dir; where that is unset, in local mode only, under this machine's temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not is_local(spark):
            raise ValueError("spark.checkpoint.dir isn't set: executors and driver need a shared folder")
        base = tempfile.mkdtemp(prefix="wayfold-")
    return (Place(spark, base) / f"{name}-{uuid.uuid4().hex}").mkdir()
