"""Shared helpers: column picking, the shared work folder, shipping code to executors."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, found by exact spelling and by position.

    Extra columns never matter, even when they differ from a wanted one in case alone
    or carry the name of a column that an operator adds.
    """
    at = []
    for name in names:
        if name in df.columns:
            at.append(df.columns.index(name))
        else:
            same = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
            if not same:
                raise ValueError(f"column {name!r} is missing; there are {df.columns}")
            at.append(same[0])
    plain = df.toDF(*[f"_p{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_p{i}").alias(n) for i, n in zip(at, names, strict=True)])


def text_batches(spark: SparkSession) -> None:
    """For applications: Arrow batches of 500 rows where the session has Spark's 10,000, as rows
    hold whole texts or blocks. Operators leave the session as it is."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir where it is set.

    Only where it is unset and driver and executors are one process (local mode, as in
    tests) a folder of this machine is set instead; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir isn't set: executors and driver need a shared folder")
        base = "file://" + tempfile.mkdtemp(prefix="wayfold-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: the lineage ends there.

    A lost executor costs its running tasks only, and random or expensive columns are
    evaluated once. An empty result keeps its schema.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package importable on the executors, whatever their Python path is."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    name = os.path.join(tempfile.mkdtemp(prefix="wayfold-code-"), "wayfold_code.zip")
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)


def slices(sizes: np.ndarray, limit: int):
    """Ranges of rows whose sizes sum to about limit; a larger row stands alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield start, len(sizes)


def text_chunks(batches, limit: int = 1 << 20):
    """Record batches cut to pieces with about limit bytes of text each."""
    passed = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if (passed := passed + batch.nbytes) > 8 * limit:
            passed = 0
            release()
        col = batch.column(batch.schema.get_field_index("text"))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, limit):
            yield batch.slice(a, b - a)
    release()


def release() -> None:
    """Gives memory that was freed back to the system, as workers wait for their next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
