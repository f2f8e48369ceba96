"""Session helpers shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, with its lineage cut.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only where that is unset (tests, a laptop) a
    temporary folder is set. Never ``localCheckpoint``: executors may be lost.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or shared_folder(spark, "checkpoints"))
    return df.checkpoint(eager=True)


def bounded_sample(df: DataFrame, key: str, rows: int, total: int, seed: int) -> DataFrame:
    """About ``rows`` rows of ``df`` (of ``total``), at most that many, those with the smallest hashes of ``key``, in that
    order: neither the choice nor the order depends on how the table is stored. A share of the hashes slightly above what is
    needed is cut off first, so that no more than the sample is ever moved."""
    share = min(1.0, 1.1 * rows / max(total, 1) + 1e-9)
    rank = F.xxhash64(key, F.lit(seed))
    small = F.shiftrightunsigned(rank, 11) < int(share * (1 << 53))
    others = [F.xxhash64(*df.columns)] if all("map<" not in t for _, t in df.dtypes) else []
    return df.filter(small).orderBy(rank, key, *others).limit(rows)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share; a temporary one only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="folioforge-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
