"""Incremental ingestion of files and records: stable files, first-seen deduplication, routing of outcomes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioforge.operators.maintain import error_records


def watch_files(spark: SparkSession, folder: str, *, recursive: bool = True, newest_first: bool = True) -> DataFrame:
    """A stream of the PDF files that appear in a folder, with their hash; work folders are left out, and so are empty files,
    which are still being written."""
    options = {"recursiveFileLookup": str(recursive).lower(), "latestFirst": str(newest_first).lower()}
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").options(**options).load(folder)
    inside = F.col("path").rlike(r"(?i)\.pdf$") & ~F.col("path").rlike(r"/(completed|errors)/")
    return files.filter(inside & (F.col("length") > 0)).withColumn("pdf_hash", F.sha2("content", 256))


def stable(modified: Column, now: Column, debounce: float = 3.0) -> Column:
    """Whether a file has not been touched for ``debounce`` seconds."""
    return modified < now - F.make_dt_interval(secs=F.lit(debounce))


def first_seen(stream: DataFrame, key: str = "pdf_hash", *, time: str | None = None, late: str = "30 days") -> DataFrame:
    """Keep-first by key; with a time column the state is kept for ``late`` only, without one for ever."""
    if time:
        return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def split_duplicates(batch: DataFrame, seen: DataFrame, key: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(new rows, duplicates) of a micro-batch against the table of seen keys (key): the first of a key in the batch that was not
    seen is new. A minimum by key, computed partially before the shuffle, finds it."""
    first = batch.groupBy(key).agg(F.min(F.struct(*order)).alias("__first"))
    marked = batch.join(first, key).withColumn("__new", F.struct(*order) == F.col("__first"))
    known = marked.join(seen.select(key).distinct().withColumn("__seen", F.lit(True)), key, "left")
    new = F.col("__new") & F.col("__seen").isNull()
    clean = known.withColumn("__new", new).drop("__first", "__seen")
    return clean.filter("__new").drop("__new"), clean.filter("not __new").drop("__new")


def ingest(stream: DataFrame, *, seen_path: str, new_path: str, duplicate_path: str, checkpoint: str, key: str, order: list[str], process: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Runs a stream of records into three tables: keys seen, new records (through ``process``), duplicates; until what is there
    is worked off. A batch is written under its number, so a batch that is run again replaces itself."""

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        key_type = df.schema[key].dataType
        if _exists(spark, seen_path):
            seen = spark.read.parquet(seen_path).filter(F.col("batch") < number).select(key)
        else:
            seen = spark.createDataFrame([], f"`{key}` {key_type.simpleString()}")
        df.persist()
        new, duplicates = split_duplicates(df, seen, key, order)
        (process or (lambda x: x))(new).write.mode("overwrite").parquet(f"{new_path}/batch={number}")
        duplicates.write.mode("overwrite").parquet(f"{duplicate_path}/batch={number}")
        new.select(key).write.mode("overwrite").parquet(f"{seen_path}/batch={number}")
        df.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def route(status: Column, seen: Column) -> Column:
    """Where a file goes: duplicates and failures are put aside."""
    return F.when(F.coalesce(seen, F.lit(False)), "errors/duplicates").when(status == "ok", "completed").otherwise("errors")


def deliver(batch: DataFrame, number: int, folder: str) -> None:
    """Writes a micro-batch of outcomes (path, status, reason, seen, at, trace) to its sinks below ``folder``: each row goes to the
    table of its route, and a failure has its error record as well. A batch that is run again replaces itself."""
    routed = batch.withColumn("route", route(F.col("status"), F.col("seen")))
    for name in ("completed", "errors", "errors/duplicates"):
        routed.filter(F.col("route") == name).drop("route").write.mode("overwrite").parquet(f"{folder}/{name.replace('/', '-')}/batch={number}")
    failed = routed.filter("route = 'errors'").select("path", "at", F.col("reason").alias("error"), "trace")
    error_records(failed).write.mode("overwrite").parquet(f"{folder}/error-records/batch={number}")


def settle(batch: DataFrame, waiting: DataFrame, now: Column, debounce: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """(files that are complete, files that wait) of a micro-batch and of those that waited (path, modificationTime, length, ...):
    a file is complete if it is not empty and was not touched for ``debounce`` seconds; of several states of a file the last
    counts. What waits is asked again with the next batch."""
    every = batch.unionByName(waiting)
    last = every.groupBy("path").agg(F.max_by(F.struct(*[c for c in every.columns if c != "path"]), F.struct("modificationTime", "length")).alias("f")).select("path", "f.*")
    done = stable(F.col("modificationTime"), now, debounce) & (F.col("length") > 0)
    return last.filter(done), last.filter(~done)
