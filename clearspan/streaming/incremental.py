"""Incremental reads and keyed file state with Structured Streaming."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from clearspan.operators.joins import codes_of_pair
from clearspan.operators.lookup import lookup_join, materialised
from clearspan.sources import commits
from clearspan.sources.readers import file_snapshot, path_exists
from clearspan.sources.sinks import write_touched_partitions


def new_files(spark: SparkSession, folder: str, schema: T.StructType, file_format: str = "parquet") -> DataFrame:
    """Stream of the files not yet taken by the query's checkpoint."""
    return spark.readStream.format(file_format).schema(schema).option("recursiveFileLookup", "true").load(folder)


def run_once(stream: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process everything that is new, then stop; the checkpoint is the bookmark."""
    query = (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_rates(spark: SparkSession, source: str, schema: T.StructType, currencies: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """New rate files, with numeric codes, replace the touched (brand, date) partitions.

    A batch repeated after a failure writes the same partitions again.
    """

    def store(batch: DataFrame, _epoch: int) -> None:
        write_touched_partitions(codes_of_pair(batch, currencies), target, ["brand", "exchange_date"])

    return run_once(new_files(spark, source, schema), checkpoint, store)


def register_arrivals(arrivals: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger rows for a batch of arrivals: one per file id and content hash not yet registered.

    The first version of a file is new, each further content a new version; repeated
    arrivals of known content are counted as duplicates.
    """
    contents = arrivals.groupBy("file_id", "content_hash").agg(
        F.min("arrived_at").alias("registered_at"), F.count("*").alias("arrivals")
    )
    known = ledger.select("file_id", "content_hash").distinct().withColumn("__known", F.lit(1))
    versions = ledger.groupBy("file_id").agg(F.count_if(F.col("status") != "duplicate").alias("__versions"))
    marked = lookup_join(contents, known, ["file_id", "content_hash"], ["__known"])
    marked = lookup_join(marked, versions, ["file_id"], ["__versions"])
    fresh = F.when(F.col("__known").isNull(), 1).otherwise(0)
    order = Window.partitionBy("file_id").orderBy("registered_at", "content_hash").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(fresh).over(order), F.lit(0)) + F.coalesce("__versions", F.lit(0))
    status = F.when(fresh == 0, "duplicate").when(earlier == 0, "new").otherwise("new version")
    return marked.select("file_id", "content_hash", "registered_at", "arrivals", status.alias("status"))


LEDGER_SCHEMA = "file_id string, content_hash string, registered_at timestamp, arrivals bigint, status string"


#: How long a file that does not arrive again stays in the streaming state.
KEEP_DAYS = 400


def _combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Arrivals of one content in one task as one row, before the shuffle."""
    for batch in batches:
        yield batch.groupby(["file_id", "content_hash"], as_index=False).agg(registered_at=("arrived_at", "min"), arrivals=("arrived_at", "size")).assign(known=False)


def _registered(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Ledger rows of one file's arrivals; the state has the contents registered so far."""
    if state.hasTimedOut:
        state.remove()
        return
    contents = set(state.get[0]) if state.exists else set()
    arrived: dict[str, list] = {}
    for batch in batches:
        contents.update(batch.loc[batch["known"], "content_hash"])
        for row in batch[~batch["known"]].itertuples():
            held = arrived.setdefault(row.content_hash, [row.registered_at, 0])
            held[0], held[1] = min(held[0], row.registered_at), held[1] + row.arrivals
    rows, versions, earlier = [], len(contents), set(contents)
    for content, (at, count) in sorted(arrived.items(), key=lambda x: (x[1][0], x[0])):
        status = "duplicate" if content in earlier else "new version" if versions else "new"
        versions += content not in earlier
        contents.add(content)
        rows.append((key[0], content, at, count, status))
    state.update((sorted(contents),))
    state.setTimeoutDuration(KEEP_DAYS * 86_400_000)
    if rows:
        yield pd.DataFrame(rows, columns=["file_id", "content_hash", "registered_at", "arrivals", "status"])


def run_ledger(arrivals: DataFrame, ledger_path: str, checkpoint: str) -> StreamingQuery:
    """Keep the file ledger up to date; each micro-batch of each checkpoint owns one partition, so a retry rewrites it.

    The contents of each file are keyed streaming state: a batch reads its own arrivals, and of the ledger only what was
    written since the batch before. A new checkpoint starts with all of the ledger, overwrites none of it and counts its
    batches from 0 again, as another run. A file that does not arrive for ``KEEP_DAYS`` leaves the state.
    """
    spark = arrivals.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger_path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    written = spark.readStream.schema(f"{LEDGER_SCHEMA}, run string, epoch bigint").parquet(ledger_path)
    shape = "file_id string, content_hash string, registered_at timestamp, arrivals bigint, known boolean"
    known = written.select("file_id", "content_hash", "registered_at", F.lit(0).cast("bigint").alias("arrivals"), F.lit(True).alias("known"))
    arrived = arrivals.select("file_id", "content_hash", "arrived_at").mapInPandas(_combined, shape)
    rows = known.union(arrived).groupBy("file_id").applyInPandasWithState(
        _registered, LEDGER_SCHEMA, "contents array<string>", "append", GroupStateTimeout.ProcessingTimeTimeout
    )

    def register(batch: DataFrame, epoch: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_touched_partitions(batch.withColumn("run", F.lit(run)).withColumn("epoch", F.lit(epoch)), ledger_path, ["run", "epoch"])

    # With a timeout by the clock Spark would otherwise follow up with batches without data, one after the other.
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return run_once(rows, checkpoint, register)
    finally:
        spark.conf.set(setting, before)


def run_new_and_changed(
    spark: SparkSession, folder: str, schema: T.StructType, bookmark: str, work: Callable[[DataFrame, int], None], file_format: str = "parquet"
) -> int:
    """Work on the files that are new or were rewritten since the last good run; returns how many there were.

    The bookmark is a committed snapshot of all files by path, time and length. It moves on only after ``work`` returns,
    so a run that fails is repeated whole; of two runs at once one fails at its commit. ``work`` gets the rows and the number
    of the run, which is the same again after a failure.
    """
    log = f"{bookmark}/_commits"
    number, entry = commits.latest(spark, log)
    path = f"{bookmark}/snapshots/{uuid.uuid4().hex}"
    file_snapshot(spark, folder).write.parquet(path)
    now = spark.read.parquet(path)
    fresh = now if entry is None else now.join(spark.read.parquet(entry["path"]), ["path", "modified", "length"], "left_anti")
    paths = sorted(r["path"] for r in fresh.select("path").toLocalIterator())
    if not paths:
        commits.remove(spark, path)
        return 0
    work(spark.read.format(file_format).schema(schema).option("basePath", folder).load(paths), number + 1)
    commits.commit(spark, log, number, {"path": path})
    return len(paths)


# States of a file.
PENDING, PROCESSING, COMPLETED, FAILED = "PENDING", "PROCESSING", "COMPLETED", "FAILED"
STATE_SCHEMA = "file_id string, content_hash string, state string, at timestamp, error string, run string, step int"


def state_log(spark: SparkSession, path: str) -> DataFrame:
    """All state changes so far; none if nothing was processed yet."""
    if path_exists(spark, path):
        return spark.read.schema(STATE_SCHEMA).parquet(path)
    return spark.createDataFrame([], STATE_SCHEMA)


def file_states(ledger: DataFrame, log: DataFrame) -> DataFrame:
    """Registered files with ``state, attempts, started_at, ended_at, error`` of their last attempt.

    A file without a state change is pending; one whose run broke off stays in processing.
    """
    newest = F.max(F.struct("at", "step", "state", "error"))
    last = log.groupBy("file_id", "content_hash").agg(
        newest.alias("last"), F.count_if(F.col("state") == PROCESSING).alias("attempts"), F.max(F.when(F.col("state") == PROCESSING, F.col("at"))).alias("started_at")
    )
    known = last.select(
        "file_id", "content_hash", "attempts", "started_at", F.col("last.state").alias("state"), F.col("last.error").alias("error"),
        F.when(F.col("last.state") != PROCESSING, F.col("last.at")).alias("ended_at"),
    )
    files = ledger.where("status <> 'duplicate'")
    joined = lookup_join(files, known, ["file_id", "content_hash"], ["state", "attempts", "started_at", "ended_at", "error"])
    return joined.withColumn("state", F.coalesce("state", F.lit(PENDING))).withColumn("attempts", F.coalesce("attempts", F.lit(0)))


def process_files(ledger: DataFrame, states_path: str, run: str, work: Callable[[DataFrame], DataFrame], take: tuple[str, ...] = (PENDING, PROCESSING)) -> None:
    """Work on the registered files that are in one of the states ``take``, and log how each of them ended.

    ``work`` gets the files and returns ``file_id, content_hash, error``; a null error means that the file is
    done. A run that is repeated under its name replaces its own log entries only.
    """
    spark = ledger.sparkSession
    earlier = state_log(spark, states_path).where(F.col("run") != run)
    todo = materialised(file_states(ledger, earlier).where(F.col("state").isin(*take)).select("file_id", "content_hash"))

    def log(rows: DataFrame, step: int) -> None:
        stamped = rows.withColumn("at", F.lit(dt.datetime.now(dt.UTC).replace(tzinfo=None)).cast("timestamp")).withColumns({"run": F.lit(run), "step": F.lit(step)})
        write_touched_partitions(stamped.select(*[c.split()[0] for c in STATE_SCHEMA.split(", ")]), states_path, ["run", "step"])

    log(todo.select("file_id", "content_hash", F.lit(PROCESSING).alias("state"), F.lit(None).cast("string").alias("error")), 1)
    ended = work(todo).select("file_id", "content_hash", F.when(F.col("error").isNull(), COMPLETED).otherwise(FAILED).alias("state"), "error")
    log(ended, 2)
