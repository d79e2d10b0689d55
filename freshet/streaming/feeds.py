"""Structured Streaming versions of the polled feeds, from file sources.

Every sink is idempotent per batch id: a batch replayed after a failure overwrites what it wrote and nothing else.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from freshet.operators.pick import first_per_key
from freshet.operators.store import BatchTable, VersionedTable
from freshet.plans.warnings import append_unseen, detect_changes, with_log_id
from freshet.streaming.episodes import episodes_of_area


def read_files(spark: SparkSession, path: str, schema, name_filter: str = "*.parquet", per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name_filter)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path)


def run_available(query_of: Callable[[], StreamingQuery]) -> None:
    """Run a query over what has landed and stop."""
    query = query_of()
    query.awaitTermination()


def deduplicated(stream: DataFrame, keys: list[str], time: str, lateness: str) -> DataFrame:
    """Unseen (key, time) rows.  State is dropped ``lateness`` behind the newest reading; a row later than that is not passed on and
    has to come with the archive, so there is no default."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([*keys, time])


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (stream.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_per_key(stream: DataFrame, keys: list[str], time: str, values: list[str]) -> DataFrame:
    """Newest row per key as an update-mode aggregate; the state is one row per key."""
    newest = F.max_by(F.struct(time, *values), F.struct(time, *values))
    return stream.groupBy(*keys).agg(newest.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in [time, *values]])


def serve_latest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the keys that each batch changed; the state store holds the newest row per key, :func:`latest_view` reads it back.

    A batch overwrites its own folder only, so it can be replayed, and writes what it changed whatever the size of the table.
    """
    return _each_batch(stream, lambda batch, batch_id: _write_folder(batch, path, batch_id), checkpoint, mode="update")


def latest_view(spark: SparkSession, path: str, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key of the changes that batches wrote."""
    return first_per_key(spark.read.parquet(path), keys, [F.col(c) for c in [*order, "batch"]], highest=True).drop("batch")


def compact(spark: SparkSession, path: str, keys: list[str], order: list[str], into: str) -> None:
    """The newest rows alone, in a folder of their own; run it apart from the stream when changes far outnumber keys."""
    latest_view(spark, path, keys, order).withColumn("batch", F.lit(-1)).write.partitionBy("batch").parquet(into)


def live_tail(stream: DataFrame, path: str, late_path: str, keys: list[str], time: str, days: int, checkpoint: str) -> StreamingQuery:
    """Unseen readings of the last ``days`` days, in folders by day and batch.

    A batch reads the days that it touches and adds its unseen rows to them, so neither reading nor writing grows with the table.  Rows older
    than ``days`` behind the newest reading go to ``late_path``, from where they can join the archive.  The newest reading is
    the later of the batch's and the last day's.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("day", F.to_date(time)).dropDuplicates([*keys, time])
        seen = _folders(spark, path, rows.schema, batch_id)
        last = seen.filter(F.col("day") >= (seen.agg(F.max("day")).first()[0] or F.lit(None))).agg(F.max(time)).first()[0]
        newest = max((t for t in (last, batch.agg(F.max(time)).first()[0]) if t is not None), default=None)
        if newest is None:
            return
        recent = F.col(time) >= F.lit(newest) - F.expr(f"INTERVAL {days} DAYS")
        days_here = [r["day"] for r in rows.filter(recent).select("day").distinct().collect()]        # at most days + 1
        known = seen.filter(F.col("day").isin(days_here)).select(*keys, time)
        fresh = rows.filter(recent).join(known, [*keys, time], "left_anti")
        _write_folder(fresh.select(*rows.columns), path, batch_id, ["day"])
        _write_folder(rows.filter(~recent | F.col(time).isNull()).drop("day"), late_path, batch_id)

    return _each_batch(stream, merge, checkpoint)


def tail_view(spark: SparkSession, path: str, time: str, days: int) -> DataFrame:
    """The readings of the last ``days`` days behind the newest; older day folders are not read."""
    rows = spark.read.parquet(path)
    last_day = rows.agg(F.max("day")).first()[0]
    if last_day is None:
        return rows.drop("day", "batch")
    near = rows.filter(F.col("day") >= F.date_sub(F.lit(last_day), days + 1))
    newest = near.filter(F.col("day") == last_day).agg(F.max(time)).first()[0]
    return near.filter(F.col(time) >= F.lit(newest) - F.expr(f"INTERVAL {days} DAYS")).drop("day", "batch")


def _write_folder(rows: DataFrame, path: str, batch_id: int, by: list[str] | None = None) -> None:
    """Overwrite the folders of this batch only."""
    placed = rows.withColumn("batch", F.lit(batch_id))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*(by or []), "batch").parquet(path)


def _folders(spark: SparkSession, path: str, schema, before: int) -> DataFrame:
    """Rows of earlier batches; none where nothing has been written."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    if not root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])).parquet(path).filter(F.col("batch") < before).drop("batch")


def watch_changes(stream: DataFrame, state: VersionedTable, log: BatchTable, key: str, level: str, message: str, id_parts: list[str],
                  polled_at: Column, checkpoint: str) -> StreamingQuery:
    """One snapshot per trigger compared with the state: the log gets unseen events, then the snapshot becomes the state.

    CLOSED needs the whole snapshot to know what is absent, so this is a full outer join per batch, not a per-key state.  The
    log is appended first: a batch that dies in between is detected again with the same ids and rewrites its own part only.
    """
    def compare(batch: DataFrame, batch_id: int) -> None:
        held = state.read() if state.exists() else batch.limit(0)
        events = with_log_id(detect_changes(batch, held, key, level, message, polled_at), id_parts)
        logged = log.read(before=batch_id)
        log.append(events.dropDuplicates(["log_id"]) if logged is None else append_unseen(logged, events), batch_id)
        state.write(batch, version=batch_id)

    return _each_batch(stream, compare, checkpoint)


EPISODE = ("area_code string, run long, start_time timestamp, end_time timestamp, start_level string, peak_level string, n_messages long, "
           "ended_by string, stale_open boolean")


def track_episodes(events: DataFrame, lateness: str, stale_days: int, path: str, checkpoint: str) -> StreamingQuery:
    """Episodes per area as keyed state: each batch appends the episodes that it changed (see :func:`episode_view`).

    The state of an area is the number of its run, its open run as summed up so far, and the messages that are not yet older than
    ``lateness``; these can still come in any order.  Messages behind the watermark are summed up and forgotten; Spark drops what
    arrives later than that, which has to come with the archive.  A timer marks a run that stays open for ``stale_days``.
    """
    rows = events.select("area_code", F.col("time").cast("timestamp").alias("time"), "level", "kind").withWatermark("time", lateness)
    changed = rows.groupBy("area_code").applyInPandasWithState(
        episodes_of_area(stale_days), EPISODE, "memory string", "append", GroupStateTimeout.EventTimeTimeout)
    return _each_batch(changed, lambda batch, batch_id: _write_folder(batch, path, batch_id), checkpoint)


def episode_view(spark: SparkSession, path: str) -> DataFrame:
    """The last state of each episode; runs that turned out to hold switch-offs only are left out."""
    return first_per_key(spark.read.parquet(path), ["area_code", "run"], [F.col("batch")], highest=True).filter("n_messages > 0").drop("batch")


def commit_in_order(stream: DataFrame, split: Callable[[DataFrame], list[tuple[BatchTable, DataFrame]]], log: BatchTable,
                    log_row: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Children first, the log row last, all under the batch id: a replayed batch changes nothing."""
    def commit(batch: DataFrame, batch_id: int) -> None:
        for table, rows in split(batch):
            table.append(rows, batch_id)
        log.append(log_row(batch), batch_id)

    return _each_batch(stream, commit, checkpoint)


def _each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (stream.writeStream.foreachBatch(work).outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
