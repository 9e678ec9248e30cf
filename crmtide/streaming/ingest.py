"""Continuous file ingest and the curated upsert behind it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crmtide import schemas as S
from crmtide.functions.columns import required_invalid, with_stamp, with_time_parts
from crmtide.operators.latest import LOAD_ORDER, latest_per_key
from crmtide.operators.upsert import upsert
from crmtide.operators.validate import with_reason
from crmtide.sinks.deliveries import Deliveries
from crmtide.sources.bronze import text_schema, typed_bronze
from crmtide.sources.stage import (
    PARQUET_FILES,
    frames_by_schema,
    landing_rows,
    schema_groups,
    stage_schema,
    type_landing,
    with_lineage,
    with_schemas,
)

EVERY_MINUTE = {"processingTime": "1 minute"}
ALL_AVAILABLE = {"availableNow": True}


# A file counts as new whatever its date: backfills and copies keep old ones.
ANY_AGE = {"maxFileAge": "36500d"}
# Below a raw table, where readers of the table do not look: the files that were met.
FILES = "_files"
# Below a curated table, likewise: the best rows that the last micro-batch brought.
BEST = "_best"
# Exports: a folder names the export's scope, not the rows' tenant, so folder names are not columns.
EXPORTS = ("churn", "lead_score")


def run_to_end(query: StreamingQuery, seconds: int | None = None) -> StreamingQuery:
    """Wait for an ``ALL_AVAILABLE`` query; with a time limit, stop it there."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"streaming query not finished after {seconds} s")
    return query


def staged_files(
    spark: SparkSession,
    name: str,
    stage_path: str,
    file_schema: T.StructType | None,
    max_files_per_trigger: int,
    archive: str | None = None,
) -> DataFrame:
    """New Parquet files of a stage as typed landing rows; each file is read once.

    ``archive`` names a folder outside the stage to which files go once they are
    loaded, which keeps listing and the list of files seen short.
    """
    flat = name in EXPORTS
    schema = file_schema or stage_schema(spark, name, stage_path, leaf_columns_only=flat)
    cleaning = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    files = (
        spark.readStream.schema(schema)
        .options(**ANY_AGE, **cleaning)
        .option("pathGlobFilter", PARQUET_FILES)
        .option("recursiveFileLookup", flat)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(stage_path)
    )
    return type_landing(with_lineage(files, stage_path), name)


def auto_ingest(
    spark: SparkSession,
    name: str,
    stage_path: str,
    raw_path: str,
    checkpoint: str,
    file_schema: T.StructType | None = None,
    trigger: dict = EVERY_MINUTE,
    max_files_per_trigger: int = 10_000,
    archive: str | None = None,
) -> StreamingQuery:
    """Append every new stage file to the raw table, exactly once per file.

    ``file_schema`` defaults to that of the files in the stage at the start.

    The source's checkpoint remembers the files, the file sink's log makes a
    replayed micro-batch invisible. All files need the same types; a stage whose
    files differ is for ``drifting_ingest``.
    """
    rows = staged_files(spark, name, stage_path, file_schema, max_files_per_trigger, archive)
    return (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start(raw_path)
    )


_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def drifting_ingest(
    spark: SparkSession,
    name: str,
    stage_path: str,
    raw_path: str,
    checkpoint: str,
    trigger: dict = EVERY_MINUTE,
    max_files_per_trigger: int = 10_000,
    archive: str | None = None,
) -> StreamingQuery:
    """Append every new stage file to the raw table, exactly once per file, whatever its columns and types.

    The stream carries the names of new files. Each micro-batch reads their
    footers in tasks, groups them by schema and casts every group to the declared
    types; a value that does not fit skips its row, as in ``load_landing``. A
    micro-batch that comes again after a failure is recognised by its number
    (see ``Deliveries``). Files that are no Parquet are not loaded; ``loaded_files``
    lists them with all others.
    """
    flat = name in EXPORTS
    cleaning = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .options(**ANY_AGE, **cleaning)
        .option("pathGlobFilter", PARQUET_FILES)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(stage_path)
        .select("path")
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        deliveries = Deliveries(session, raw_path)
        if deliveries.resume(query, batch_id):
            return
        groups = schema_groups(with_schemas(batch), stage_path, flat).persist()
        try:
            listed = groups.select("file", "problem", F.lit(batch_id).cast("bigint").alias("batch_id"))
            frames = frames_by_schema(session, groups, stage_path, "continue", flat)
            rows = landing_rows(session, name, stage_path, frames)
            deliveries.write(query, batch_id, {"": rows, FILES: listed})
        finally:
            groups.unpersist()

    return files.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(load).start()


def loaded_files(spark: SparkSession, raw_path: str) -> DataFrame:
    """(file, problem, batch_id) of the files that ``drifting_ingest`` met; a problem tells why one was not loaded."""
    schema = "file string, problem string, batch_id bigint"
    return spark.read.schema(schema).parquet(f"{raw_path.rstrip('/')}/{FILES}")


def load_incremental(
    spark: SparkSession, name: str, stage_path: str, raw_path: str, checkpoint: str, drifting: bool = False, **options
) -> None:
    """Batch form of the ingest: load the files not loaded before, then stop.

    ``drifting`` takes files that differ in columns or types.
    """
    ingest = drifting_ingest if drifting else auto_ingest
    run_to_end(ingest(spark, name, stage_path, raw_path, checkpoint, trigger=ALL_AVAILABLE, **options))


def change_feed(spark: SparkSession, raw_path: str, name: str, max_files_per_trigger: int = 10_000) -> DataFrame:
    """Rows appended to a raw table since the consumer's checkpoint."""
    return (
        spark.readStream.schema(S.landing_table_schema(name))
        .options(**ANY_AGE)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(raw_path)
    )


def upsert_batch(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_col: str,
    guard: str | None = None,
    delivery: tuple[str, int] | None = None,
) -> None:
    """Latest row per key of a micro-batch, merged into the curated table."""
    latest = latest_per_key(batch, keys).persist()
    try:
        upsert(path, latest, keys, partition_col, guard, delivery)
    finally:
        latest.unpersist()


def curate(
    feed: DataFrame,
    curated_path: str,
    checkpoint: str,
    keys: Sequence[str] = tuple(S.LEAD_SCORE_KEYS),
    partition_col: str = "feature_date",
    guard: str | None = None,
    trigger: dict = EVERY_MINUTE,
) -> StreamingQuery:
    """Keep the curated table current; runs only when the feed has new rows.

    A micro-batch that is delivered again after a failure is recognised by the
    query's id, which its checkpoint keeps, and its number.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        upsert_batch(batch, curated_path, keys, partition_col, guard, (query, batch_id) if query else None)

    return feed.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(apply).start()


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution on, as it was again afterwards.

    Spark turns it off in the session of a query with state, whose shuffles must
    keep their number. What is done with a micro-batch of its result is a batch job
    like any other; without it every task of a write has a file in every partition.
    """
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def curate_stateful(
    feed: DataFrame,
    curated_path: str,
    checkpoint: str,
    keys: Sequence[str] = tuple(S.LEAD_SCORE_KEYS),
    partition_col: str = "feature_date",
    order: Sequence[str] = LOAD_ORDER,
    trigger: dict = EVERY_MINUTE,
    buckets: int | None = None,
) -> StreamingQuery:
    """Keep the curated table current from the best row of every key, held as the query's state.

    The state, not the table, tells what is best: only keys that new rows came
    for reach the merge, each with its best row so far, so a late row that beats
    nothing brings the same row again. ``order`` is that of ``latest_per_key``; with ``exported_at`` first, the newest
    export wins whenever it comes. The state has one row per key, on the
    executors' disks and in the checkpoint; a restart goes on from there. A row
    with a NULL key is a key of its own.
    """
    order = [c for c in order if c in feed.columns]
    own = F.when(reduce(Column.__or__, [F.col(k).isNull() for k in keys]), F.xxhash64(*feed.columns))
    rank = [c for o in order for c in (F.col(o).isNull().alias(f"_n_{o}"), F.col(o).alias(f"_o_{o}"))]
    rank.append(F.xxhash64(*feed.columns).alias("_tie"))
    values = F.struct(*[c for c in feed.columns if c not in keys])
    best = feed.withColumn("_own", own).groupBy(*keys, "_own").agg(F.max_by(values, F.struct(*rank)).alias("_best"))
    columns = [F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in feed.columns]
    best_rows = f"{curated_path.rstrip('/')}/{BEST}"

    def apply(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        with adaptive(batch.sparkSession):
            # Written once: a merge that read the batch twice would go through the state twice.
            batch.select(*columns).write.mode("overwrite").parquet(best_rows)
            rows = batch.sparkSession.read.schema(feed.schema).parquet(best_rows)
            upsert(curated_path, rows, keys, partition_col, batch=(query, batch_id) if query else None, buckets=buckets)

    conf = feed.sparkSession.conf
    before = conf.get(_PROVIDER)
    conf.set(_PROVIDER, ROCKSDB)
    try:
        writer = best.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger).foreachBatch(apply).start()
    finally:
        conf.set(_PROVIDER, before)


def bronze_stream(
    spark: SparkSession,
    entity: str,
    input_path: str,
    silver_path: str,
    quarantine_path: str,
    checkpoint: str,
    trigger: dict = EVERY_MINUTE,
    max_files_per_trigger: int = 10_000,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Change records to silver and quarantine, each through an exactly-once file sink."""
    required = S.required_fields(S.ENTITY_SCHEMAS[entity])

    def start(keep_invalid: bool, path: str, leaf: str) -> StreamingQuery:
        lines = (
            spark.readStream.schema(text_schema(entity))
            .options(**ANY_AGE)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("recursiveFileLookup", True)
            .json(input_path)
        )
        rows = with_stamp(with_time_parts(typed_bronze(lines, entity), "cdc_timestamp"), "ingested_at")
        invalid = required_invalid(required)
        if keep_invalid:
            rows = with_reason(rows.filter(invalid), required)
        else:
            rows = rows.filter(~invalid)
        return (
            rows.writeStream.format("parquet")
            .partitionBy(*S.EVENT_HOUR)
            .option("checkpointLocation", f"{checkpoint}/{leaf}")
            .trigger(**trigger)
            .start(path)
        )

    return start(False, silver_path, "silver"), start(True, quarantine_path, "quarantine")
