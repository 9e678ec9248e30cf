"""Histories kept from numbered deliveries of change records, in whatever order they come."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crmtide.operators.history import change_history
from crmtide.operators.upsert import upsert
from crmtide.sinks.deliveries import Folder
from crmtide.sinks.files import clustered

PART = "_part"


class History:
    """A log of distinct change records and the versions that follow from it, below one folder.

    Both are split into ``parts`` by a hash of the key. A delivery adds its records
    to the log and derives the parts it touches anew, so a record that comes late
    takes its place between those that came before it. One writer at a time.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: Sequence[str],
        at: str = "cdc_timestamp",
        operation: str = "operationType",
        deletes: Sequence[str] = ("DELETE",),
        ignored: Sequence[str] = (),
        parts: int = 64,
    ) -> None:
        self.spark, self.root, self.folder, self.parts = spark, root.rstrip("/"), Folder(spark, root), parts
        self.schema, self.keys = schema, list(keys)
        self.how = {"keys": self.keys, "at": at, "operation": operation, "deletes": deletes, "ignored": ignored}

    def _log_schema(self) -> T.StructType:
        own = [T.StructField("_id", T.StringType()), T.StructField(PART, T.IntegerType())]
        return T.StructType([*[T.StructField(f.name, f.dataType) for f in self.schema], *own])

    def deliver(self, number: int, changes: DataFrame, source: str = "deliveries") -> None:
        """Take a delivery; one that comes again, whole or after a crash, changes nothing more."""
        if self.folder.reached(f"_done/{source}") >= number:
            return
        content = F.to_json(F.struct(*self.schema.names), {"ignoreNullFields": "false"})
        part = F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")
        rows = changes.select(*self.schema.names).withColumns({"_id": F.sha2(content, 256), PART: part}).dropDuplicates(["_id", PART])
        step = f"_steps/{source}.{number}"
        # Written once: the merge reads a delivery several times, and its rows may come out of a long job.
        rows.write.mode("overwrite").parquet(f"{self.root}/{step}")
        rows = self.spark.read.schema(self._log_schema()).parquet(f"{self.root}/{step}")
        upsert(f"{self.root}/log", rows, ["_id", PART], PART, batch=(source, number))
        touched = [r[PART] for r in rows.select(PART).distinct().collect()]
        if touched:
            self._derive(touched)
        self.folder.note(f"_done/{source}", number)
        self.folder.fs.delete(self.folder._at(step), True)

    def _derive(self, parts: Sequence[int]) -> None:
        log = self.spark.read.schema(self._log_schema()).parquet(f"{self.root}/log").filter(F.col(PART).isin(list(parts)))
        found = change_history(log.select(*self.schema.names), **self.how)
        found = found.withColumn(PART, F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int"))
        counted = Observation()
        found = found.observe(counted, *[F.count_if(F.col(PART) == p).alias(str(p)) for p in parts])
        out = clustered(found, [PART]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy(PART).parquet(f"{self.root}/versions")
        for p in (p for p, n in counted.get.items() if not n):
            self.folder.fs.delete(self.folder._at(f"versions/{PART}={p}"), True)

    def versions(self) -> DataFrame:
        empty = self.spark.createDataFrame([], self.schema)
        like = change_history(empty, **self.how).schema
        return self.spark.read.schema(like).parquet(f"{self.root}/versions").select(*like.names)
