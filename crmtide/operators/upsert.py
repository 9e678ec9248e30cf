"""Keyed upsert into a partitioned Parquet table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crmtide.sinks.files import clustered

# Partition values up to this many prune the target one by one; beyond it their range does, and a semi join the rest.
MAX_LITERAL_PARTITIONS = 2_000


def _equal(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(a) == F.col(b) for a, b in zip(left, right)])


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], guard: str | None = None) -> DataFrame:
    """Target after ``source`` (one row per key): replace matches, add the rest.

    A NULL in a key matches nothing, so such rows are always added. With
    ``guard`` a target row whose guard column is greater than the incoming one
    stays; without it the incoming row always wins.
    """
    names = [f"_src_{k}" for k in keys]
    renamed = [F.col(k).alias(n) for k, n in zip(keys, names)]
    if guard is None:
        kept = target.join(source.select(*renamed), _equal(keys, names), "left_anti")
        return kept.unionByName(source)
    newer_target = F.coalesce(F.col(guard) > F.col("_guard"), F.lit(False))
    incoming = source.select(*renamed, F.col(guard).alias("_guard"), F.lit(True).alias("_hit"))
    kept = target.join(incoming, _equal(keys, names), "left").filter(F.col("_hit").isNull() | newer_target)
    existing = target.select(*renamed, F.col(guard).alias("_guard"))
    beaten = F.coalesce(F.col("_guard") > F.col(guard), F.lit(False))
    applied = source.join(existing, _equal(keys, names) & beaten, "left_anti")
    return kept.select(*target.columns).unionByName(applied)


def create_curated(path: str, like: DataFrame, layout: Sequence[str]) -> None:
    """Create the empty partitioned table at ``path`` unless it is there already."""
    empty = like.sparkSession.createDataFrame([], like.schema)
    empty.write.mode("ignore").partitionBy(*layout).parquet(path)


def read_curated(path: str, like: DataFrame) -> DataFrame:
    """The table with its declared types, partition column included."""
    return like.sparkSession.read.schema(like.schema).parquet(path).select(*like.columns)


def touched_partitions(target: DataFrame, source: DataFrame, layout: str | Sequence[str]) -> DataFrame:
    """Target rows of the partitions, and of their parts, that occur in ``source``."""
    layout = [layout] if isinstance(layout, str) else list(layout)
    first = layout[0]
    values = source.select(*layout).distinct()
    found = values.limit(MAX_LITERAL_PARTITIONS + 1).collect()
    if len(found) <= MAX_LITERAL_PARTITIONS and len(layout) == 1:
        found = [r[0] for r in found]
        hit = F.col(first).isin([v for v in found if v is not None])
        return target.filter(hit | F.col(first).isNull() if None in found else hit)
    if len(found) <= MAX_LITERAL_PARTITIONS:
        return target.filter(_folder(layout).isin([r[0] for r in values.select(_folder(layout)).collect()]))
    low, high = values.agg(F.min(first), F.max(first)).first()
    target = target.filter(F.col(first).between(low, high) | F.col(first).isNull())
    named = values.withColumnsRenamed({c: f"_touched_{c}" for c in layout})
    same = [F.col(c).eqNullSafe(F.col(f"_touched_{c}")) for c in layout]
    return target.join(named, reduce(Column.__and__, same), "left_semi")


def _folder(layout: Sequence[str]) -> Column:
    """A partition's values as one text; it reads partition columns only, so it prunes folders."""
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in layout])


class _Journal:
    """Merged partitions of upserts on their way into the table, below the table's own folder.

    Readers skip its name. A merge counts once Spark has committed it; then it is
    swapped in, and what is left of it again after a crash.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.root = f"{path.rstrip('/')}/_upserts"
        self.jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, below: str) -> list[str]:
        folder = self._path(below)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(folder)) if self.fs.exists(folder) else []

    def pending(self) -> list[str]:
        """Merges that were committed and not ended; what was not committed is removed."""
        found = []
        for name in self.names("merged"):
            if self.fs.exists(self._path(f"merged/{name}/_SUCCESS")):
                found.append(name)
            else:
                self.fs.delete(self._path(f"merged/{name}"), True)
        return found

    def leaves(self, below: str) -> list[str]:
        """Partition folders below a folder that hold files; one whose parts were all moved holds none."""
        found = []
        for name in self.names(below):
            if "=" in name:
                inside = self.names(f"{below}/{name}")
                parts = any("=" in n for n in inside)
                found += [f"{name}/{leaf}" for leaf in self.leaves(f"{below}/{name}")] if parts else [name] if inside else []
        return found

    def move(self, source: str, target: str) -> None:
        """Let a folder below the journal replace the one at ``target``."""
        at = self.jvm.Path(target)
        self.fs.delete(at, True)
        self.fs.mkdirs(at.getParent())
        if not self.fs.rename(self._path(source), at):
            raise OSError(f"cannot move {source} to {target}")

    def applied(self, source: str, batch: int) -> bool:
        return any(int(n) >= batch for n in self.names(f"applied/{source}"))

    def end(self, name: str) -> None:
        """Note the batch, forget its source's older ones, and drop the merged rows."""
        source, _, batch = name.rpartition(".")
        if source:
            self.fs.create(self._path(f"applied/{source}/{batch}"), True).close()
            for n in self.names(f"applied/{source}"):
                if int(n) < int(batch):
                    self.fs.delete(self._path(f"applied/{source}/{n}"), False)
        self.fs.delete(self._path(f"merged/{name}"), True)


def _swap_in(path: str, journal: _Journal, name: str) -> None:
    """Put the merged partitions of one upsert in the place of the table's own.

    Their folders are moved, the rows are not read again. A folder that was moved
    before a crash is no longer there, so moving the rest ends the swap.
    """
    for leaf in journal.leaves(f"merged/{name}"):
        journal.move(f"merged/{name}/{leaf}", f"{path.rstrip('/')}/{leaf}")


BUCKET = "_bucket"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Adds the part of its partition that a row's key decides."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def upsert(
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_col: str,
    guard: str | None = None,
    batch: tuple[str, int] | None = None,
    buckets: int | None = None,
) -> None:
    """Merge ``source`` (one row per key) into the table at ``path``.

    ``partition_col`` is one of the keys, so a row can only replace one in its
    own partition: just the partitions in ``source`` are read and merged. The
    merged partitions are written beside the table first, and then their folders
    take the place of the table's own, so a run that dies in between loses
    nothing: the next one ends the swap before it does anything else. ``batch``
    names a source and a number rising with its deliveries; a delivery that comes
    again is left out, rows with NULL keys included. One writer at a time.

    ``buckets`` splits every partition into so many parts by a hash of the key,
    kept in folders of a column ``_bucket``; a changed row then rewrites its part
    only. It must stay the same over a table's life. Choose it so that a part of
    the largest partition is one or a few files.
    """
    if partition_col not in keys:
        raise ValueError("partition_col must be one of the keys")
    spark = source.sparkSession
    layout = [partition_col]
    if buckets:
        layout.append(BUCKET)
        source = with_bucket(source, keys, buckets)
    create_curated(path, source, layout)
    journal = _Journal(spark, path)
    for name in journal.pending():
        _swap_in(path, journal, name)
        journal.end(name)
    if batch and journal.applied(*batch):
        return
    name = f"{batch[0]}.{batch[1]}" if batch else uuid.uuid4().hex
    target = touched_partitions(read_curated(path, source), source, layout)
    merged = merge_rows(target, source, keys, guard)
    clustered(merged, layout).write.partitionBy(*layout).parquet(f"{journal.root}/merged/{name}")
    _swap_in(path, journal, name)
    journal.end(name)
