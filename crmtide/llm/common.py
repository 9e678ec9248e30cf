"""Helpers that several operators share: tables, saved steps, positions in a huge order."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crmtide.session import shared_dir

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once into the cluster's shared folder and read from there.

    Later steps neither compute it again nor depend on an executor that holds it.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete the files of a frame made by ``saved`` that no later step reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def forget(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of steps whose results are saved and whose frames are gone.

    It deletes what the driver's collectors find unused, which without a hint
    may be long after. Each of Spark's listener queues holds on to its last
    event, which is the end of the step with all its plan, until another comes;
    so that the files don't stay through the next step, a query without a job
    makes one and is waited for.
    """
    gc.collect()
    spark.sql("SELECT 1").collect()
    with contextlib.suppress(Py4JError):  # not a public call; without it the hint may come too early
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shuffle_key(seed: str, *columns: str) -> Column:
    """Hex digest that puts rows into an order that is random but the same in each run."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]))


def hex_bucket(key: str, buckets: int) -> Column:
    """Bucket 0 to ``buckets`` - 1, rising with a hex digest."""
    leading = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.floor(leading * F.lit(buckets) / F.lit(2.0**32)).cast("int")


def positions(
    df: DataFrame,
    group: str,
    bucket: str,
    order: Sequence[str],
    weight: str | None = None,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Adds each row's place in the order of its group, however large the group.

    ``_rank`` (from 1), ``_n`` (rows of the group), ``_run`` (weights up to and
    with the row) and ``_sum`` (weights of the group). ``bucket`` must rise with
    ``order``: a window then sees one bucket of one group only, and the buckets
    before it count by their sums, which are combined before they are shuffled.
    ``group`` and ``bucket`` hold no NULL. ``facts`` has more columns by group,
    which are added on the way without another shuffle of the rows.
    """
    w = F.lit(1) if weight is None else F.col(weight)
    sums = df.groupBy(group, bucket).agg(F.count(F.lit(1)).alias("_bn"), F.sum(w).alias("_bw"))
    before, whole = Window.partitionBy(group).orderBy(bucket), Window.partitionBy(group)
    sums = sums.select(
        group,
        bucket,
        (F.sum("_bn").over(before) - F.col("_bn")).alias("_n0"),
        (F.sum("_bw").over(before) - F.col("_bw")).alias("_w0"),
        F.sum("_bn").over(whole).alias("_n"),
        F.sum("_bw").over(whole).alias("_sum"),
    )
    if facts is not None:
        sums = sums.join(facts, group)
    local = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumns({"_rn": F.row_number().over(local), "_rw": F.sum(w).over(local)})
        .join(sums, [group, bucket])
        .withColumns({"_rank": F.col("_n0") + F.col("_rn"), "_run": F.col("_w0") + F.col("_rw")})
        .drop("_rn", "_rw", "_n0", "_w0")
    )


def lean(work: Callable) -> Callable:
    """``work`` on batches, after which the worker gives back the memory it no longer uses.

    A worker process is kept for later tasks; without this, every one of them
    would hold on to the largest batch it ever saw.
    """

    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # another C library: it keeps what it keeps

    return run


def hash_sample(df: DataFrame, columns: Sequence[str], rows: int) -> DataFrame:
    """The ``rows`` rows that come first in the order of a hash of ``columns``.

    About twice as many are picked by the hash before any is sorted, so what
    reaches the last task depends on ``rows``, not on the size of ``df``.
    """
    total, steps = df.count(), 1 << 30
    key = F.pmod(F.xxhash64(*columns), F.lit(steps))
    if total > 2 * rows:
        df = df.filter(key < int(steps * 2 * rows / total))
    return df.orderBy(key, *columns).limit(rows)


def by_size(texts: Sequence[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``most`` bytes each; a longer text stands alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def chunks(lengths: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with these lengths, of about ``most`` in all each; a longer row stands alone."""
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += int(n)
    if start < len(lengths):
        yield start, len(lengths)
