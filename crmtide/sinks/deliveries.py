"""Numbered deliveries to folders of files, each added once however often it comes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


class Folder:
    """File operations below ``path``, wherever Spark's file systems reach."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self.jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.fs = self.jvm.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.Path(f"{self.path}/{name}")

    def _names(self, name: str) -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def _touch(self, name: str) -> None:
        self.fs.create(self._at(name), True).close()

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._at(name))

    def reached(self, done: str) -> int:
        """The greatest number noted below a folder; -1 if there is none."""
        return max((int(n) for n in self._names(done)), default=-1)

    def note(self, done: str, number: int) -> None:
        """Note a number and forget smaller ones."""
        self._touch(f"{done}/{number}")
        for n in self._names(done):
            if int(n) < number:
                self.fs.delete(self._at(f"{done}/{n}"), False)


class Deliveries(Folder):
    """Appends of a source's numbered batches to the folder at ``path`` and folders below it.

    A batch is written beside the table first. Once Spark has committed all of
    it, its files are moved in one by one; a move either happened or did not, so a
    batch that a crash cut off is ended, not written again, and readers and
    streams over the folder meet every file once. One writer at a time.
    """

    def resume(self, source: str, number: int) -> bool:
        """Whether this batch is in the table, after ending it if all of it had been written."""
        if self.reached(f"_deliveries/{source}/done") >= number:
            return True
        pending = f"_deliveries/{source}/{number}"
        if self.exists(f"{pending}/_written"):
            self._end(source, number)
            return True
        self.fs.delete(self._at(pending), True)
        return False

    def write(self, source: str, number: int, frames: Mapping[str, DataFrame]) -> None:
        """Add the batch: for each folder below the table ("" is the table itself) its rows, as Parquet."""
        pending = f"_deliveries/{source}/{number}"
        for k, (folder, df) in enumerate(frames.items()):
            df.write.mode("overwrite").parquet(f"{self.path}/{pending}/{k}")
            self._touch(f"{pending}/{k}/_to={folder}")
        self._touch(f"{pending}/_written")
        self._end(source, number)

    def _end(self, source: str, number: int) -> None:
        pending = f"_deliveries/{source}/{number}"
        for part in self._names(pending):
            if part.startswith("_"):
                continue
            names = self._names(f"{pending}/{part}")
            folder = next(n for n in names if n.startswith("_to=")).removeprefix("_to=")
            target = f"{folder}/" if folder else ""
            self.fs.mkdirs(self._at(target) if target else self.jvm.Path(self.path))
            for name in names:
                if not name.startswith(("_", ".")):
                    to = f"{target}{source[:8]}-{number:09d}-{part}-{name}"
                    if not self.fs.rename(self._at(f"{pending}/{part}/{name}"), self._at(to)):
                        raise OSError(f"cannot move {name} to {to}")
        self.note(f"_deliveries/{source}/done", number)
        self.fs.delete(self._at(pending), True)
