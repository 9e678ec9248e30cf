"""Parquet stages: file selection, lineage and tolerant typed loads."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import quote, unquote, urlparse

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from crmtide import schemas as S
from crmtide.functions.casts import cast_failed, project

PARQUET_FILES = "*.parquet"
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def path_columns(file: str, stage_path: str) -> list[str]:
    """Names of the ``name=value`` folders between the stage and a file."""
    inside = unquote(urlparse(file).path).removeprefix(urlparse(stage_path).path.rstrip("/"))
    return [part.split("=", 1)[0] for part in inside.split("/")[:-1] if "=" in part]


def _with_text(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    """``schema`` with path columns declared as text: "007" stays "007"."""
    own = [f for f in schema if f.name not in names]
    return T.StructType(own + [T.StructField(n, T.StringType()) for n in names])


def read_stage(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    pattern: str = PARQUET_FILES,
    path_regex: str | None = None,
    leaf_columns_only: bool = False,
    ignore_corrupt_files: bool = False,
) -> DataFrame:
    """Parquet files of one physical schema below ``path``, path partitions as text columns.

    ``pattern`` is a glob on the file name, ``path_regex`` a regular expression
    on the whole file path. ``leaf_columns_only`` ignores the directory names:
    needed where a directory repeats a data column with another meaning. Skipping
    corrupt files needs a declared ``schema``, since inference reads a footer.
    Files that differ in columns or types are for ``load_landing``.
    """
    if ignore_corrupt_files and schema is None:
        raise ValueError("ignore_corrupt_files needs a declared schema")
    reader = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", leaf_columns_only)
        .option("ignoreCorruptFiles", ignore_corrupt_files)
    )
    if schema is None:
        found = reader.parquet(path)
        files = [] if leaf_columns_only else found.inputFiles()[:1]
        schema = _with_text(found.schema, path_columns(files[0], path) if files else [])
    df = reader.schema(schema).parquet(path)
    return df if path_regex is None else df.filter(F.col("_metadata.file_path").rlike(path_regex))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for file in batch.column(0).to_pylist():
            try:
                fs, at = FileSystem.from_uri(re.sub("^file:/+", "file:///", quote(file, safe=":/")))
                with fs.open_input_file(at) as opened:
                    arrow = pq.ParquetFile(opened).schema_arrow
                stored = (arrow.metadata or {}).get(_SPARK_SCHEMA)
                schema = T.StructType.fromJson(json.loads(stored)) if stored else from_arrow_schema(arrow)
                plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
                rows.append((file, plain.json(), None))
            except (pa.ArrowInvalid, OSError) as problem:
                rows.append((file, None, str(problem)[:200]))
        columns = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["file", "schema", "problem"])


def file_schemas(spark: SparkSession, path: str, pattern: str = PARQUET_FILES) -> DataFrame:
    """(file, schema, problem) of every file below ``path``; footers are read by the executors.

    ``schema`` is the file's own, as JSON; it is NULL, and ``problem`` says why,
    for what is no Parquet file.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path")
    )
    return with_schemas(files)


def with_schemas(files: DataFrame) -> DataFrame:
    """(file, schema, problem) of files named in the one column."""
    return files.mapInArrow(_footers, "file string, schema string, problem string")


def stage_relative(file_path: Column, stage_path: str) -> Column:
    """File URI without the stage prefix; a URI outside the stage is kept whole."""
    location = urlparse(stage_path)
    prefix = (location.netloc + location.path).rstrip("/")
    inside = F.regexp_extract(file_path, f"{re.escape(prefix)}/+(.*)$", 1)
    return F.when(inside != "", inside).otherwise(file_path)


def with_lineage(df: DataFrame, stage_path: str) -> DataFrame:
    """Add the source file and the load stamp to a frame read from files."""
    return df.withColumns(
        {
            "src_filename": stage_relative(F.col("_metadata.file_path"), stage_path),
            "loaded_at": F.current_timestamp().cast("timestamp_ntz"),
        }
    )


def type_landing(df: DataFrame, name: str, on_error: str = "continue") -> DataFrame:
    """Typed landing rows from a staged frame that carries lineage.

    ``continue`` skips rows holding a value that does not fit its declared type
    and loads the rest; ``fail`` stops the job at the first one.
    """
    payload = S.LANDING_SCHEMAS[name]
    failed = cast_failed(df, payload)
    if on_error == "continue":
        df = df.filter(~failed)
    elif on_error == "fail":
        df = df.filter(F.assert_true(~failed, F.lit(f"{name}: value does not fit its declared type")).isNull())
    else:
        raise ValueError(f"unknown on_error {on_error!r}")
    return project(df, S.landing_table_schema(name))


def rejected_rows(df: DataFrame, name: str) -> DataFrame:
    """The rows a tolerant load skips, as staged."""
    return df.filter(cast_failed(df, S.LANDING_SCHEMAS[name]))


def folder_columns(file: Column, stage_path: str) -> Column:
    """Names of the ``name=value`` folders between the stage and a listed file, found where the row is."""
    folders = F.split(F.regexp_replace(stage_relative(file, stage_path), "[^/]*$", ""), "/")
    return F.transform(F.filter(folders, lambda x: x.contains("=")), lambda x: F.substring_index(x, "=", 1))


def schema_groups(files: DataFrame, stage_path: str, leaf_columns_only: bool = False) -> DataFrame:
    """``files`` (file, schema, problem) with the path columns and a number for every pair of schema and path columns."""
    names = F.array().cast("array<string>") if leaf_columns_only else folder_columns(F.col("file"), stage_path)
    return files.withColumn("names", names).withColumn("kind", F.xxhash64("schema", "names"))


def read_files(
    spark: SparkSession, schema: str, names: Sequence[str], files: Sequence[str], path: str, leaf_columns_only: bool
) -> DataFrame:
    """Files of one schema, given as JSON, with their path columns as text."""
    typed = _with_text(T.StructType.fromJson(json.loads(schema)), names)
    reader = spark.read.schema(typed).option("recursiveFileLookup", leaf_columns_only)
    if not leaf_columns_only:
        reader = reader.option("basePath", path)
    return reader.parquet(*sorted(files))


def frames_by_schema(spark: SparkSession, groups: DataFrame, path: str, on_error: str, leaf_columns_only: bool = False) -> list[DataFrame]:
    """A frame for each kind of file in ``schema_groups``; the files' own schemas are compared in tasks.

    To the driver come one schema for each kind and, as for any scan, the names of the files.
    """
    if on_error != "continue":
        bad = groups.filter("schema is null").select("file", "problem").first()
        if bad:
            raise ValueError(f"{bad['file']} cannot be read: {bad['problem']}")
    good = groups.filter("schema is not null")
    kinds = good.groupBy("kind").agg(F.min(F.struct("schema", "names")).alias("of")).orderBy("of").collect()
    files: dict[int, list[str]] = defaultdict(list)
    for row in good.select("kind", "file").collect() if kinds else []:
        files[row["kind"]].append(row["file"])
    return [read_files(spark, k["of"]["schema"], k["of"]["names"], files[k["kind"]], path, leaf_columns_only) for k in kinds]


def read_groups(
    spark: SparkSession, path: str, on_error: str, pattern: str = PARQUET_FILES, leaf_columns_only: bool = False
) -> list[DataFrame]:
    """A frame for each physical schema among the files below ``path``, as few as there are schemas.

    Under ``continue`` files that can't be read are left out (``file_schemas``
    lists them), otherwise the first one stops the load.
    """
    groups = schema_groups(file_schemas(spark, path, pattern), path, leaf_columns_only).persist()
    try:
        return frames_by_schema(spark, groups, path, on_error, leaf_columns_only)
    finally:
        groups.unpersist()


def load_landing(
    spark: SparkSession,
    name: str,
    stage_path: str,
    on_error: str = "continue",
    pattern: str = PARQUET_FILES,
    leaf_columns_only: bool = False,
) -> DataFrame:
    """Typed tolerant load of one stage prefix: payload, source file, load stamp.

    Files may differ: each group of files with the same columns and types is read
    as it is and cast to the declared types, a column a file lacks is NULL.
    """
    return landing_rows(spark, name, stage_path, read_groups(spark, stage_path, on_error, pattern, leaf_columns_only), on_error)


def landing_rows(spark: SparkSession, name: str, stage_path: str, frames: Sequence[DataFrame], on_error: str = "continue") -> DataFrame:
    """Typed landing rows of frames read from a stage, whatever their own types."""
    parts = [type_landing(with_lineage(df, stage_path), name, on_error) for df in frames]
    if not parts:
        return spark.createDataFrame([], S.landing_table_schema(name))
    return reduce(DataFrame.unionByName, parts)


def stage_schema(spark: SparkSession, name: str, stage_path: str, leaf_columns_only: bool) -> T.StructType:
    """One schema for a stream over a stage: the columns of the files that are there, path columns as text.

    Without files it is the declared one. A column whose type differs between
    files has no schema that a stream could read: load such a stage in batches.
    """
    found: dict[str, T.DataType] = {}
    names: list[str] = []
    groups = schema_groups(file_schemas(spark, stage_path).filter("schema is not null"), stage_path, leaf_columns_only)
    for row in groups.select("schema", "names").distinct().collect():
        for f in T.StructType.fromJson(json.loads(row["schema"])):
            if found.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"{stage_path}: {f.name} is {found[f.name]} and {f.dataType}; use drifting ingest or load_landing")
        names = row["names"] or names
    schema = T.StructType([T.StructField(n, t) for n, t in found.items()])
    return _with_text(schema, names) if found else S.LANDING_SCHEMAS[name]
