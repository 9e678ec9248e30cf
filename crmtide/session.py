"""Session settings and the shared scratch folder."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_PACKAGE = Path(__file__).resolve().parent


def build_session(app_name: str = "crmtide", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs are written for; extra ``conf`` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # Hash instead of sort-merge where every shuffled partition is seen to be small.
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        "spark.sql.parquet.compression.codec": "snappy",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application.

    Functions that run in tasks are sent by name, so the workers must be able to
    import it. A package that is installed is taken to be so everywhere.
    """
    context = spark.sparkContext
    if "site-packages" in _PACKAGE.parts or getattr(context, "_ships_crmtide", False):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(_PACKAGE.rglob("*.py")):
            archive.write(file, file.relative_to(_PACKAGE.parent))
    folder = shared_dir(spark, "package")
    at = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/crmtide.zip")
    out = at.getFileSystem(context._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(at.toString())
    context._ships_crmtide = True


def ensure_utc(spark: SparkSession) -> None:
    """Event-hour partitions and zone-less instants are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a
    local-mode session without that setting falls back to a temporary folder of
    this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="crmtide-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
