"""Session settings and the shared folder every cluster job writes scratch data to."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "clearspan", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="clearspan-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the library to the workers of a session, once, so that they can import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, f"{package.name}/{file.relative_to(package)}")
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}/{package.name}.zip"
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
        stream.write(bytearray(held.getvalue()))
        stream.close()
    else:
        # Without a shared folder the driver keeps the file and serves it.
        path = str(Path(tempfile.mkdtemp(prefix="clearspan-")) / f"{package.name}.zip")
        Path(path).write_bytes(held.getvalue())
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
