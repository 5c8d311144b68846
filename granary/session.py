"""Session helpers: table access, the shared folder, cutting of lineage."""

from __future__ import annotations

import atexit
import io
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers, once for each application, through the shared folder."""
    sc = spark.sparkContext
    if _OWN.get("shipped") == sc.applicationId:
        return
    _OWN["shipped"] = sc.applicationId
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(Path(root.name) / f.relative_to(root)))
    at = f"{work_dir(spark)}/{root.name}-{uuid.uuid4().hex}.zip"
    path = sc._jvm.org.apache.hadoop.fs.Path(at)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(data.getvalue())
    out.close()
    sc.addPyFile(at)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder. Only the parquet footer is read here."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session.

    Where it is unset (tests, a single machine) a folder of this process is made and removed at its end.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return at.rstrip("/")
    if "dir" not in _OWN:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _OWN["dir"] = tempfile.mkdtemp(prefix="granary-")
        atexit.register(shutil.rmtree, _OWN["dir"], ignore_errors=True)
    return f"file://{_OWN['dir']}"


def work_dir(spark: SparkSession) -> str:
    """A folder of this application in the shared one, for its intermediate tables; removed when the application ends."""
    sc = spark.sparkContext
    at = f"{shared_dir(spark)}/granary-{sc.applicationId}"
    if _OWN.get("work") != at:
        path = sc._jvm.org.apache.hadoop.fs.Path(at)
        files = path.getFileSystem(sc._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _OWN["work"] = at
    return at


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores before work in Python, where a small input came in fewer partitions; large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
