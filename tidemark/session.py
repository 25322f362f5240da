"""Sessions, table access and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Settings for a session of our own; a session handed in from outside is left as it is.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_OWN_DIRS: dict[str, str] = {}
_WRITTEN: list[tuple[SparkSession, str]] = []


def get_spark(master: str = "local[*]", shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.master(master).appName("tidemark").config(map=DEFAULTS)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application: their Python need not have it installed.

    The archive is made beside the driver, and Spark's own file service hands it out.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.abspath(__file__))
    if sc.applicationId in _SHIPPED or not os.path.isdir(root):
        return
    _SHIPPED.add(sc.applicationId)
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-package-"), "tidemark_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def arrow(kind):
    """An Arrow function whose workers can import this package."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship(spark)
    return F.arrow_udf(kind)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session; one of our own only where that is unset."""
    ship(spark)
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: a cluster must name the folder its executors share")
        named = _OWN_DIRS.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="tidemark-"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Truncate the lineage of a small working set with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def forget_later(spark: SparkSession, stem: str) -> str:
    """A new path from ``stem`` that is removed when the session ends, or by ``sweep``."""
    path = f"{stem}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def land(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: lineage is cut, the columns stay prunable."""
    spark = df.sparkSession
    path = forget_later(spark, f"{shared_dir(spark)}/tidemark-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A table of at most this many bytes is sent to every worker.
SMALL = 8 << 20


def sized(df: DataFrame, name: str = "stage", small: int = SMALL) -> DataFrame:
    """``df`` landed, its bytes counted as it was written: to be broadcast where it is small, to be merged where it is not."""
    seen = Observation()
    width = F.lit(16)
    for f in df.schema.fields:
        width = width + (F.coalesce(F.octet_length(f.name), F.lit(0)) + 16 if f.dataType.typeName() == "string" else F.lit(16))
    done = land(df.observe(seen, F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes")), name)
    return F.broadcast(done) if seen.get["bytes"] <= small else done.hint("merge")


@atexit.register
def sweep() -> None:
    """Remove what was landed so far. A long-lived session calls it when no result read from there is needed any more."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # noqa: BLE001 - the session may be gone; the folder's owner sweeps it then
            return
