"""Session defaults and the shared folder used for checkpoints and hand-over tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}
_scratch: list[str] = []


def local_session(cores: int | str = "*", app_name: str = "jobgrain", **conf: str) -> SparkSession:
    """A session for laptops, tests and the benchmark. Clusters bring their own session."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A temporary folder stands in only for a local master, where driver and executors are one process.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    root = _local_roots.get(context.applicationId)
    if root is None:
        root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="jobgrain-")
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, or below the open scratch folder of a job."""
    return f"{_scratch[-1] if _scratch else shared_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables of the block go to one folder, which is deleted at its end.

    For jobs that write all their results: a lazy result must not be read after the block.
    """
    folder = shared_path(spark, "job")
    _scratch.append(folder)
    try:
        yield
    finally:
        _scratch.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a frame that several passes read as a columnar table in the shared folder, and read it back.

    Each later pass then reads only the columns it needs instead of repeating the joins behind them.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int, limit: int = 64 * 1024**2) -> DataFrame:
    """Ask for a broadcast only when the counted rows of the frame's width stay below a limit in bytes.

    Texts count with 64 bytes, which the names of this library's graphs stay below. Beyond the limit the join is Spark's.
    """
    width = sum(64 if f.dataType.typeName() in ("string", "array") else 8 for f in df.schema)
    return F.broadcast(df) if rows * width <= limit else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """End a plan in a written table, so that iterative plans stay short and survive lost executors.

    One job instead of the two of an eager checkpoint, and the scan knows its size, so joins on it are planned well.
    """
    return materialise(df, "cut")
