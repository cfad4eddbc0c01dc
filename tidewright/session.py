"""Spark session, shared folder and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build(cpus: int | str = "*", app: str = "tidewright", **conf: str) -> SparkSession:
    """A session for local use. On a cluster the session that the caller has is used as it is."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir where it is set; else one of our own, for tests.

    The own folder is machine-local and therefore taken for local masters only."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="tidewright-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


_written: dict[str, list[str]] = {}  # by application


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; cleared() deletes it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def cleared(spark: SparkSession) -> None:
    """Deletes all that was written by scratch() and cut() in this application. For the end of a job, once its results are stored elsewhere: what
    wasn't read yet can't be read any more."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    hp = spark._jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hp, True)


def cut(df: DataFrame, name: str = "cut", **options: str) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends there and a lost executor costs nothing."""
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that cut() wrote, once nothing reads them any more."""
    for t in tables:
        for path in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            _delete(t.sparkSession, path)


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """What the jobs give, which don't depend on each other and are started at once."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(j)) for j in jobs]]


def fits(df: DataFrame, rows: int, size: int) -> bool:
    """Whether df has at most so many rows and bytes (of its values as text). No more than rows + 1 of them are looked at."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c, t in df.dtypes if not t.startswith(("array", "map", "struct", "variant", "binary"))), F.lit(0))
    n, b = df.limit(rows + 1).agg(F.count("*"), F.sum(width)).first()
    return n <= rows and (b or 0) <= size


def lookup_side(df: DataFrame, rows: int = 20_000, size: int = 16 << 20) -> DataFrame:
    """df, to be broadcast if it is proven to have no more than so many rows and bytes; otherwise as it is, to be joined by shuffle."""
    return F.broadcast(df) if fits(df, rows, size) else df


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as there are cores: a file that a scan can't split keeps costly work on one core. Inputs
    with enough partitions, and those that were shuffled, stay as they are, so large inputs are never moved for this."""
    plan = df._jdf.queryExecution()
    if "Exchange" in plan.sparkPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if plan.toRdd().getNumPartitions() >= cores else df.repartition(cores)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application; for sessions whose workers lack it on their path."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tidewright-py-"), "tidewright.zip")
    with zipfile.ZipFile(out, "w") as z:
        for at, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(at, n)
                    z.write(full, os.path.join("tidewright", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(out)
    _shipped.add(app)
