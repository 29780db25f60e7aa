"""Session settings and the one shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


# Wide cleaning projections compile to methods the JVM refuses to optimise (over 8,000 bytes of
# bytecode). At this limit Spark splits them instead, which runs two to three times faster.
SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Runtime settings for a session that someone else created."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(app: str = "wearline", cores: int | str = 8, memory: str = "12g",
                  shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster supplies its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Small test files shrink to one task per stage unless small partitions are allowed.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    return apply_settings(spark)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers that start without it on their path.

    The archive is only what the driver hands to Spark; executors fetch it from Spark.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).parent
        path = f"{tempfile.mkdtemp(prefix='wearline-code-')}/wearline.zip"
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local master may fall back to a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="wearline-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Files that one task holds open for a table in folders; with more folders it sorts its rows instead.
OPEN_FILES = "16"


def settle(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Used where several actions read one expensive frame (a training set). The written copy cuts
    the lineage and outlives any executor. ``by`` names columns of few values that readers choose by:
    their rows lie in folders of their own.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    if not by:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, OPEN_FILES)
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def with_checkpoints(spark: SparkSession) -> SparkSession:
    """A folder for Spark's own checkpoints, if there is none yet.

    Boosting hangs every round on the one before. Without checkpoints hundreds of rounds make a lineage
    that is too deep to be sent to a task.
    """
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_path(spark, "rounds"))
    return spark


def side_by_side(calls: Sequence[Callable], workers: int) -> list:
    """The results of independent calls in their order. Jobs of one fill the cores that another leaves."""
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(calls)))) as pool:
        return [done.result() for done in [pool.submit(call) for call in calls]]


def observed(seen: Observation, names: list[str]) -> dict:
    """The metrics of a finished job by name; all null if the frame was known to be empty.

    The optimizer leaves out an empty frame together with what observes it, and no metrics come back.
    """
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return dict.fromkeys(names)


def small_side(df: DataFrame, limit: int = 50_000) -> DataFrame:
    """A lookup table marked for broadcast after its rows are counted; left as it is beyond limit."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


_KEPT: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, name: str, source: str, build):
    """Build something once per application and source, such as the settled events of a panel.

    The source is taken not to change meanwhile; call ``forget`` after it was rewritten.
    """
    key = (spark.sparkContext.applicationId, name, source)
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def forget(source: str) -> None:
    """Builds anew, on the next use, all that was made from a source."""
    for key in [k for k in _KEPT if k[2] == source]:
        del _KEPT[key]
