"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.util import inheritable_thread_target

import slotflow

# Runtime settings every job relies on. Joins on a hot key are split by AQE, also
# where the split costs one more shuffle: a task holding a third of the rows costs more.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # digests in the state of streams are hexadecimal text; a stream that has begun keeps the codec it began with
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}

#: What a task gets of a shuffle where the session's own size is larger: 64 MB of order lines, the default, are 1.8 GB once sorted and compared.
ADVISORY, MOST_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 16 * 2**20


def _bytes(size: str) -> int:
    """A size as Spark writes it: a number, and a unit of b, k, m, g, t or p, which a b may follow."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([bkmgtp]?)b?\s*", size.lower()).groups()
    return int(number) * 1024 ** "bkmgtp".index(unit or "b")


#: Sub-folder of the tables stored now; see temporary_tables.
_scope: ContextVar[str] = ContextVar("scope", default="kept")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere.

    Functions that run in tasks travel with them: executors need no copy of this package.
    """
    cloudpickle.register_pickle_by_value(slotflow)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if _bytes(spark.conf.get(ADVISORY)) > MOST_BYTES:
        spark.conf.set(ADVISORY, str(MOST_BYTES))
    return spark


def local_session(cpus: int | str = 8, name: str = "slotflow", memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, which survives the loss of an executor.

    The cluster names it in ``spark.checkpoint.dir``. A local master, which has no other
    machine to lose, gets a temporary folder; a cluster without the setting is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="slotflow-"))
        folder = context.getCheckpointDir()
    return folder


def new_table_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{_scope.get()}/{uuid.uuid4().hex}"


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Removes at its end the intermediate tables stored within it: write what is wanted before.

    Tables stored outside such a block stay until the application's folder is deleted.
    """
    name = uuid.uuid4().hex
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
            f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}"
        )
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and go on from a table of its rows in the shared folder.

    Lineage ends there, later reads take only the columns they need, and the planner knows the
    true size. A frame that came from here is returned as it is.
    """
    if getattr(df, "_slotflow_stored", False):
        return df
    spark = df.sparkSession
    path = new_table_path(spark)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._slotflow_stored = True
    return stored


def materialize_all(*frames: DataFrame) -> list[DataFrame]:
    """``materialize`` for frames that do not need each other, at the same time."""
    shared_folder(frames[0].sparkSession)
    context = copy_context()
    run = inheritable_thread_target(frames[0].sparkSession)(lambda df: context.copy().run(materialize, df))
    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(run, frames))
