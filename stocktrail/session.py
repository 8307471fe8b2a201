"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join that feeds an aggregate on the same key would otherwise keep its hot partition whole.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows of a few columns take some thirty times their shuffled bytes in a task that groups them.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # Stream state on the executors' disks; the heap would bound how many runs may be open.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession) -> SparkSession:
    """Set what the jobs rely on. The numbers and sizes of tasks are left to the session: adaptive
    execution merges small shuffle partitions but never makes more, so the number it starts from
    must suit the input."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of partitions a shuffle starts from."""
    return int(spark.conf.get(INITIAL_PARTITIONS, spark.conf.get("spark.sql.shuffle.partitions")))


#: Bytes of stored input for which a shuffle starts from one more partition, and at most read by a task.
PARTITION_BYTES = 1 << 20
SPLIT_BYTES = 32 << 20

#: Bytes of stored input for which a job in slices takes one more of them, and how many at most.
SLICE_BYTES = 16 << 20
MOST_SLICES = 16
SLICES = "spark.stocktrail.slices"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def fit_to_input(spark: SparkSession, folder: str) -> None:
    """Let the tasks' number grow with the tables below ``folder``, and not their size.

    Shuffles start from at least the session's number of partitions; adaptive execution merges those
    that turn out small. Only the lengths of the files are read. The number of slices (``in_slices``)
    goes by the same lengths.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    size = files.agg(F.sum("length")).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(INITIAL_PARTITIONS, str(max(least, shuffle_partitions(spark), size // PARTITION_BYTES)))
    spark.conf.set(SLICES, str(max(1, min(MOST_SLICES, size // SLICE_BYTES))))
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split.rstrip("bB").isdigit():
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(min(int(split.rstrip("bB")), SPLIT_BYTES)))


@contextmanager
def _set(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs run inside send rows to Python in Arrow batches of some ``size`` bytes at most; a batch of
    10,000 rows of text is otherwise held several times over, by Spark and by the Python worker."""
    with _set(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(size)}):
        yield


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """What jobs run inside shuffle is removed as each ends, not when the driver next collects garbage."""
    with _set(spark, {CLEAN_UP: "true"}):
        yield


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own machine: on a cluster an executor
    that takes over lost work could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stocktrail-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/stocktrail/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there, with the lineage cut."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table below the shared folder and read it back.

    For a result that several later steps read by a few of its columns each; ``cut`` keeps rows
    whole and is for the rounds of a loop.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(spark: SparkSession) -> int:
    """In how many slices a job on the tables of this session is done; 1 for small tables."""
    return int(spark.conf.get(SLICES, "1"))


def slice_of(df: DataFrame, key: str, number: int, of: int) -> DataFrame:
    """The rows whose ``key`` falls into slice ``number``; NULL is a key like any other.

    Not by the hash that shuffles go by, which would leave most of their partitions empty.
    """
    return df.where(F.pmod(F.xxhash64(key), F.lit(of)) == number)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``written`` where the job goes in slices, each of which reads ``df``; otherwise ``df`` as it is."""
    if slices(df.sparkSession) == 1:
        return df
    with freed(df.sparkSession):
        return written(df, name)


Part = Callable[[DataFrame, str], DataFrame]


def in_slices(
    spark: SparkSession, name: str, build: Callable[[Part], DataFrame], rest: DataFrame | None = None
) -> DataFrame:
    """The rows of ``build``, worked out slice after slice, so that the disk holds the shuffles of one
    slice at a time beside the result.

    ``build`` is given a function that takes a table and its key to the rows of the slice. Each row of
    the result must come of the rows of one slice; ``rest`` are rows that come of none. With one
    slice nothing is run or written here.
    """
    of = slices(spark)
    if of == 1:
        whole = build(lambda df, key: df)
        return whole if rest is None else whole.unionByName(rest)
    path = scratch_path(spark, name)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shuffle_partitions(spark) // of)
    with freed(spark), _set(spark, {INITIAL_PARTITIONS: str(tasks)}):
        for number in range(of):
            rows = build(lambda df, key: slice_of(df, key, number, of))
            rows.write.mode("append").parquet(path)
        if rest is not None:
            rest.select(*rows.columns).write.mode("append").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
