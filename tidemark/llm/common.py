"""What the operators share: the cluster's shared folder, written tables, and joins that survive hot keys."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that a join may broadcast, and rows of a key below which none is.
HEAVY_KEYS = 100_000
LIGHT_ROWS = 2_000

#: Bytes of an Arrow batch that goes to Python, where the session has no limit of its own.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where the setting is missing, a local session (tests) gets a temporary folder; a cluster is refused,
    as its machines see different temporary folders.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def small_batches(df: DataFrame) -> DataFrame:
    """df, after its session has got the limit BATCH_BYTES, unless it has one: a batch is held several times, by executor and worker."""
    if df.sparkSession.conf.get(BATCH_SETTING, None) is None:
        df.sparkSession.conf.set(BATCH_SETTING, BATCH_BYTES)
    return df


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a written table: computed once, and cut from its lineage so that a lost executor costs no recomputation."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables that are deleted at the end of a with block; what leaves the block has to be written elsewhere."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self.paths:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
        self.paths = []
        # Spark removes shuffle files when the driver's garbage collector finds their plans unreachable; on a large heap that is late
        gc.collect()
        self.spark._jvm.System.gc()

    def __exit__(self, *_: object) -> None:
        self.clear()


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Inner join to right, unique on keys, whose column `weight` counts the rows of left (`total` in all) that a key meets.

    Keys with over 1 / HEAVY_KEYS of the rows (and over LIGHT_ROWS) are fewer than HEAVY_KEYS, whatever the input: they
    are broadcast, so no task gets a hot key's rows. All other keys are shuffled; the largest of them has a million rows
    of 10 ** 11.
    """
    limit = max(LIGHT_ROWS, total // HEAVY_KEYS)
    heavy = F.broadcast(right.filter(F.col(weight) > limit))
    light = right.filter(F.col(weight) <= limit)
    rest = left.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return left.join(heavy, keys).unionByName(rest.join(light, keys))


def smallest_hashes(df: DataFrame, hash_col: str, ties: list[str], most: int) -> DataFrame:
    """The `most` rows with the smallest 64-bit hashes: a sample that doesn't depend on the partitioning.

    Only about twice as many rows, over all tasks, go on to the driver's merge: the others' hashes are too large.
    """
    count = df.count()
    if count > 2 * most:
        df = df.filter(F.col(hash_col) <= F.lit(int(-(2**63) + 2**64 * (2 * most / count))))
    return df.orderBy(hash_col, *ties).limit(most)
